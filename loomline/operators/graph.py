"""Graph operators as DataFrame loops: closure, hops, first sources, levels, breadth-first order, hierarchies.

Each round joins the frontier with the edges and drops what has been reached (semi-naive evaluation); every few rounds
the frontier and the result go to the shared checkpoint folder, so plans stay short and a lost executor costs little.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.order import numbered
from loomline.session import cut

#: Depth at which a hierarchy is taken for one that holds a cycle; it is an error, not an end.
MAX_DEPTH = 2000
#: Largest graph (edges, starts and ends) of a scope that one worker walks.
PACKED = 5000


def reach(edges: DataFrame, starts: DataFrame, keep: tuple[str, ...] = (), stop: DataFrame | None = None, max_rounds: int | None = None) -> DataFrame:
    """All nodes that starts reach, themselves included, with the least number of hops: keep, start, node, hops.

    edges: keep, src, dst; starts: keep, start; stop: keep, node (walks end there). Cycles are walked once. The walk goes
    on until nothing is new; with max_rounds, a walk of more hops raises an error instead of returning a part.
    """
    keys = [*keep, "start", "node"]
    seen = cut(starts.select(*keep, "start", F.col("start").alias("node")).distinct().withColumn("hops", F.lit(0)))
    frontier, hops = seen, 0
    edges = cut(edges.select(*keep, F.col("src").alias("node"), F.col("dst")).distinct())  # read in every round
    stop = cut(stop.select(*keep, "node").distinct()) if stop is not None else None
    while True:
        hops += 1
        open_ = frontier.join(stop, [*keep, "node"], "left_anti") if stop is not None else frontier
        step = open_.join(edges, [*keep, "node"]).select(*keep, "start", F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen, keys, "left_anti").withColumn("hops", F.lit(hops)))
        if not frontier.take(1):
            return seen
        if max_rounds is not None and hops > max_rounds:
            raise ValueError(f"a walk of more than {max_rounds} hops")
        seen = seen.unionByName(frontier)
        if hops % 4 == 0:
            seen = cut(seen)


def _walk(batches):
    """Breadth-first walks inside packed scopes (see reach_ends)."""
    for b in batches:
        take, out = [], []
        for i, rows in enumerate(b["rows"].to_pylist()):
            after, starts, ends = {}, [], set()
            for r in rows:
                if r["kind"] == 0:
                    after.setdefault(r["a"], []).append(r["b"])
                elif r["kind"] == 1:
                    starts.append(r["a"])
                else:
                    ends.add(r["a"])
            for start in starts:
                hops, now = {start: 0}, [start]
                while now:
                    now = [n for x in now if x not in ends for n in after.get(x, ()) if n not in hops and hops.setdefault(n, hops[x] + 1)]
                found = [(start, n, h) for n, h in hops.items() if n in ends]
                out += found
                take += [i] * len(found)
        keys = b.select([c for c in b.schema.names if c != "rows"]).take(pa.array(take, pa.int64()))
        columns = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32())], [*keys.schema.names, "start", "node", "hops"])


def reach_ends(edges: DataFrame, starts: DataFrame, ends: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """What reach() with stop = ends finds at the ends, for many scopes (keep) with graphs of their own; nodes are strings.

    A scope of at most PACKED edges, starts and ends is one row, walked in one worker; larger ones are walked by rounds
    over all executors. Both give the same rows.
    """
    none = F.lit(None).cast("string")
    e = edges.select(*keep, F.lit(0).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"))
    s = starts.select(*keep, F.lit(1).alias("kind"), F.col("start").alias("a"), none.alias("b"))
    x = ends.select(*keep, F.lit(2).alias("kind"), F.col("node").alias("a"), none.alias("b"))
    rows = cut(e.unionByName(s).unionByName(x).distinct())
    large = cut(rows.groupBy(*keep).count().where(F.col("count") > PACKED).select(*keep))
    some = bool(large.take(1))
    small = rows.join(large, [*keep], "left_anti") if some else rows
    packed = small.groupBy(*keep).agg(F.collect_list(F.struct("kind", "a", "b")).alias("rows"))
    schema = ", ".join([f"{c} {t}" for c, t in packed.select(*keep).dtypes] + ["start string, node string, hops int"])
    out = packed.mapInArrow(_walk, schema)
    if not some:
        return out
    rest = rows.join(large, [*keep], "left_semi")
    far = rest.where("kind = 2").select(*keep, F.col("a").alias("node"))
    walked = reach(rest.where("kind = 0").select(*keep, F.col("a").alias("src"), F.col("b").alias("dst")), rest.where("kind = 1").select(*keep, F.col("a").alias("start")), keep, far)
    return out.unionByName(walked.join(far, [*keep, "node"]).select(*keep, "start", "node", "hops"))


def closure(edges: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, src, dst: all pairs joined by one edge or more (a node on a cycle reaches itself).

    The result is as large as all pairs; where starts are known, reach() is the one to call.
    """
    base = cut(edges.select(*keep, "src", "dst").distinct())
    seen = frontier = base
    step = base.select(*keep, F.col("src").alias("mid"), F.col("dst").alias("far"))
    for i in itertools.count(1):
        new = frontier.join(step, [*[frontier[k] == step[k] for k in keep], frontier.dst == step.mid]) if keep else frontier.join(step, frontier.dst == step.mid)
        new = new.select(*[frontier[k] for k in keep], frontier.src, F.col("far").alias("dst")).distinct()
        frontier = cut(new.join(seen, [*keep, "src", "dst"], "left_anti"))
        if not frontier.take(1):
            break
        seen = seen.unionByName(frontier)
        if i % 4 == 0:
            seen = cut(seen)
    return seen


def first_source(reached: DataFrame, sources: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, start, source, hops: the nearest source that each start reaches; of several, the least."""
    found = reached.join(sources.select(*keep, "node").distinct(), [*keep, "node"])
    return found.groupBy(*keep, "start").agg(F.min(F.struct("hops", "node")).alias("x")).select(*keep, "start", F.col("x.node").alias("source"), F.col("x.hops").alias("hops"))


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, level: the longest way from a node without predecessors; nodes on or behind a cycle get null.

    Rounds release the nodes whose predecessors all have a level (Kahn's order, a whole level at a time). A round joins
    the edges with the nodes just released, and otherwise touches only nodes that wait with some predecessors done.
    """
    nodes = cut(nodes.select("node").distinct())
    known = lambda c: nodes.select(F.col("node").alias(c))
    edges = cut(edges.select("src", "dst").distinct().join(known("src"), "src", "left_semi").join(known("dst"), "dst", "left_semi"))
    needs = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("needs"))
    needs = cut(needs)
    frontier = nodes.join(needs, "node", "left_anti")
    done, waiting, level = frontier.withColumn("level", F.lit(0)), None, 0
    while True:
        met = frontier.join(edges, frontier.node == edges.src).groupBy(edges.dst.alias("node")).agg(F.count("*").alias("met"))
        if waiting is not None:
            met = met.unionByName(waiting).groupBy("node").agg(F.sum("met").alias("met"))
        met = cut(met.join(needs, "node"))
        level += 1
        frontier, waiting = met.where("met = needs").select("node"), met.where("met < needs").select("node", "met")
        if not frontier.take(1):
            rest = nodes.join(done, "node", "left_anti").withColumn("level", F.lit(None).cast("int"))
            return done.unionByName(rest)
        done = done.unionByName(frontier.withColumn("level", F.lit(level)))


def topological_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, ord, position: by level, then declaration order; nodes on cycles come last, in declaration order."""
    found = levels(nodes, edges).join(nodes.select("node", "ord"), "node")
    return numbered(found, [F.col("level").asc_nulls_last(), "ord"], "position", 1).select("node", "ord", "level", "position")


def breadth_first(edges: DataFrame, nodes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, node, ord, depth, position: hops from the nodes without predecessors; what they don't reach comes last."""
    heads = nodes.join(edges.select(*keep, F.col("dst").alias("node")).distinct(), [*keep, "node"], "left_anti")
    reached = reach(edges, heads.select(*keep, F.col("node").alias("start")), keep).groupBy(*keep, "node").agg(F.min("hops").alias("depth"))
    order = Window.partitionBy(*keep).orderBy(F.col("depth").asc_nulls_last(), "ord")
    return nodes.join(reached, [*keep, "node"], "left").withColumn("position", F.row_number().over(order))


def hierarchy(members: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """members (scope, ordinal, name, parent) with their children, in order, without those of unknown parents."""
    kids = members.where("parent is not null").groupBy(*scope, F.col("parent").alias("name")).agg(F.array_sort(F.collect_set(F.struct("ordinal", F.col("name").alias("child")))).alias("x"))
    return members.join(kids, [*scope, "name"], "left").withColumn("children", F.coalesce(F.transform("x", lambda e: e["child"]), F.array())).drop("x")


def roots(members: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Members without a parent, or whose parent is not a member."""
    return members.join(members.select(*scope, F.col("name").alias("parent")).distinct(), [*scope, "parent"], "left_anti").select(*members.columns)


def leaves(members: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    return members.join(members.where("parent is not null").select(*scope, F.col("parent").alias("name")).distinct(), [*scope, "name"], "left_anti").select(*members.columns)


def paths(members: DataFrame, scope: tuple[str, ...] = (), sep: str = ".") -> DataFrame:
    """Members with path (names from the root, joined) and depth: nested schemas as flat field paths."""
    now = cut(roots(members, scope).withColumn("path", F.col("name")).withColumn("depth", F.lit(0)))
    out, depth = now, 0
    while True:
        depth += 1
        above = now.select(*scope, F.col("name").alias("parent"), F.col("path").alias("prefix"))
        now = cut(members.join(above, [*scope, "parent"]).withColumn("path", F.concat_ws(sep, "prefix", "name")).withColumn("depth", F.lit(depth)).select(*out.columns))
        if not now.take(1):
            return out
        if depth >= MAX_DEPTH:
            raise ValueError(f"members below themselves, or more than {MAX_DEPTH} levels")
        out = out.unionByName(now)
