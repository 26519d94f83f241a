"""Relational lineage operators: port edges, column lineage of mappings, name matching, summaries, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.scalars import port_references
from loomline.operators import graph
from loomline.session import cut


def port_edges(connectors: DataFrame, ports: DataFrame) -> DataFrame:
    """mapping, src, dst from a port back to what it is made of: connectors reversed, and expression references.

    connectors: mapping, from_instance, from_field, to_instance, to_field; ports: mapping, instance, field, expression.
    A reference counts only if the instance has a port of that name and it is not the port itself.
    """
    node = lambda i, f: F.concat_ws("\x1f", F.col(i), F.col(f))
    back = connectors.select("mapping", node("to_instance", "to_field").alias("src"), node("from_instance", "from_field").alias("dst"))
    refs = ports.select("mapping", "instance", F.col("field").alias("own"), F.explode(port_references(F.col("expression"))).alias("field"))
    refs = refs.where("own != field").join(ports.select("mapping", "instance", "field").distinct(), ["mapping", "instance", "field"])
    return back.unionByName(refs.select("mapping", node("instance", "own").alias("src"), node("instance", "field").alias("dst"))).distinct()


def column_lineage(connectors: DataFrame, ports: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """mapping, target_instance, target_field, source_instance, source_field, hops.

    sources and targets: mapping, instance. Targets' fields are their ports and what connectors bring them; walks end
    at source instances.
    """
    node = lambda i, f: F.concat_ws("\x1f", F.col(i), F.col(f))
    # each is used several times, and may be costly to parse
    ports, connectors = cut(ports.select("mapping", "instance", "field", "expression")), cut(connectors)
    sources, targets = cut(sources.select("mapping", "instance").distinct()), targets.select("mapping", "instance").distinct()
    fields = ports.select("mapping", "instance", "field").union(connectors.select("mapping", "to_instance", "to_field")).distinct()
    starts = fields.join(targets, ["mapping", "instance"]).select("mapping", node("instance", "field").alias("start"))
    edges = port_edges(connectors, ports)
    nodes = connectors.select("mapping", F.col("from_instance").alias("instance"), F.col("from_field").alias("field")).union(fields).distinct()
    ends = nodes.join(sources, ["mapping", "instance"]).select("mapping", node("instance", "field").alias("node"))
    reached = graph.reach_ends(edges, starts, ends, ("mapping",))
    part = lambda c, i: F.split_part(F.col(c), F.lit("\x1f"), F.lit(i))
    return reached.select("mapping", part("start", 1).alias("target_instance"), part("start", 2).alias("target_field"), part("node", 1).alias("source_instance"), part("node", 2).alias("source_field"), "hops")


def match_tables(names: DataFrame, known: DataFrame) -> DataFrame:
    """name, table, ord: the first known table (by ord) that equals a name, or ends with a dot and it, whatever the case.

    An equi-join on the last part of the name: what ends with `.a.b` ends with `.b`, too.
    """
    last = lambda c: F.upper(F.substring_index(c, ".", -1))
    left = names.select("name").distinct().withColumn("last", last("name"))
    right = known.select("table", "ord").withColumn("last", last("table"))
    fits = (F.upper("table") == F.upper("name")) | F.endswith(F.upper("table"), F.concat(F.lit("."), F.upper("name")))
    return left.join(right, "last").where(fits).groupBy("name").agg(F.min(F.struct("ord", "table")).alias("x")).select("name", "x.table", "x.ord")


def only_owner(columns: DataFrame, schema: DataFrame) -> DataFrame:
    """scope, column, table: the table of a scope that alone has a bare column. schema: scope, table, column."""
    key = F.upper("column").alias("key")
    owners = schema.select("scope", key, "table").distinct().groupBy("scope", "key").agg(F.count("*").alias("n"), F.min("table").alias("table")).where("n = 1")
    return columns.select("scope", "column", key).join(owners, ["scope", "key"]).select("scope", "column", "table")


def by_target(edges: DataFrame) -> DataFrame:
    """Edges grouped by target: sources, distinct upstream fields in order, expressions in order, least confidence.

    edges: target_dataset, target_column, source_dataset, source_column, kind, expression, confidence, step_order, ord.
    """
    steps = F.array_sort(F.collect_list(F.struct("ord", "expression")))
    chain = F.array_sort(F.collect_list(F.struct((-F.col("step_order")).alias("s"), "ord", F.concat(F.lit("["), "kind", F.lit("] "), "expression").alias("text"))))
    ups = F.array_sort(F.collect_list(F.struct("ord", F.concat_ws(".", "source_dataset", "source_column").alias("f"))))
    return edges.groupBy("target_dataset", "target_column").agg(
        F.count("*").alias("n_edges"),
        F.array_sort(F.collect_set("source_dataset")).alias("source_datasets"),
        F.array_distinct(F.transform(ups, lambda x: x["f"])).alias("upstream_fields"),
        F.array_join(F.transform(F.filter(steps, lambda x: x["expression"].isNotNull()), lambda x: x["expression"]), " -> ").alias("expression_chain"),
        F.array_join(F.transform(F.filter(chain, lambda x: x["text"].isNotNull()), lambda x: x["text"]), " → ").alias("transformation_chain"),
        F.min("confidence").alias("confidence"),
    )


def summary(edges: DataFrame) -> DataFrame:
    """One row: edges, distinct source and target datasets, procedures, folders, workflows, mappings."""
    distinct = lambda c: F.countDistinct(c)
    return edges.agg(
        F.count("*").alias("total_edges"), distinct("source_dataset").alias("source_datasets"), distinct("target_dataset").alias("target_datasets"),
        distinct("procedure").alias("procedures"), distinct("folder").alias("folders"), distinct("workflow").alias("workflows"), distinct("mapping").alias("mappings"),
    )


def edges_by_kind(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count("*").alias("edges"))


def session_mappings(sessions: DataFrame, mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sessions with their mapping, and the sessions whose mapping is missing.

    A session names a mapping of its own folder in its own export: both have file, folder and mapping. Another folder's
    or another export's mapping of that name is a different one. Texts without a file name count as one export.
    """
    same = F.col("s.file").eqNullSafe(F.col("m.file")) & (F.col("s.folder") == F.col("m.folder")) & (F.col("s.mapping") == F.col("m.mapping"))
    s, m = sessions.alias("s"), mappings.alias("m")
    return s.join(m, same, "left_semi"), s.join(m, same, "left_anti")


def scoped(items: DataFrame, inner: DataFrame, outer: DataFrame, value: str) -> DataFrame:
    """A transformation by name: that of the mapping, else that of the folder. items: folder, mapping, name."""
    a = inner.select("folder", "mapping", "name", F.col(value).alias("_in"))
    b = outer.select("folder", "name", F.col(value).alias("_out"))
    return items.join(a, ["folder", "mapping", "name"], "left").join(b, ["folder", "name"], "left").withColumn(value, F.coalesce("_in", "_out")).drop("_in", "_out")


def first_by(df: DataFrame, scope: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each scope."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*scope).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def procedure_edges(calls: DataFrame, procedure: Column, target: Column) -> DataFrame:
    """An edge of all fields from a procedure to the dataset that a call of it fills."""
    return calls.select(procedure.alias("source_dataset"), F.lit("*").alias("source_column"), target.alias("target_dataset"), F.lit("*").alias("target_column"), F.lit("STORED_PROCEDURE").alias("kind"), F.lit(0.95).alias("confidence"))
