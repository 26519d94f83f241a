"""N-gram Jaccard join (operator 7): a parity-sketch join.

Every text's set of word shingles is XOR-hashed into a bit sketch; two sets differ in at least as many elements as
their sketches differ in bits. Sets linked at similarity num/den differ in at most (a+b)(den-num)/(den+num) elements,
so with a size band's largest set U they differ in at most k = 2U(den-num)/(den+num) bits. The sketch of a band is cut
into more than k/2 groups of three parts; by the pigeonhole principle two linked sets differ in one bit at most in some
group, so they agree on two of its parts, and these are the key they meet on. With spare groups a set can leave out keys
of few bits, as long as no more than the spare groups have any: empty and nearly empty keys, which agree by chance or by
one common passage, are not joined on. Sets meet others of their own band and, where a partner may be larger, of the next.

Equal sets form one class before anything is joined. In a bucket of equal parts the first RUN classes are compared with
each other, and every later one with the first; each bucket has an order of its own (unless spread is off), so that the classes of a crowd are
compared with another of them in each bucket that they share, and most of what links does so here. Longer buckets in which a good part has linked by then, and others have
not, go through rounds: classes outside the bucket's largest component are compared with a few classes of it, new links
are added, components are made anew, and buckets of one component leave. Each round is linear in the buckets' entries.
When few pairs are left there, or a round has linked nothing, or after ROUNDS of them, the classes outside the largest component of any longer
bucket are compared with all of it that are in another component: no pair of different components stays uncompared, so
nothing is lost. Only a bucket of many classes that meet and yet don't link costs more than its size in this last step,
in comparisons of sketches inside the join; pairs that come out of it passed the bound. Pairs pass the sketches' Hamming
bound, then an exact count over the sets of both.

Defined cases: null texts and texts without words have an empty set and are linked with nothing; a text of fewer words
than a shingle is one shingle; a text of any length is one set; rows that repeat an id are rows of their own with that
id; rows without an id link others but name no component, and theirs is null if no row in it has an id; an empty table
gives no rows; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm import text as tx
from loomline.llm.components import components
from loomline.llm.prefilter import free_name, maybe_among, without
from loomline.llm.settings import CLEANUP, setting
from loomline.session import cut, spilled, sweep

WIDTH, NUM, DEN = 5, 4, 5
#: Share of spare groups.
SPARE = 0.15
#: Classes of a bucket that are all compared with each other.
RUN = 8
#: Classes of a bucket's largest component that the others are compared with in a round; rounds go on while more pairs
#: than this for each entry are left to compare.
HUBS, FEW = 8, 1024
#: Rounds at most. They change the cost, not the result: every round needs the components anew, which pays where the last
#: step alone would compare and hand on very many pairs of one crowd.
ROUNDS = 3
#: Buckets go through rounds if their largest component is this share of them or more.
CROWD = 1 / 8
#: Bits of a sketch for each bit that linked sets may differ in, and at least.
RATE, LEAST_BITS = 4, 512
_PAIRS = ((0, 1), (0, 2), (1, 2))
#: Keys are cut to 48 bits, as they make most of the shuffle; a chance match costs a comparison of two sketches.
_KEY = np.uint64((1 << 48) - 1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_INFO = "band int, own array<long>, next array<long>"


class Bands:
    """Size bands: starts grow by 3/2 (or den/num, if larger), so linked sets lie in one band or in neighbours."""

    def __init__(self, num: int, den: int, most: int = 1 << 40):
        self.num, self.den = num, den
        self.start = [1]
        while self.start[-1] < most:
            x = self.start[-1]
            self.start.append(max(x + 1, -(-3 * x // 2), -(-x * den // num)))
        self.edges = np.asarray(self.start, np.int64)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, side="right") - 1

    def reaches_next(self, n: np.ndarray, band: np.ndarray) -> np.ndarray:
        return n * self.den // self.num >= self.edges[band + 1]

    def errors(self, band: int) -> int:
        return 2 * (self.start[band + 1] - 1) * (self.den - self.num) // (self.den + self.num)

    def spare(self, band: int) -> int:
        return int(np.ceil(SPARE * (self.errors(band) // 2)))

    def groups(self, band: int) -> int:
        """Of this many groups all but errors/2 differ in one bit at most."""
        return self.errors(band) // 2 + 1 + self.spare(band)

    def bits(self, band: int) -> int:
        return max(LEAST_BITS, 64 * -(-RATE * self.errors(band) // 64))


def _laid_out(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All elements in a row, the set of each, and the hash that places it in a sketch."""
    flat = np.concatenate(sets)
    return flat, np.repeat(np.arange(len(sets)), [len(s) for s in sets]), tx.mix(flat ^ _GOLD)


def bit_sketches(sets: list[np.ndarray], scheme: np.ndarray, bands: Bands) -> list[np.ndarray]:
    """The bit sketch of each set under its scheme, as longs."""
    if not sets:
        return []
    _, of, place = _laid_out(sets)
    bits = np.asarray([bands.bits(b) for b in scheme.tolist()])
    spot = (place & np.uint64(0xFFFFFFFF)) * bits[of].astype(np.uint64) >> np.uint64(32)
    first = np.cumsum(bits) - bits
    parity = (np.bincount(first[of] + spot.astype(np.int64), minlength=int(bits.sum())) & 1).astype(np.uint8)
    words, ends = np.packbits(parity).view(np.int64), np.cumsum(bits) // 64
    return [words[z - n // 64 : z] for z, n in zip(ends.tolist(), bits.tolist(), strict=True)]


def part_keys(sets: list[np.ndarray], scheme: np.ndarray, bands: Bands) -> list[np.ndarray]:
    """The keys of the parts that each set joins on under its scheme: hashes of the parts' sketches."""
    if not sets:
        return []
    flat, of, place = _laid_out(sets)
    groups = np.asarray([bands.groups(b) for b in scheme.tolist()])
    p = 3 * groups
    # part: the high half of the hash scaled to their number; code of a bit: another mix of the whole hash
    part = ((place >> np.uint64(32)) * p[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = (np.cumsum(p) - p)[of] + part
    order = np.argsort(cell, kind="stable")
    cells = cell[order]
    heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    code, count = np.zeros(int(p.sum()), np.uint64), np.zeros(int(p.sum()), np.int64)
    code[cells[heads]] = np.bitwise_xor.reduceat(tx.mix(flat + _GOLD)[order], heads)
    count[cells[heads]] = np.diff(np.r_[heads, len(cells)])
    # a group's three keys leave out one of its parts each
    code, count = code.reshape(-1, 3), count.reshape(-1, 3)
    start = np.cumsum(groups) - groups
    owner = np.repeat(np.arange(len(sets)), groups)
    name = tx.mix((np.arange(len(code)) - start[owner]).astype(np.uint64) * _GOLD + scheme[owner].astype(np.uint64))
    keys = np.stack([tx.mix(tx.mix(code[:, i] + name + np.uint64(i)) * _GOLD + code[:, j] + np.uint64(j)) for i, j in _PAIRS], axis=1)
    weight = np.stack([count[:, i] + count[:, j] for i, j in _PAIRS], axis=1)
    least, out = weight.min(axis=1), []
    for i in range(len(sets)):
        mine = slice(start[i], start[i] + groups[i])
        few = np.cumsum(np.bincount(least[mine]))
        floor = int(np.searchsorted(few, bands.spare(int(scheme[i])), side="right"))  # groups with a key of fewer bits are spare
        out.append((keys[mine][weight[mine] >= floor] & _KEY).view(np.int64))
    return out


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    codes, ends, distinct = tx.encode(texts)
    h = tx.hashes(distinct)[codes] if len(codes) else np.empty(0, np.uint64)
    return [tx.shingles(h[a:b], width) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def class_id(s: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    if not len(s):
        return 0
    ends = np.asarray([tx.mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(tx.mix(s + _GOLD))], np.uint64)
    return int(tx.mix(ends[:1] + ends[1:] * _GOLD + np.uint64(len(s))).view(np.int64)[0])


def _schemes(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The band of each set, and which sets may have partners in the next."""
    n = np.asarray([len(x) for x in sets], np.int64)
    band = bands.of(n)
    return band, np.flatnonzero(bands.reaches_next(n, band))


def _info(sets: list[np.ndarray], bands: Bands) -> tuple[list[int], list, list]:
    """Band, and sketches under the own and the next band's scheme (None where there can be no partner)."""
    if not sets:
        return [], [], []
    band, further = _schemes(sets, bands)
    after: list = [None] * len(sets)
    for i, x in zip(further.tolist(), bit_sketches([sets[i] for i in further.tolist()], band[further] + 1, bands), strict=True):
        after[i] = x
    return band.tolist(), bit_sketches(sets, band, bands), after


_LONGS = pa.list_(pa.int64())


def _classes(width: int, bands: Bands):
    """doc, k, n, cid for each text; the first of a class in a task also has the class's sketches."""

    def run(batches):
        seen: set[int] = set()
        for b in tx.chunks(batches, "_text"):
            sets = _sets(b["_text"].to_pylist(), width)
            cid = [class_id(x) for x in sets]
            first = [i for i, (x, c) in enumerate(zip(sets, cid, strict=True)) if len(x) and not (c in seen or seen.add(c))]
            place = {i: j for j, i in enumerate(first)}
            info = [[values[place[i]] if i in place else None for i in range(len(sets))] for values in _info([sets[i] for i in first], bands)]
            arrays = [b["_doc"], b["_k"], pa.array([len(x) for x in sets], pa.int64()), pa.array(cid, pa.int64()), *[pa.array(x, t) for x, t in zip(info, (pa.int32(), _LONGS, _LONGS), strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "k", "n", "cid", "band", "own", "next"])

    return run


def _keys(width: int, bands: Bands):
    """cid, keys for the first text of each class in a task."""

    def run(batches):
        seen: set[int] = set()
        for b in tx.chunks(batches, "_text"):
            fresh = {c: x for x in _sets(b["_text"].to_pylist(), width) if len(x) and (c := class_id(x)) not in seen}
            seen.update(fresh)
            sets = list(fresh.values())
            if not sets:
                continue
            band, further = _schemes(sets, bands)
            keys = part_keys(sets, band, bands)
            for i, x in zip(further.tolist(), part_keys([sets[i] for i in further.tolist()], band[further] + 1, bands), strict=True):
                keys[i] = np.concatenate([keys[i], x])
            yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.int64()), pa.array(keys, _LONGS)], ["cid", "keys"])

    return run


def _set_rows(width: int):
    """Elements of the classes asked for."""

    def run(batches):
        for b in tx.chunks(batches, "_text"):
            asked = b["cid"].to_pylist()
            found = {c: x.tobytes() for x, c in zip(_sets(b["_text"].to_pylist(), width), asked, strict=True) if class_id(x) == c}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["cid", "elements"])

    return run


def _verify(num: int, den: int):
    def run(batches):
        for b in tx.each(batches):
            good = []
            for x, y in zip(b["ea"], b["eb"], strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(s) > len(t):
                    s, t = t, s
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                both = int((t[at] == s).sum())
                good.append(den * both >= num * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _within(x: str, y: str, num: int, den: int) -> Column:
    """The Hamming bound: sketches of the band that both sets have, against the most that their sizes allow."""
    sx, sy = F.expr(f"CASE WHEN {x}.band < {y}.band THEN {x}.next ELSE {x}.own END"), F.expr(f"CASE WHEN {y}.band < {x}.band THEN {y}.next ELSE {y}.own END")
    apart = F.aggregate(F.zip_with(sx, sy, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    return (F.abs(F.col(f"{x}.band") - F.col(f"{y}.band")) <= 1) & (apart * (den + num) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (den - num))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN, rounds: int = ROUNDS, spread: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id for each row: components of the links of similarity num/den or more."""
    nodes, classes = _components(docs, id_col, text_col, width, num, den, rounds, spread)
    out = nodes.select("doc", "n", "cid").join(classes.select("cid", "least"), "cid", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN, rounds: int = ROUNDS, spread: bool = True) -> DataFrame:
    """docs with one row of each component: that of the least id (a row without an id only where none has one), then of
    the least hash of id and text. Rows alike in id and text are one row of a component. Texts without words all stay."""
    nodes, classes = _components(docs, id_col, text_col, width, num, den, rounds, spread)
    key = free_name(docs, "rowkey")
    keyed = docs.withColumn(key, row_key(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")))
    spoken = nodes.where("n > 0").select("k", "cid")
    gone = cut(spoken.join(classes.select("cid", F.col("first.k").alias("keep")), "cid").where("k != keep").select("k").distinct())
    left = without(keyed, key, gone)
    again = cut(spoken.groupBy("k").agg(F.count("*").alias("rows")).where("rows > 1").select("k"))
    flag = free_name(left, "again")
    marked = maybe_among(left, F.col(key), again, flag)
    several = marked.where(F.col(flag)).drop(flag)
    sure, maybe = marked.where(~F.col(flag)).drop(flag), several.join(again, several[key] == again["k"], "left_anti")
    rest = [c for c in docs.columns]
    firsts = several.join(again, several[key] == again["k"], "left_semi").groupBy(key).agg(F.first(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])).alias("x"))
    once = firsts.select(*[F.col(f"x.c{i}").alias(c) for i, c in enumerate(rest)])
    return sure.drop(key).unionByName(maybe.drop(key)).unionByName(once)


def row_key(doc: Column, text: Column) -> Column:
    return F.xxhash64(doc, text)


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int, rounds: int, spread: bool) -> tuple[DataFrame, DataFrame]:
    """A row (doc, k, n, cid) for each of docs, and for each class of equal sets (cid) the least id and the first row
    (first: nameless, doc, k) of its component."""
    bands = Bands(num, den)
    doc, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    base = docs.select(doc.alias("_doc"), row_key(doc, text).alias("_k"), text.alias("_text"))
    with setting(docs.sparkSession, CLEANUP, "true"):
        nodes = cut(base.mapInArrow(_classes(width, bands), f"doc long, k long, n long, cid long, {_INFO}"))
        with spilled(_runs(base, width, bands, spread)) as runs:
            links = _links(base, nodes, runs, width, num, den, rounds)
        return nodes, _named(nodes, links)


def _named(nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    first = F.min(F.struct(F.col("doc").isNull().alias("nameless"), "doc", "k")).alias("first")
    classes = nodes.where("n > 0").groupBy("cid").agg(F.min("doc").alias("least"), first)
    if links is not None:  # written tables on both sides: adaptive execution can split a component of very many classes
        of = components(links).withColumnsRenamed({"node": "cid"})
        known = cut(classes.join(of, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
        roots = cut(known.groupBy("root").agg(F.min("least").alias("least"), F.min("first").alias("first")))
        classes = known.select("cid", "root").join(roots, "root").select("cid", "least", "first")
    return cut(classes)


def _runs(base: DataFrame, width: int, bands: Bands, spread: bool = True) -> DataFrame:
    """key, cid, lead, rank: classes by key where there are several, numbered, with the first of them. With spread the
    order is another one in each bucket, so the classes of a crowd, which meet in many, are compared with many leads."""
    bucket = Window.partitionBy("key").orderBy(F.col("cid").bitwiseXOR(F.shiftleft("key", 16)) if spread else "cid")
    parts = base.mapInArrow(_keys(width, bands), "cid long, keys array<long>").select("cid", F.explode("keys").alias("key"))
    lead = F.first("cid").over(bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = parts.select("key", "cid", lead.alias("lead"), F.dense_rank().over(bucket).alias("rank"), F.lead("cid").over(bucket).alias("after"))
    return runs.where("cid != lead OR after IS NOT NULL").drop("after")


def _links(base: DataFrame, nodes: DataFrame, runs: DataFrame, width: int, num: int, den: int, rounds: int) -> DataFrame | None:
    """Verified links (a, b) between classes, enough of them for the components; None if there is no pair to verify. All of it is written when this returns."""
    side = lambda df, name, c: df.select(F.struct("n", "band", "own", "next").alias(name), F.col("cid").alias(c))

    def elements(classes: DataFrame) -> DataFrame:
        """Elements of classes (cid), out of one row of each. Only texts that may be asked for are shuffled."""
        where = cut(nodes.join(classes, "cid", "left_semi").groupBy("cid").agg(F.min("k").alias("k")))
        maybe = maybe_among(base, F.col("_k"), where.select("k"), "_maybe").where("_maybe").select("_k", "_text")
        texts = maybe.join(where, F.col("_k") == F.col("k")).select("_text", "cid")
        return cut(texts.mapInArrow(_set_rows(width), "cid long, elements binary").dropDuplicates(["cid"]))

    def verified(pairs: DataFrame) -> DataFrame:
        sets = elements(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        a, b = sets.select(F.col("cid").alias("a"), F.col("elements").alias("ea")), sets.select(F.col("cid").alias("b"), F.col("elements").alias("eb"))
        return cut(pairs.join(a, "a").join(b, "b").select("a", "b", "ea", "eb").mapInArrow(_verify(num, den), "a long, b long"))

    sketched = nodes.where("own IS NOT NULL").dropDuplicates(["cid"])

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs that pass the Hamming bound."""
        return pairs.distinct().join(side(sketched, "x", "a"), "a").join(side(sketched, "y", "b"), "b").where(_within("x", "y", num, den)).select("a", "b")

    head = runs.where(F.col("rank") <= RUN)
    inside = head.select("key", F.col("cid").alias("a")).join(head.select("key", F.col("cid").alias("b")), "key").where("a < b").select("a", "b")  # RUN classes a key
    close = cut(near(inside.union(runs.where(F.col("rank") > RUN).select(F.col("lead").alias("a"), F.col("cid").alias("b")))))
    if not close.take(1):
        return None
    links = verified(close)
    sweep(base.sparkSession)
    longer = runs.where(F.col("rank") == RUN + 1).select("key").distinct()
    rest = runs.where("cid != lead").join(longer, "key", "left_semi").select("key", "cid").distinct()
    if not (rest := cut(rest)).take(1):
        return links
    turn, linked = 0, True
    while True:
        rest = _apart(rest, links)
        sweep(base.sparkSession)
        if not rest.take(1):
            return links
        crowd = rest.where("crowd").agg(F.sum(F.when(F.col("root") != F.col("main"), F.col("n")).cast("double")).alias("pairs"), F.count("*").alias("n")).first()
        last = turn >= rounds or not linked or (crowd.pairs or 0) <= FEW * crowd.n
        more = cut(_meet(rest, sketched, None if last else turn, num, den))
        new = verified(more) if more.take(1) else None
        linked = new is not None and bool(new.take(1))
        links = cut(links.union(new)) if linked else links
        if last:
            return links
        turn += 1


def _apart(rest: DataFrame, links: DataFrame) -> DataFrame:
    """Entries (key, cid, root, main, n, crowd) of buckets with several components: main is the largest of the bucket, n
    the bucket's size, and crowd whether main is a good part of it."""
    rooted = rest.select("key", "cid").join(components(links).withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    rooted = cut(rooted)
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("x"), F.sum("n").alias("n")).where("x.n < n")
    return cut(rooted.join(mains.select("key", F.col("x.root").alias("main"), "n", (F.col("x.n") >= F.col("n") * CROWD).alias("crowd")), "key"))


def _meet(rest: DataFrame, sketched: DataFrame, turn: int | None, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes of different components that meet in a bucket and pass the Hamming bound: those outside
    the largest component with HUBS classes of it, in crowds (a turn), or with all others, in any bucket (None)."""
    rest = rest if turn is None else rest.where("crowd")
    out = rest.where("root != main").select("key", "cid", "root", F.lit(False).alias("in_main"))
    all_ = rest.withColumn("in_main", F.col("root") == F.col("main"))
    if turn is not None:
        order = Window.partitionBy("key").orderBy(F.xxhash64("cid", F.lit(turn)), "cid")
        all_ = all_.where("in_main").withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS)
    with_sketch = lambda df, a, z: df.join(sketched.select("cid", F.struct("n", "band", "own", "next").alias(z)), "cid").withColumnsRenamed({"cid": a, "root": f"r{a}"})
    out, all_ = with_sketch(out, "a", "x").drop("in_main"), with_sketch(all_.select("key", "cid", "root", "in_main"), "b", "y")
    met = out.join(all_, (out.key == all_.key) & (F.col("ra") != F.col("rb")) & (F.col("in_main") | (F.col("a") < F.col("b"))) & _within("x", "y", num, den))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
