"""Sharding (operator 4): extendible hashing.

A directory is indexed by leading bits of the documents' hashes; only buckets whose documents have more bytes than the
limit are split on their next bit, until every shard fits. The directory grows by STEP bits at a time: below each
bucket that is still too large, bytes are summed by cell (the next STEP bits) and from there by every shorter prefix; a
cell belongs to the shortest prefix that fits, and the cells of none are the buckets that go on, down to the whole
hash. So a bucket never has more than 2**STEP rows to be joined with, however large the table is.

The hash is the first 60 bits of the MD5 of the id as text. Rows that share a whole hash and exceed a shard together
are cut into pages: rows over half the limit get a page each, others fill pages by running sums of their bytes (sums by
partition first, so no task holds the group).

Defined cases: a null or empty text has no bytes; rows without an id hash as the empty text; rows that repeat an id share
a hash; one row larger than the limit is a shard or page of its own, marked oversize; an empty table has no shards; extra
columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import cut

LIMIT, BITS, STEP = 1 << 20, 60, 8


def key_bits(id_col: str) -> Column:
    """The hash of an id as a whole number of BITS bits."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _directory(cells: DataFrame, low: int, top: int, limit: int) -> DataFrame:
    """cell, depth, prefix, total: the shard of each cell of top bits that has one at a depth from low to top."""
    levels = cells.select(F.explode(F.sequence(F.lit(low), F.lit(top))).alias("depth"), "cell", "bytes").withColumn("prefix", F.expr(f"shiftright(cell, CAST({top} - depth AS INT))"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total")).where((F.col("total") <= limit) | (F.col("depth") == BITS))
    entry = F.min(F.struct("depth", "prefix", "total")).alias("e")
    return cut(levels.select("depth", "prefix", "cell").join(fits, ["depth", "prefix"]).groupBy("cell").agg(entry).select("cell", "e.*"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Adds page to rows of whole hashes that exceed the limit together."""
    held = cut(rows.where((F.col("depth") == BITS) & (F.col("total") > limit))).withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", 33)
    small = F.col("bytes") * 2 <= limit
    held = held.withColumn("part", part).withColumn("small", small).withColumn("weight", F.when(small, F.col("bytes")).otherwise(1))
    sums = held.groupBy("h", "small", "part").agg(F.sum("weight").alias("weight"))
    before = Window.partitionBy("h", "small").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("h", "small", "part", F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("h", "small", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("weight").over(inside), F.lit(0))
    paged = held.join(offsets, ["h", "small", "part"]).withColumn("start", start)
    paged = cut(paged.withColumn("page", F.when(F.col("small"), F.floor(F.col("start") / (limit / 2)) * 2).otherwise(F.col("start") * 2 + 1)).select("doc_id", "h", "bytes", "depth", "prefix", "page"))
    total = paged.groupBy("prefix", "page").agg(F.sum("bytes").alias("total"))
    return rows.where((F.col("depth") < BITS) | (F.col("total") <= limit)).withColumn("page", F.lit(0).cast("long")).unionByName(paged.join(total, ["prefix", "page"]))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, depth, prefix (the leading depth bits), page, shard_bytes, oversize for each row."""
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), key_bits(id_col).alias("h"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes")))
    low, top, left, done = 0, STEP, rows, None
    while True:
        cell = F.shiftright("h", BITS - top).alias("cell")
        cells = cut(left.groupBy(cell).agg(F.sum("bytes").alias("bytes")))
        found = _directory(cells, low, top, limit)
        placed = left.withColumn("cell", cell).join(found, "cell").drop("cell")
        done = placed if done is None else done.unionByName(placed)
        if top == BITS or cells.count() == found.count():
            break
        left = cut(left.withColumn("cell", cell).join(found, "cell", "left_anti").drop("cell"))
        low, top = top + 1, min(BITS, top + STEP)
    done = _pages(done, limit) if top == BITS else done.withColumn("page", F.lit(0).cast("long"))
    return done.select("doc_id", F.col("bytes").alias("n_bytes"), F.col("depth").cast("int").alias("depth"), "prefix", "page", F.col("total").alias("shard_bytes"), (F.col("total") > limit).alias("oversize"))
