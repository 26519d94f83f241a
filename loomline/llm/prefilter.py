"""A bitmap of hashed keys, of a fixed size, that tells which rows can't be in a table of keys and so need no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 2**24 are at most 2**19 rows of 32 bits to broadcast, however many keys there are.
BITS, WORD = 1 << 24, 32


def maybe_among(df: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """df with a flag: false only for rows whose key is not in keys (its single column). Null keys count as a key."""
    word, bit = f"{flag}_word", f"{flag}_bit"
    at = lambda k: F.pmod(F.xxhash64(k), F.lit(BITS))
    own = keys.select(at(F.col(keys.columns[0]).cast("long")).alias("h"))
    words = own.select(F.floor(F.col("h") / WORD).alias(word), F.expr(f"shiftleft(1L, CAST(h % {WORD} AS INT))").alias("b")).groupBy(word).agg(F.bit_or("b").alias(f"{flag}_bits"))
    marked = df.withColumn(bit, at(key.cast("long"))).withColumn(word, F.floor(F.col(bit) / WORD))
    joined = marked.join(F.broadcast(words), word, "left")  # BITS / WORD rows at most
    hit = F.expr(f"shiftright({flag}_bits, CAST({bit} % {WORD} AS INT)) & 1 = 1")
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(word, bit, f"{flag}_bits")


def free_name(df: DataFrame, stem: str) -> str:
    """A name that no column of df begins with, whatever the case."""
    while any(c.lower().startswith(stem) for c in df.columns):
        stem += "_"
    return stem


def without(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of df whose key is not in keys (an anti join that shuffles only rows that may be), and rows without a key.

    Columns of df may have any names; an empty keys keeps all rows.
    """
    flag, name = free_name(df, "maybe"), free_name(df, "gone")
    gone = keys.select(F.col(keys.columns[0]).cast("long").alias(name))
    marked = maybe_among(df, F.col(f"`{key}`"), gone, flag)
    sure = marked.where(~F.col(flag)).drop(flag)
    rest = marked.where(F.col(flag)).drop(flag)
    return sure.unionByName(rest.join(gone, F.col(f"`{key}`").cast("long") == F.col(name), "left_anti"))
