"""A cleaning pipeline over `documents`: language ID, line dedup, near-duplicate join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last return the
columns of docs, whatever they are called.

Defined cases, stage by stage. Null and empty texts go in the language stage, as texts without a letter do; handed to a
later stage, they are one empty line, are near duplicates of nothing, hold no item, and are packed as an end id. Very
long texts are read whole by every stage. Rows that repeat an id, and rows without one, are rows of their own: the line
stage counts rows of one id as one document and keeps rows without an id whole; of a group of near duplicates one row
stays, that of the least id, and of rows alike in id and text one; the others treat each row by its text alone. Of lines
that many documents hold those of the greatest id stay. Empty tables pass through every stage; with an empty benchmark
all documents stay; with no label in the whole table all texts with a letter stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import decontam, langid, line_dedup, packing, sketch_join
from loomline.llm.queries import tokenizer_path
from loomline.session import cut, read, ship

#: A text is rejected if no language is more likely than this (or if it has no letters).
LEAST_SCORE = 0.3


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ...: an operator's own columns can't clash with them."""
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(k) for c, k in place.items()]), place


def _named(docs: DataFrame, place: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(k).alias(c) for c, k in place.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; where no row has a label to learn from, those with a letter."""
    ship(spark)
    rows, at = _numbered(docs)
    model = langid.train(rows, F.lit(True), at["doc_id"], at["text"], at["lang"])
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    seen = langid.identify(rows, model, list(at.values()), at["text"])
    return _named(seen.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), at)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in several others; n_chars follows the text."""
    ship(spark)
    rows, at = _numbered(docs)
    out = _named(line_dedup.dedup_lines(rows, at["doc_id"], at["text"], carry=list(at.values()), apply=True), at)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id."""
    ship(spark)
    return sketch_join.one_of_each(docs, rounds=0, spread=False)  # at this similarity the last step alone costs less


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    ship(spark)
    return decontam.clean(docs, decontam.question_and_answer(read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ship(spark)
    pieces = packing.tokenize_pieces(docs, tokenizer_path())
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [("language_id", language), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", benchmark), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs


#: No stage of a learned classifier, or of a tokenizer, can be put into SQL; tests compare run() with plain Python.
ORACLE_SQL = None
QUERIES, ORACLES = {"pipeline": run}, {}
