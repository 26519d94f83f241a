"""The queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import decontam, langid, licenses, line_dedup, packing, quality, sharding, sketch_join, suffix_tree, topk_search
from loomline.session import read

QUERIES: dict = {}
ORACLES: dict = {}
TOKENIZER = "byte_bpe_50k.json"


def _query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize_pieces(read(spark, sf_dir, "documents"), tokenizer_path())
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests)


@_query
def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.exact_topk(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op6_topk_search"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 10
"""


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), carry=["doc_id", "text"])
    return line_dedup.apply_keep_bitmaps(marked).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op8_line_dedup"] = """
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS pos, unnest(x) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), d AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.*, d.key IS NOT NULL AND k.doc_id <> d.keeper AS gone FROM k LEFT JOIN d ON k.key = d.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_join.jaccard_components(read(spark, sf_dir, "documents"), width=3, num=9, den=10)


ORACLES["op7_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(t) < 3 THEN array_to_string(t, ' ') ELSE t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] END AS g
  FROM (SELECT doc_id, t, unnest(range(1, greatest(len(t) - 2, 1) + 1)) AS i FROM w WHERE len(t) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = d.doc_id
"""


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id", 4, 2))
    return langid.identify(docs, langid.train(docs, ~F.col("held_out")), ["doc_id", "held_out"])


@_query
def op2_suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(read(spark, sf_dir, "documents"), langid.held_out("doc_id", 7, 2))


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontam.question_and_answer(read(spark, sf_dir, "benchmark"))
    return decontam.contaminated(read(spark, sf_dir, "documents"), items)


@_query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


ORACLES["op4_sharding"] = """
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents
), s AS (
  SELECT *, h >> (60 - d) AS p, sum(n_bytes) OVER (PARTITION BY d, h >> (60 - d)) AS total FROM r CROSS JOIN (SELECT unnest(range(0, 61)) AS d)
)
SELECT doc_id, n_bytes, d::INTEGER AS depth, p::BIGINT AS prefix, 0::BIGINT AS page, total::BIGINT AS shard_bytes, total > 1048576 AS oversize
FROM s WHERE total <= 1048576 OR d = 60 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
"""


@_query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: they lie in three levels of directories, and at each some are licence files."""
    n, top = F.col("doc_id"), F.coalesce("source", F.lit("unknown"))
    level = lambda k: F.floor(n / k).cast("string")
    path = (
        F.when(n % 5000 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
        .when(n % 500 == 0, F.concat_ws("/", top, level(1000), F.lit("COPYING")))
        .when(n % 20 == 0, F.concat_ws("/", top, level(1000), level(100), F.lit("LICENSE.md")))
        .otherwise(F.concat_ws("/", top, level(1000), level(100), F.concat(n.cast("string"), F.lit(".txt"))))
    )
    return licenses.scan_licenses(read(spark, sf_dir, "documents").withColumn("path", path), "doc_id", "path").withColumnRenamed("id", "doc_id")


@_query
def op10_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
