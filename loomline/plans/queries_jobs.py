"""Queries over scheduler jobs, identities, filters, texts and the upsert log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import scalars, urns
from loomline.operators import jobs as J
from loomline.operators import records
from loomline.plans import fixtures
from loomline.plans.catalogue import query
from loomline.session import read
from loomline.sources import jil

_BOX = "CASE WHEN {k} % 7 = 0 THEN '__autosys__' ELSE 'BOX_' || {c} END"
_JOB = "'urn:li:dataJob:(urn:li:dataFlow:(autosys,' || {box} || ',PROD),J' || {k} || ')'"


@query(
    f"""
WITH w AS (
  SELECT o_orderkey AS k, o_custkey AS c, unnest(CASE o_orderkey % 3 WHEN 0 THEN []::BIGINT[] WHEN 1 THEN [o_orderkey - 1] ELSE [o_orderkey - 1, o_orderkey - 2] END) AS up FROM orders
)
SELECT 'J' || w.k AS name, 'J' || w.up AS upstream,
  {_JOB.format(box="CASE WHEN u.o_orderkey IS NULL THEN '__autosys__' ELSE " + _BOX.format(k="u.o_orderkey", c="u.o_custkey") + " END", k="w.up")} AS src_urn,
  {_JOB.format(box=_BOX.format(k="w.k", c="w.c"), k="w.k")} AS dst_urn
FROM w LEFT JOIN orders u ON u.o_orderkey = w.up
"""
)
def jil_dependency_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.dependency_edges(jil.parse_jil(fixtures.job_files(spark, sf_dir)))


@query(
    "SELECT 'BOX_' || o_custkey AS box_name, count(*)::BIGINT AS n_jobs, min('J' || o_orderkey) AS first_job, max('J' || o_orderkey) AS last_job FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY o_custkey"
)
def jil_box_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = jil.box_members(jil.parse_jil(fixtures.job_files(spark, sf_dir)))
    return members.groupBy("box_name").agg(F.count("*").alias("n_jobs"), F.min("name").alias("first_job"), F.max("name").alias("last_job"))


@query(
    """
SELECT 'J' || o_orderkey AS name, CASE WHEN o_orderkey % 5 = 0 THEN 'FT' ELSE 'CMD' END AS job_type,
  CASE WHEN o_orderkey % 5 = 0 THEN 'NEW_' || (o_orderkey % 10) WHEN o_orderkey % 7 <> 0 THEN 'BOX_' || o_custkey END AS box_name,
  ((CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 7 <> 0 THEN 1 ELSE 0 END))::BIGINT AS n_boxes
FROM orders
"""
)
def jil_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = jil.parse_jil(fixtures.redefined_job_files(spark, sf_dir))
    boxes = jil.box_members(jobs).groupBy("name").agg(F.count("*").alias("n_boxes"))
    return jil.last_definitions(jobs).join(boxes, "name", "left").select("name", "job_type", "box_name", F.coalesce("n_boxes", F.lit(0)).cast("long").alias("n_boxes"))


@query(
    """
SELECT 'box' AS kind, 'BOX_' || o_custkey AS key, string_agg('J' || o_orderkey, ',' ORDER BY 'J' || o_orderkey) AS value FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY o_custkey
UNION ALL
SELECT 'job', 'J' || o_orderkey, 'CMD|' || (CASE WHEN o_orderkey % 7 <> 0 THEN 'BOX_' || o_custkey ELSE '' END) || '|' ||
  (CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'J' || (o_orderkey - 1) ELSE least('J' || (o_orderkey - 1), 'J' || (o_orderkey - 2)) || ',' || greatest('J' || (o_orderkey - 1), 'J' || (o_orderkey - 2)) END) || '|' ||
  (CASE WHEN o_orderstatus = 'F' THEN 'infa -start wf_' || o_custkey ELSE 'run.sh ' || o_orderkey END) || (CASE WHEN o_orderkey % 3 = 2 THEN chr(10) || 's(J' || (o_orderkey - 2) || ')' ELSE '' END)
FROM orders
"""
)
def jil_graph_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = jil.parse_jil(fixtures.job_files(spark, sf_dir))
    boxes, rest = J.graph_dump(jobs, jil.box_members(jobs))
    a = boxes.select(F.lit("box").alias("kind"), F.col("box").alias("key"), F.array_join("jobs", ",").alias("value"))
    return a.unionByName(rest.select(F.lit("job").alias("kind"), F.col("name").alias("key"), F.concat_ws("|", "type", F.coalesce("box", F.lit("")), F.array_join("upstreams", ","), "command").alias("value")))


@query(
    "SELECT 'J' || o_orderkey AS name, 'wf_' || o_custkey AS workflow, 'urn:li:dataJob:(urn:li:dataFlow:(informatica,folder,PROD),wf_' || o_custkey || ')' AS workflow_urn FROM orders WHERE o_orderstatus = 'F'"
)
def autosys_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.bridges(jil.parse_jil(fixtures.job_files(spark, sf_dir)))


@query(
    """
WITH b AS (SELECT o_custkey AS c, o_orderdate AS at, max(o_orderkey) AS run FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1, 2)
SELECT 'r' || o_orderkey AS run_id, 'J' || o_orderkey AS name, 'BOX_' || o_custkey AS box_name, 'r' || lpad(b.run::VARCHAR, 12, '0') AS parent_run
FROM (SELECT * FROM orders WHERE o_orderkey % 7 <> 0) o ASOF LEFT JOIN b ON o.o_custkey = b.c AND o.o_orderdate >= b.at
"""
)
def job_run_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run a job on its order's date; every fourth order is a run of the customer's box, too."""
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    runs = o.select(F.concat(F.lit("r"), key).alias("run_id"), F.concat(F.lit("J"), key).alias("name"), F.col("o_orderdate").alias("started"))
    boxes = o.where("o_orderkey % 4 = 0").select(F.concat(F.lit("r"), F.lpad(key, 12, "0")), F.concat(F.lit("BOX_"), F.col("o_custkey").cast("string")), "o_orderdate")
    return J.run_hierarchy(runs.union(boxes), jil.parse_jil(fixtures.job_files(spark, sf_dir)))


@query(
    """
WITH t AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 't' || s_suppkey WHEN 1 THEN 'sch.t' || s_suppkey ELSE 'd.sch.t' || s_suppkey END AS t, s_suppkey % 3 AS k FROM supplier)
SELECT t AS name, CASE k WHEN 0 THEN 'DB.SC.' || t WHEN 1 THEN 'DB.' || t ELSE t END AS parsed, CASE k WHEN 0 THEN t WHEN 1 THEN 'DB.' || t ELSE t END AS db_only_parsed,
  CASE k WHEN 0 THEN 'SC.' || t ELSE t END AS schema_only_text, CASE k WHEN 2 THEN t ELSE 'DB.' || t END AS db_only_observed,
  'urn:li:dataset:(urn:li:dataPlatform:oracle,' || (CASE WHEN s_suppkey % 2 = 0 THEN 'PRD.' ELSE '' END) || t || ',PROD)' AS urn,
  'urn:li:schemaField:(urn:li:dataset:(urn:li:dataPlatform:oracle,' || t || ',PROD),c1)' AS field
FROM t
"""
)
def dataset_urns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("s_suppkey") % 3, F.col("s_suppkey").cast("string")
    t = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(k == 0, F.concat(F.lit("t"), s)).when(k == 1, F.concat(F.lit("sch.t"), s)).otherwise(F.concat(F.lit("d.sch.t"), s)).alias("name"))
    n = F.col("name")
    return t.select(
        "name", urns.normalise_parsed(n, "DB", "SC").alias("parsed"), urns.normalise_parsed(n, "DB").alias("db_only_parsed"), urns.normalise_text(n, None, "SC").alias("schema_only_text"), urns.normalise_observed(n, "DB").alias("db_only_observed"),
        urns.dataset_urn("oracle", n, "PROD", F.when(F.col("s_suppkey") % 2 == 0, "PRD")).alias("urn"), urns.field_urn(urns.dataset_urn("oracle", n), "c1").alias("field"),
    )


@query("SELECT p_partkey, p_name FROM part WHERE NOT (p_name ILIKE 'RED%' OR ('own.' || p_name) ILIKE '%_ring' OR p_name ILIKE 'small b__t')")
def ignore_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return read(spark, sf_dir, "part").where(~scalars.ignored(name, urns.fqn(name, F.lit("own")), ["RED%", "%_ring", "small b__t"])).select("p_partkey", "p_name")


@query("SELECT event_id, event_type AS attribute, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Merge into x' || user_id END AS value FROM events WHERE event_type IN ('view', 'click') AND event_id % 3 <> 0")
def sql_snippet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    name = F.when(kind == "view", " SQL Query").when(kind == "click", "Pre SQL").when(kind == "error", "pre-sql").otherwise("Tracing level")
    value = F.when(F.col("event_id") % 3 == 0, "selected_only").otherwise(F.concat(F.lit("  Merge into x"), F.col("user_id").cast("string")))
    e = read(spark, sf_dir, "events").select("event_id", kind.alias("attribute"), name.alias("name"), value.alias("value"))
    return e.where(scalars.sql_attribute(F.col("name"), F.col("value"))).select("event_id", "attribute", scalars.blank_to_null(F.col("value")).alias("value"))


@query(
    """
WITH s AS (SELECT doc_id, string_agg(left(x, 20000), chr(10) || chr(10) || '-- ---' || chr(10) || chr(10) ORDER BY i) AS joined
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY doc_id)
SELECT doc_id, sha256(joined) AS sha, left(joined, 4000) AS preview FROM s
"""
)
def snippet_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha, preview = scalars.fingerprint(F.split("text", "\n"))
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", sha.alias("sha"), preview.alias("preview"))


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as an upsert log: the entity is the user, the aspect the event's type."""
    e = read(spark, sf_dir, "events")
    user = F.concat(F.lit("urn:li:user:"), F.col("user_id").cast("string"))
    return e.select(F.col("event_id").alias("seq"), F.concat(F.lit("events:"), F.col("event_id").cast("string")).alias("workunit_id"), user.alias("entity_urn"), F.lit("user").alias("entity_type"), F.col("event_type").alias("aspect_name"), F.col("props").alias("payload"))


@query(
    """
SELECT (row_number() OVER (ORDER BY user_id, event_type, event_id) - 1)::BIGINT AS seq, 'ev:' || (row_number() OVER (ORDER BY user_id, event_type, event_id) - 1) AS workunit_id,
  'urn:li:user:' || user_id AS entity_urn, event_type AS aspect_name
FROM events
"""
)
def workunit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _event_log(spark, sf_dir)
    part = records.aspect(log, F.col("entity_urn"), "user", "x", F.col("payload"), k1=F.lpad(F.substring_index("entity_urn", ":", -1), 12, "0"), k2=F.concat("aspect_name", F.lpad("seq", 15, "0")))
    part = part.withColumn("aspect_name", F.expr("substring(k2, 1, length(k2) - 15)"))
    return records.emit([part], "ev").select("seq", "workunit_id", "entity_urn", "aspect_name")


@query(
    "SELECT event_id AS seq, 'urn:li:user:' || user_id AS entity_urn, event_type AS aspect_name, props AS payload FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1"
)
def aspect_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.latest(_event_log(spark, sf_dir)).select("seq", "entity_urn", "aspect_name", "payload")


@query("SELECT entity_type, aspect_name, emitted, entities FROM (SELECT 'user' AS entity_type, event_type AS aspect_name, count(*)::BIGINT AS emitted, count(DISTINCT user_id)::BIGINT AS entities FROM events GROUP BY event_type)")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.report(_event_log(spark, sf_dir))


@query(
    """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'DENSE' ELSE 'SPARSE' END AS dim_type, CASE c_custkey % 4 WHEN 1 THEN 'TIME' ELSE 'STANDARD' END AS category,
  CASE c_custkey % 4 WHEN 2 THEN 'dynamic_calc' ELSE 'store' END AS storage, CASE c_custkey % 4 WHEN 3 THEN 'Lookup Procedure' ELSE 'Unknown' END AS kind,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey::INTEGER ELSE -1 END AS n, CASE WHEN c_custkey % 2 = 1 THEN TIMESTAMP '2024-01-02 03:04:05' END AS at,
  'a%20b%2F' || c_custkey AS quoted, 'file' || c_custkey AS stem, 'host:90' AS namespace
FROM customer
"""
)
def scalar_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    one = lambda n, v: F.when(k % 4 == n, v).otherwise("other")
    return c.select(
        "c_custkey", scalars.dimension_type(one(0, "dense")).alias("dim_type"), scalars.dimension_category(one(1, "Time")).alias("category"), scalars.storage(one(2, "dynamic_calc")).alias("storage"), scalars.transformation_kind(one(3, "lookup procedure")).alias("kind"),
        F.coalesce(scalars.safe_int(F.when(k % 2 == 0, s).otherwise("x1")), F.lit(-1)).alias("n"), scalars.iso_timestamp(F.when(k % 2 == 1, "2024-01-02T03:04:05Z").otherwise("soon")).cast("timestamp_ntz").alias("at"),
        scalars.quote_path(F.concat(F.lit("a b/"), s)).alias("quoted"), scalars.path_stem(F.concat(F.lit("/d.x/file"), s, F.lit(".mp"))).alias("stem"), scalars.url_namespace(F.concat(F.lit("https://host:90/api/"), s)).alias("namespace"),
    )
