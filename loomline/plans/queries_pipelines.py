"""Whole pipelines over rendered artifacts, counted by aspect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import calc, lineage, records
from loomline.plans import fixtures, pipelines
from loomline.plans.catalogue import query
from loomline.session import cut


def _counts(rows: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{e}' AS entity_type, '{a}' AS aspect_name, ({n})::BIGINT AS emitted, ({d})::BIGINT AS entities" for e, a, n, d in rows)


_ORDERS = "SELECT count(*) FROM orders"
_BOXES = "SELECT count(DISTINCT o_custkey) + 1 FROM orders WHERE o_orderkey % 7 <> 0"
_WAITING = f"{_ORDERS} WHERE o_orderkey % 3 <> 0"


@query(_counts([("dataFlow", "dataFlowInfo", _BOXES, _BOXES), ("dataJob", "dataJobInfo", _ORDERS, _ORDERS), ("dataJob", "dataJobInputOutput", _WAITING, _WAITING)]))
def aspects_scheduler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.report(pipelines.scheduler(fixtures.job_files(spark, sf_dir)))


_CUST = "SELECT count(*) FROM customer"


@query(
    _counts(
        [
            ("dataFlow", "dataFlowInfo", _CUST, _CUST), ("dataJob", "dataJobInfo", "SELECT 3 * count(*) FROM customer", "SELECT 3 * count(*) FROM customer"),
            ("dataset", "datasetProperties", "SELECT 3 * count(*) FROM customer", "SELECT 2 * count(*) + count(DISTINCT c_nationkey) FROM customer"),
            ("dataJob", "dataJobInputOutput", "SELECT 2 * count(*) FROM customer", "SELECT 2 * count(*) FROM customer"), ("dataset", "upstreamLineage", _CUST, _CUST),
        ]
    )
)
def aspects_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.report(pipelines.packages(fixtures.package_xml(spark, sf_dir), default_db="DW", default_schema="dbo"))


_PART = "SELECT count(*) FROM part"


@query(
    _counts(
        [("dataFlow", "dataFlowInfo", "SELECT count(DISTINCT p_size) FROM part", "SELECT count(DISTINCT p_size) FROM part"), ("dataJob", "dataJobInfo", _PART, _PART), ("dataJob", "dataJobInputOutput", _PART, _PART), ("dataset", "upstreamLineage", _PART, _PART)]
    )
)
def aspects_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.report(pipelines.mapping_export(fixtures.mapping_xml(spark, sf_dir)))


@query(
    """
SELECT 'CONNECTOR' AS kind, (SELECT 3 * count(*) FROM part WHERE p_partkey % 10 <> 0)::BIGINT AS edges, (SELECT count(*) FROM part WHERE p_partkey % 10 <> 0)::BIGINT AS sessions, (SELECT count(*) FROM part WHERE p_partkey % 10 = 0)::BIGINT AS missing
"""
)
def session_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, missing = pipelines.session_lineage(fixtures.mapping_xml(spark, sf_dir))
    gone = missing.agg(F.count("*").alias("missing"))
    return edges.groupBy("kind").agg(F.count("*").alias("edges"), F.countDistinct("session").alias("sessions")).crossJoin(F.broadcast(gone))  # one row


@query(
    """
SELECT t AS transformation_type, n::BIGINT AS edges FROM (
  SELECT 'consolidation' AS t, (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) AS n
  UNION ALL SELECT 'member_formula', (SELECT 3 * count(*) FROM part WHERE p_partkey % 2 = 0)
  UNION ALL SELECT 'calc_script_formula', (SELECT 2 * count(*) FROM supplier) UNION ALL SELECT 'aggregation', (SELECT 2 * count(*) FROM supplier)
  UNION ALL SELECT 'calc_dim', (SELECT count(*) FROM supplier) UNION ALL SELECT 'datacopy', (SELECT count(*) FROM supplier)
  UNION ALL SELECT 'load_rule_data', (SELECT 2 * count(*) FROM supplier WHERE s_suppkey % 3 <> 0) UNION ALL SELECT 'load_rule_dimension', (SELECT 2 * count(*) FROM supplier WHERE s_suppkey % 3 = 0))
"""
)
def olap_all_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = calc.all_lineage(fixtures.members(spark, sf_dir), fixtures.calc_scripts(spark, sf_dir), fixtures.load_rules(spark, sf_dir))
    return edges.groupBy("transformation_type").agg(F.count("*").alias("edges"))


@query(
    """
WITH m AS (
  SELECT 'Geo' AS dim, r_name AS name, NULL AS parent, r_regionkey AS o FROM region
  UNION ALL SELECT 'Geo', 'N' || n_nationkey, r_name, n_nationkey + 100 FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'Geo', 'C' || c_custkey, 'N' || c_nationkey, c_custkey + 1000 FROM customer
  UNION ALL SELECT 'Acct', 'P' || p_partkey, CASE WHEN p_size = 1 THEN 'missing' END, p_partkey FROM part
), r AS (SELECT * FROM m WHERE parent IS NULL OR parent = 'missing' QUALIFY row_number() OVER (PARTITION BY dim ORDER BY o) <= 100)
SELECT dim || '.' || name AS field_path, 'member' AS native_type FROM r UNION ALL SELECT dim, 'dimension(' || count(*) || ')' FROM m GROUP BY dim UNION ALL SELECT '__measures__', 'double'
"""
)
def cube_schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.cube_fields(cut(fixtures.members(spark, sf_dir))).select("field_path", "native_type")


@query(
    """
SELECT 'F' || p_size AS folder, 'source' AS role, 'A' || p_partkey AS "table", 'C1' AS field, 'number' AS datatype, p_size AS precision, 0 AS scale, false AS nullable FROM part
"""
)
def table_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomline.sources import mapping_xml

    return mapping_xml.table_fields(mapping_xml.read_folders(fixtures.mapping_xml(spark, sf_dir))).select("folder", "role", "table", "field", "datatype", "precision", "scale", "nullable")


@query("SELECT 'F' || p_size AS folder, 'M' || p_partkey AS mapping, 'T' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'own' ELSE 'shared' END AS kind FROM part")
def scoped_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transformation of the mapping, else of the folder."""
    from loomline.session import read

    p = read(spark, sf_dir, "part")
    name = lambda x, c: F.concat(F.lit(x), F.col(c).cast("string"))
    items = p.select(name("F", "p_size").alias("folder"), name("M", "p_partkey").alias("mapping"), name("T", "p_partkey").alias("name"), "p_partkey")
    return lineage.scoped(items.drop("p_partkey"), items.where("p_partkey % 2 = 0").withColumn("kind", F.lit("own")), items.withColumn("kind", F.lit("shared")), "kind")
