"""Queries over ports, connectors, orders of tasks, hierarchies and lineage edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.scalars import port_references
from loomline.operators import graph, lineage
from loomline.plans import fixtures
from loomline.plans.catalogue import query
from loomline.session import cut, read
from loomline.sources import mapping_xml as mx


def _folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports parsed once, for plans that look into them several times."""
    return cut(mx.read_folders(fixtures.mapping_xml(spark, sf_dir)))


@query("SELECT p_partkey, 'IN1,P' || p_partkey || ',A$' || p_size AS refs FROM part")
def port_references_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    text = F.concat(F.lit("IIF(IN1 > 0, TO_CHAR(P"), k, F.lit("), decode(IN1, lower_x, A$"), F.col("p_size").cast("string"), F.lit("))"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(port_references(text), ",").alias("refs"))


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of orders: each to the one before it in its ten, every fourth also to the one two before; each seventh ten closes a cycle."""
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select(k)
    one = o.where(k % 10 != 0).select(k.alias("src"), (k - 1).alias("dst"))
    two = o.where((k % 10 > 1) & (k % 4 == 0)).select(k.alias("src"), (k - 2).alias("dst"))
    back = o.where((k % 10 == 0) & (F.floor(k / 10) % 7 == 0)).select(k.alias("src"), (k + 3).alias("dst"))
    return one.union(two).union(back)


_CHAINS = """e AS (
  SELECT o_orderkey AS src, o_orderkey - 1 AS dst FROM orders WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT o_orderkey, o_orderkey - 2 FROM orders WHERE o_orderkey % 10 > 1 AND o_orderkey % 4 = 0
  UNION ALL SELECT o_orderkey, o_orderkey + 3 FROM orders WHERE o_orderkey % 10 = 0 AND (o_orderkey // 10) % 7 = 0
)"""


@query(f"WITH RECURSIVE {_CHAINS}, r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src) SELECT src, dst FROM r")
def connector_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.closure(_chains(spark, sf_dir))


@query(
    f"""
WITH RECURSIVE {_CHAINS}, r AS (
  SELECT o_orderkey AS s, o_orderkey AS n, 0 AS h FROM orders WHERE o_orderkey % 10 = 9
  UNION SELECT r.s, e.dst, r.h + 1 FROM r JOIN e ON r.n = e.src WHERE r.h < 12
)
SELECT s AS start, n AS node, min(h)::INTEGER AS hops FROM r GROUP BY s, n
"""
)
def backward_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = read(spark, sf_dir, "orders").where("o_orderkey % 10 = 9").select(F.col("o_orderkey").alias("start"))
    return graph.reach(_chains(spark, sf_dir), starts)


@query(
    f"""
WITH RECURSIVE {_CHAINS}, r AS (
  SELECT o_orderkey AS s, o_orderkey AS n, 0 AS h FROM orders WHERE o_orderkey % 10 = 9
  UNION SELECT r.s, e.dst, r.h + 1 FROM r JOIN e ON r.n = e.src WHERE r.h < 12
), m AS (SELECT s, n, min(h) AS h FROM r GROUP BY s, n)
SELECT s AS start, n AS source, h::INTEGER AS hops FROM m WHERE n % 5 = 0 QUALIFY row_number() OVER (PARTITION BY s ORDER BY h, n) = 1
"""
)
def first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = read(spark, sf_dir, "orders").where("o_orderkey % 10 = 9").select(F.col("o_orderkey").alias("start"))
    sources = read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("node"))
    return graph.first_source(graph.reach(_chains(spark, sf_dir), starts), sources)


@query(
    """
WITH p AS (SELECT p_partkey AS k, 2 + p_partkey % 3 AS c FROM part)
SELECT 'M' || k AS mapping, 'TGT' AS target_instance, 'X' AS target_field, 'SRC' AS source_instance, 'C1' AS source_field, 3 AS hops FROM p
UNION ALL SELECT 'M' || k, 'TGT', 'X', 'SRC', 'C' || c, 3 FROM p
UNION ALL SELECT 'M' || k, 'TGT', 'Y', 'SRC', 'C' || c, 3 FROM p
"""
)
def mapping_column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = _folders(spark, sf_dir)
    bound = mx.bound_tables(folders)
    return lineage.column_lineage(mx.connectors(folders), mx.ports(folders), bound.where("role = 'source'"), bound.where("role = 'target'"))


@query(
    """
WITH p AS (SELECT * FROM part)
SELECT 'F' || p_size AS folder, 'M' || p_partkey AS mapping, 'SRC' AS instance, 'source' AS role, 'A' || p_partkey AS name, 'own' AS schema FROM p
UNION ALL SELECT 'F' || p_size, 'M' || p_partkey, 'TGT', 'target', 'T' || p_partkey, NULL FROM p
"""
)
def infa_xml_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mx.bound_tables(_folders(spark, sf_dir)).select("folder", "mapping", "instance", "role", "name", "schema")


@query("SELECT 'F' || p_size AS folder, 'M' || p_partkey AS mapping, 'select C1 from A' || p_partkey AS sql FROM part")
def infa_sql_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mx.snippets(mx.read_folders(fixtures.mapping_xml(spark, sf_dir))).select("folder", "mapping", "sql")


@query("SELECT 's_' || p_partkey AS session, 'M' || (p_partkey + 1000000) AS mapping FROM part WHERE p_partkey % 10 = 0")
def missing_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = _folders(spark, sf_dir)
    return lineage.session_mappings(mx.sessions(folders), mx.mappings(folders))[1].select("session", "mapping")


@query(
    f"""
WITH RECURSIVE {_CHAINS}, r AS (
  SELECT o_orderkey AS s, o_orderkey AS n, 0 AS h FROM orders WHERE o_orderkey % 10 = 9
  UNION SELECT r.s, e.dst, r.h + 1 FROM r JOIN e ON r.n = e.src WHERE r.h < 12
), m AS (SELECT s, n, min(h) AS h FROM r GROUP BY s, n)
SELECT s AS start, string_agg('[' || h || '] ' || n, ' → ' ORDER BY h DESC, n) AS chain FROM m GROUP BY s
"""
)
def transformation_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = read(spark, sf_dir, "orders").where("o_orderkey % 10 = 9").select(F.col("o_orderkey").alias("start"))
    reached = graph.reach(_chains(spark, sf_dir), starts)
    steps = F.array_sort(F.collect_list(F.struct((-F.col("hops")).alias("h"), "node")))
    return reached.groupBy("start").agg(F.array_join(F.transform(steps, lambda x: F.concat(F.lit("["), (-x["h"]).cast("string"), F.lit("] "), x["node"].cast("string"))), " → ").alias("chain"))


@query(
    f"""
WITH RECURSIVE {_CHAINS}, d AS (SELECT src, dst FROM e WHERE (src // 10) % 7 <> 0), r AS (
  SELECT o_orderkey AS n, 0 AS l FROM orders WHERE (o_orderkey // 10) % 7 <> 0
  UNION SELECT d.dst, r.l + 1 FROM r JOIN d ON r.n = d.src
)
SELECT n AS node, max(l)::INTEGER AS level FROM r GROUP BY n
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 3 THEN 9 - (o_orderkey % 10) ELSE -1 END::INTEGER FROM orders WHERE (o_orderkey // 10) % 7 = 0
"""
)
def topological_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-1: on a cycle, or behind one."""
    found = graph.levels(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node")), _chains(spark, sf_dir))
    return found.withColumn("level", F.coalesce("level", F.lit(-1)))


@query(
    """
WITH t AS (SELECT o_custkey AS w, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT 'wf' || w AS workflow, 't' || k AS node, (CASE WHEN i = 0 THEN 0 ELSE floor(log2(i + 1)) END)::INTEGER AS depth, (i + 1)::BIGINT AS position FROM t
"""
)
def workflow_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of a workflow form a binary tree by rank: its breadth-first order is the order of ranks."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    t = read(spark, sf_dir, "orders").select(F.concat(F.lit("wf"), F.col("o_custkey").cast("string")).alias("workflow"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("node"), rank.alias("ord"))
    up = t.where("ord > 0").withColumn("above", F.floor((F.col("ord") - 1) / 2)).join(t.select("workflow", F.col("ord").alias("above"), F.col("node").alias("src")), ["workflow", "above"])
    links = up.select("workflow", "src", F.col("node").alias("dst"))
    return graph.breadth_first(links, t, ("workflow",)).select("workflow", "node", "depth", F.col("position").cast("long").alias("position"))


@query(
    """
SELECT source_dataset_kind AS kind, count(*)::BIGINT AS edges FROM (SELECT CASE l_returnflag WHEN 'R' THEN 'SQL' WHEN 'A' THEN 'CONNECTOR' ELSE 'PROCEDURE' END AS source_dataset_kind FROM lineitem) GROUP BY 1
"""
)
def edges_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.edges_by_kind(fixtures.edge_log(spark, sf_dir))


@query(
    """
SELECT count(*)::BIGINT AS total_edges, count(DISTINCT l_suppkey)::BIGINT AS source_datasets, count(DISTINCT l_partkey)::BIGINT AS target_datasets,
  count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_suppkey % 11 END)::BIGINT AS procedures, count(DISTINCT l_suppkey % 5)::BIGINT AS folders,
  count(DISTINCT l_partkey % 50)::BIGINT AS workflows, count(DISTINCT l_partkey)::BIGINT AS mappings
FROM lineitem
"""
)
def lineage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.summary(fixtures.edge_log(spark, sf_dir))


@query(
    """
WITH l AS (
  SELECT 'dw.p' || l_partkey AS target_dataset, 't' || (l_linenumber % 3) AS target_column, 'src.s' || l_suppkey AS s, 'src.s' || l_suppkey || '.c' || l_linenumber AS f,
    'e' || l_orderkey AS x, CASE l_returnflag WHEN 'R' THEN 'SQL' WHEN 'A' THEN 'CONNECTOR' ELSE 'PROCEDURE' END AS kind, round(l_discount + 0.5, 2) AS c, l_linenumber AS st, l_orderkey * 10 + l_linenumber AS o
  FROM lineitem
), u AS (
  SELECT target_dataset, target_column, string_agg(f, ',' ORDER BY o, f) AS upstream_fields FROM (SELECT target_dataset, target_column, f, min(o) AS o FROM l GROUP BY ALL) GROUP BY 1, 2
)
SELECT l.target_dataset, l.target_column, count(*)::BIGINT AS n_edges, count(DISTINCT s)::BIGINT AS n_sources, any_value(u.upstream_fields) AS upstream_fields,
  string_agg(x, ' -> ' ORDER BY o, x) AS expression_chain, string_agg('[' || kind || '] ' || x, ' → ' ORDER BY -st, o, '[' || kind || '] ' || x) AS transformation_chain, min(c) AS confidence
FROM l JOIN u ON l.target_dataset = u.target_dataset AND l.target_column = u.target_column GROUP BY 1, 2
"""
)
def edges_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = lineage.by_target(fixtures.edge_log(spark, sf_dir))
    return g.select("target_dataset", "target_column", "n_edges", F.size("source_datasets").cast("long").alias("n_sources"), F.array_join("upstream_fields", ",").alias("upstream_fields"), "expression_chain", "transformation_chain", "confidence")


@query(
    """
SELECT n, CASE k WHEN 0 THEN 'own.t' || n WHEN 1 THEN 'DW.T' || n END AS known FROM (
  SELECT s_suppkey AS n, CASE WHEN s_suppkey % 4 = 0 THEN 0 WHEN s_suppkey % 4 = 1 THEN 1 ELSE 2 END AS k FROM supplier) WHERE k < 2
"""
)
def table_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    n = F.col("s_suppkey").cast("string")
    names = s.select(F.concat(F.lit("t"), n).alias("name"))
    known = s.where("s_suppkey % 4 = 0").select(F.concat(F.lit("own.t"), n).alias("table"), F.col("s_suppkey").alias("ord"))
    known = known.union(s.where("s_suppkey % 4 IN (0, 1)").select(F.concat(F.lit("DW.T"), n), F.col("s_suppkey") + 1_000_000))
    found = lineage.match_tables(names, known)
    return found.select(F.expr("substring(name, 2)").cast("long").alias("n"), F.col("table").alias("known"))


@query("SELECT 'c' || n_nationkey AS column, 'n' || n_regionkey AS scope, 't' || n_nationkey AS table FROM nation WHERE n_nationkey % 2 = 0")
def unqualified_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    k, scope = F.col("n_nationkey").cast("string"), F.concat(F.lit("n"), F.col("n_regionkey").cast("string")).alias("scope")
    schema = n.select(scope, F.concat(F.lit("t"), k).alias("table"), F.concat(F.lit("C"), k).alias("column")).union(n.where("n_nationkey % 2 = 1").select(scope, F.concat(F.lit("u"), k), F.concat(F.lit("c"), k)))
    return lineage.only_owner(n.select(scope, F.concat(F.lit("c"), k).alias("column")), schema).select("column", "scope", "table")


@query("SELECT p_partkey, p_brand, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) <= 20")
def member_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.first_by(read(spark, sf_dir, "part"), ["p_brand"], ["p_retailprice", "p_partkey"], 20).select("p_partkey", "p_brand", "p_name")
