"""Queries over SQL texts, OLAP metadata, packages, layouts, transforms, load rules and observed statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import scalars, sqlscan, urns
from loomline.operators import calc, graph
from loomline.plans import fixtures
from loomline.plans.catalogue import query
from loomline.session import read
from loomline.sources import files, package_xml
from loomline.streaming import observed

_T = "SELECT event_id, {role} AS role, {table} AS \"table\" FROM events WHERE event_type {where}"


@query(
    " UNION ALL ".join(
        _T.format(role=f"'{r}'", table=t, where=w)
        for r, t, w in [
            ("input", "'DW.stg.o' || user_id", "= 'view'"), ("input", "'DW.dbo.c' || (user_id % 7)", "= 'view'"),
            ("output", "'DW.mart.f' || user_id", "= 'click'"), ("input", "'DW.raw.s' || (user_id % 7)", "= 'click'"), ("input", "'DW.raw.x'", "= 'click'"),
            ("output", "'DW.mart.p' || user_id", "= 'purchase'"), ("input", "'DW.raw.q' || (user_id % 7)", "= 'purchase'"),
            ("output", "'DW.mart.m' || (user_id % 7)", "= 'signup'"), ("input", "'DW.raw.n' || user_id", "= 'signup'"),
            ("output", "'DW.S.t' || user_id", "= 'error'"), ("input", "'DW.S.gone' || (user_id % 7)", "= 'error'"),
        ]
    )
)
def sql_tables_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlscan.sql_tables(fixtures.statements(spark, sf_dir), "sql", ["event_id"], "DW", "S")


@query(
    " UNION ALL ".join(
        f"SELECT event_id, '{o}' AS output_column, {t} AS source_table, '{c}' AS source_column FROM events WHERE event_type = '{w}'"
        for w, o, t, c in [
            ("view", "order_id", "'stg.o' || user_id", "id"), ("view", "cust", "'dbo.c' || (user_id % 7)", "name"), ("view", "amount", "'stg.o' || user_id", "qty"), ("view", "amount", "'stg.o' || user_id", "price"),
            ("click", "a", "'raw.s' || (user_id % 7)", "a"), ("click", "b", "'raw.s' || (user_id % 7)", "d"),
            ("purchase", "id", "'raw.q' || (user_id % 7)", "id"), ("purchase", "q", "'raw.q' || (user_id % 7)", "q"),
            ("signup", "id", "'raw.n' || user_id", "id"), ("error", "id", "'gone' || (user_id % 7)", "id"),
        ]
    )
)
def sql_column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sqlscan.sql_columns(fixtures.statements(spark, sf_dir), "sql", ["event_id"])
    return rows.select("event_id", "output_column", "source_table", "source_column")


@query(
    """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'own' WHEN 1 THEN '' WHEN 2 THEN 'own' ELSE '' END AS schema, CASE WHEN s_suppkey % 5 < 4 THEN 'p' || s_suppkey END AS name FROM supplier WHERE s_suppkey % 5 < 4
"""
)
def proc_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = F.concat(F.lit("p"), k.cast("string"))
    sql = F.when(k % 5 == 0, F.concat(F.lit("call own."), p, F.lit("(1)"))).when(k % 5 == 1, F.concat(F.lit("EXECUTE "), p)).when(k % 5 == 2, F.concat(F.lit("BEGIN own."), p, F.lit("(x); END;"))).when(k % 5 == 3, F.concat(F.lit("{ call "), p, F.lit("(?) }"))).otherwise(F.lit("select 1"))
    found = read(spark, sf_dir, "supplier").select("s_suppkey", scalars.procedure_call(sql).alias("c")).where("c is not null")
    return found.select("s_suppkey", "c.schema", "c.name")


@query(
    """
SELECT event_id AS id, CASE event_type WHEN 'view' THEN 'dbo.c' || (user_id % 7) WHEN 'click' THEN 'mart.f' || user_id || ',s.d,raw.s' || (user_id % 7) WHEN 'purchase' THEN 'mart.p' || user_id || ',raw.q' || (user_id % 7) || ',SET'
    WHEN 'signup' THEN 'raw.n' || user_id || ',m,mart.m' || (user_id % 7) || ',fresh' ELSE 't' || user_id || ',gone' || (user_id % 7) || ',nowhere' END AS tables,
  event_type IN ('click', 'purchase', 'signup') AS looks_written
FROM events WHERE ts >= TIMESTAMP '2024-01-10' ORDER BY ts, event_id LIMIT 2000
"""
)
def operational_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll of all kinds of statements, as many as a poll takes."""
    rows = fixtures.statements(spark, sf_dir).withColumnRenamed("event_id", "id")
    since = observed.poll(rows, F.lit("2024-01-10").cast("timestamp_ntz"), observed.MAX_ROWS, "ts", "id")
    return since.select("id", F.array_join(scalars.observed_tables(F.col("sql")), ",").alias("tables"), scalars.written_tables_hint(F.col("sql")).alias("looks_written"))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a log of statements, whose schema is the user's remainder; every third statement is listed twice."""
    rows = fixtures.statements(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    log = rows.select(F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("sql_id"), F.concat(F.lit("S"), (F.col("user_id") % 7).cast("string")).alias("parsing_schema"), F.col("sql").alias("sql_text"), F.col("ts").alias("last_active_time"), (F.col("event_id") % 4).alias("executions"))
    return log.unionByName(log.where("substring(sql_id, 2) % 3 = 0"))


@query(
    """
SELECT date_trunc('day', ts) AS day, count(*)::BIGINT AS runs, sum((event_type <> 'view' )::INTEGER)::BIGINT AS writes, sum(event_id % 4)::BIGINT AS executions FROM events GROUP BY 1
"""
)
def run_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by day; a statement listed twice is one run."""
    w = observed.windowed(observed.runs(_observed(spark, sf_dir)), "1 day")
    return w.select(F.col("start").cast("timestamp_ntz").alias("day"), "runs", "writes", "executions")


@query(
    """
WITH e AS (SELECT 'S' || (user_id % 7) AS parsing_schema, ts, lag(ts) OVER (PARTITION BY user_id % 7 ORDER BY ts) AS before FROM events),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 2 HOURS THEN 1 ELSE 0 END) OVER (PARTITION BY parsing_schema ORDER BY ts) AS n FROM e)
SELECT parsing_schema, min(ts) AS start, max(ts) + INTERVAL 2 HOURS AS "end", count(*)::BIGINT AS runs FROM g GROUP BY parsing_schema, n
"""
)
def run_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of runs of a schema."""
    found = observed.sessions(observed.runs(_observed(spark, sf_dir)), "2 hours")
    return found.select("parsing_schema", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "runs")


@query(
    """
WITH c AS (SELECT 'q' || (user_id % 11) AS sql_id, ts, event_id, (event_id % 50) AS executions FROM events),
l AS (SELECT *, coalesce(lag(executions) OVER (PARTITION BY sql_id ORDER BY ts, executions), 0) AS before FROM c)
SELECT sql_id, ts, executions, CASE WHEN executions < before THEN executions ELSE executions - before END AS added FROM l
"""
)
def execution_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of statements' counters, which fall every fifty events."""
    e = read(spark, sf_dir, "events").select(F.concat(F.lit("q"), (F.col("user_id") % 11).cast("string")).alias("sql_id"), F.col("ts").alias("last_active_time"), (F.col("event_id") % 50).alias("executions"))
    return observed.execution_deltas(e).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_TABLES_OF = """CASE event_type WHEN 'view' THEN ['DW.dbo.c' || (user_id % 7)] WHEN 'click' THEN ['DW.mart.f' || user_id, 'DW.s.d', 'DW.raw.s' || (user_id % 7)] WHEN 'purchase' THEN ['DW.mart.p' || user_id, 'DW.raw.q' || (user_id % 7), 'DW.OWN.SET']
  WHEN 'signup' THEN ['DW.raw.n' || user_id, 'DW.OWN.m', 'DW.mart.m' || (user_id % 7), 'DW.OWN.fresh'] ELSE ['DW.OWN.t' || user_id, 'DW.OWN.gone' || (user_id % 7), 'DW.OWN.nowhere'] END"""


@query(
    f"""
WITH r AS (
  SELECT 'oracle_sql:q' || event_id AS run_id, (epoch_us(ts) // 1000)::VARCHAR AS ms, event_type <> 'view' AS w,
    '["' || array_to_string(list_sort(list_transform({_TABLES_OF}, lambda x: 'urn:li:dataset:(urn:li:dataPlatform:oracle,' || x || ',PROD)')), '","') || '"]' AS urns
  FROM events
)
SELECT 'job' AS job_urn, run_id, 'start' AS kind, '{{"timestampMillis":' || ms || ',"status":"STARTED"}}' AS payload FROM r
UNION ALL SELECT 'job', run_id, 'inputs', '{{"inputs":' || urns || '}}' FROM r
UNION ALL SELECT 'job', run_id, 'outputs', '{{"outputs":' || urns || '}}' FROM r WHERE w
UNION ALL SELECT 'job', run_id, 'end', '{{"timestampMillis":' || ms || ',"status":"COMPLETE","result":"SUCCESS"}}' FROM r
"""
)
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, inputs, outputs and end of every run."""
    runs = observed.runs(_observed(spark, sf_dir), db="DW", schema="OWN")
    return observed.run_events(runs, F.lit("job")).select("job_urn", "run_id", "kind", "payload")


@query(
    """
WITH m AS (
  SELECT r_name AS parent, 'N' || n_nationkey AS child, n_nationkey % 7 AS s FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey, c_custkey % 7 FROM customer
)
SELECT 'Geo.' || child AS source_field, 'Geo.' || parent AS target_field, substr('+-*/%~^', s::INTEGER + 1, 1) || child AS expression,
  ['SUM', 'SUBTRACT', 'MULTIPLY', 'DIVIDE', 'PERCENT', 'IGNORE', 'NEVER_CONSOLIDATE'][s + 1] AS aggregation FROM m
"""
)
def consolidation_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.consolidation_lineage(fixtures.members(spark, sf_dir)).select("source_field", "target_field", "expression", "aggregation")


@query(
    """
SELECT r_name AS name, 0 AS depth, string_agg('N' || n_nationkey, ',' ORDER BY n_nationkey) AS children FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name
UNION ALL SELECT 'N' || n_nationkey, 1, string_agg('C' || c_custkey, ',' ORDER BY c_custkey) FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
"""
)
def member_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = graph.hierarchy(fixtures.members(spark, sf_dir).where("dim = 'Geo'"), ("app", "cube", "dim"))
    return tree.where(F.size("children") > 0).select("name", F.col("level").alias("depth"), F.array_join("children", ",").alias("children"))


@query(
    """
SELECT r_name AS path, 0 AS depth FROM region UNION ALL SELECT r_name || '.N' || n_nationkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || '.N' || n_nationkey || '.C' || c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
)
def schema_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.paths(fixtures.members(spark, sf_dir).where("dim = 'Geo'"), ("app", "cube", "dim")).select("path", "depth")


@query(
    """
WITH p AS (SELECT p_partkey AS k, p_size AS z, '@SUM("P' || (p_partkey + 1) || '", "C' || p_size || '") - Geo->N1;' AS f FROM part WHERE p_partkey % 2 = 0)
SELECT 'Acct.P' || (k + 1) AS source_field, 'Acct.P' || k AS target_field, f AS expression, 'SUM' AS aggregation FROM p
UNION ALL SELECT (CASE WHEN z IN (SELECT c_custkey FROM customer) THEN 'Geo' ELSE 'Acct' END) || '.C' || z, 'Acct.P' || k, f, 'SUM' FROM p
UNION ALL SELECT 'Geo.N1', 'Acct.P' || k, f, 'SUM' FROM p
"""
)
def member_formula_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.formula_lineage(fixtures.members(spark, sf_dir)).select("source_field", "target_field", "expression", "aggregation")


@query(
    """
SELECT 'S' || s_suppkey AS script, 6 AS line_no, 'FORMULA' AS op, 'P' || s_suppkey AS targets, 'A' || s_nationkey || ',B' || s_suppkey AS sources, 'Scenario IN ("Actual") AND Market IN ("M' || s_suppkey || '")' AS "filter" FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 8, 'AGGREGATION', 'Market,Product', '', 'Scenario IN ("Actual")' FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 10, 'DATACOPY', 'Budget>Forecast_' || s_suppkey, '', NULL FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 11, 'CALC_DIM', 'Year', '', NULL FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 12, 'CLEAR', 'Old', '', NULL FROM supplier
"""
)
def calc_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = calc.calc_operations(fixtures.calc_scripts(spark, sf_dir))
    targets = F.when(F.col("op") == "DATACOPY", F.concat_ws(">", "src_region", "dst_region")).otherwise(F.array_join("targets", ","))
    return ops.select("script", "line_no", "op", targets.alias("targets"), F.array_join("sources", ",").alias("sources"), scalars.fix_filter(F.col("fix")).alias("filter"))


@query("SELECT 'S' || s_suppkey AS script, 'AGGMISSG' AS name, 'ON' AS value, 'global' AS scope FROM supplier UNION ALL SELECT 'S' || s_suppkey, 'v', s_nationkey::VARCHAR, 'local' FROM supplier")
def calc_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.script_variables(fixtures.calc_scripts(spark, sf_dir))


@query(
    """
SELECT src AS source_field, dst AS target_field, t AS transformation_type FROM (
  SELECT 'A' || s_nationkey AS src, 'P' || s_suppkey AS dst, 'calc_script_formula' AS t FROM supplier
  UNION ALL SELECT 'B' || s_suppkey, 'P' || s_suppkey, 'calc_script_formula' FROM supplier
  UNION ALL SELECT 'Market.*', 'Market.*', 'aggregation' FROM supplier UNION ALL SELECT 'Product.*', 'Product.*', 'aggregation' FROM supplier
  UNION ALL SELECT 'Year.*', 'Year.*', 'calc_dim' FROM supplier UNION ALL SELECT 'Budget', 'Forecast_' || s_suppkey, 'datacopy' FROM supplier)
"""
)
def calc_script_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.all_lineage(scripts=fixtures.calc_scripts(spark, sf_dir)).select("source_field", "target_field", "transformation_type")


@query(
    """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'sql://db1' ELSE 'f' || s_suppkey || '.csv' END AS source_dataset, 'mkt' AS source_field, 'Market' AS target_field, 'load_rule_' || (CASE WHEN s_suppkey % 3 = 0 THEN 'dimension' ELSE 'data' END) AS transformation_type, NULL::VARCHAR AS expression FROM supplier
UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'sql://db1' ELSE 'f' || s_suppkey || '.csv' END, 'field_2', 'N' || s_nationkey, 'load_rule_' || (CASE WHEN s_suppkey % 3 = 0 THEN 'dimension' ELSE 'data' END), 'upper' FROM supplier
"""
)
def load_rule_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calc.load_rule_lineage(fixtures.load_rules(spark, sf_dir)).select("source_dataset", "source_field", "target_field", "transformation_type", "expression")


@query(
    """
SELECT 'g' || s_suppkey AS graph, CASE WHEN s_suppkey % 2 = 1 THEN 'late.a' ELSE 'in.b,in.n' || s_nationkey END AS inputs, CASE WHEN s_suppkey % 2 = 1 THEN '' ELSE 'out.s' || s_suppkey END AS outputs FROM supplier
UNION ALL SELECT 'z' || s_suppkey, '', '' FROM supplier
"""
)
def io_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    io = files.io_mappings(fixtures.io_files(spark, sf_dir))
    graphs = read(spark, sf_dir, "supplier").select(F.explode(F.array(F.lit("g"), F.lit("z"))).alias("p"), "s_suppkey").select(F.concat("p", F.col("s_suppkey").cast("string")).alias("graph"))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.coalesce(c, F.array()))), ",").alias(c)
    return graphs.join(io, "graph", "left").select("graph", names("inputs"), names("outputs"))


@query(
    """
SELECT 'part_' || p_partkey AS schema, 0 AS ordinal, 'name' AS name, 'string(' || p_size || ')' AS native_type FROM part
UNION ALL SELECT 'part_' || p_partkey, 1, 'price', CASE WHEN p_partkey % 2 = 0 THEN 'decimal(10)' ELSE 'decimal(10,2)' END FROM part
UNION ALL SELECT 'part_' || p_partkey, 2, 'made_' || p_partkey, 'date("YYYY-MM-DD")' FROM part WHERE p_partkey % 2 = 0
"""
)
def dml_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.record_layouts(fixtures.layouts(spark, sf_dir)).select("schema", "ordinal", "name", "native_type")


@query(
    """
SELECT '/xfr/part_' || p_partkey || '.xfr' AS file, 'full_name' AS target, CASE WHEN p_partkey % 2 = 0 THEN 'string_concat(in.first, in.l' || p_size || ')' ELSE 'first' END AS expression, CASE WHEN p_partkey % 2 = 0 THEN 'first,l' || p_size ELSE 'first' END AS source_fields FROM part
UNION ALL SELECT '/xfr/part_' || p_partkey || '.xfr', 'id', CASE WHEN p_partkey % 2 = 0 THEN 'in.key' ELSE 'k' || p_size END, CASE WHEN p_partkey % 2 = 0 THEN 'key' ELSE 'k' || p_size END FROM part
"""
)
def xfr_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.transform_mappings(fixtures.transforms(spark, sf_dir)).select("file", "target", "expression", F.array_join("source_fields", ",").alias("source_fields"))


@query(
    """
SELECT 'P' || c_custkey AS package, 'Box' AS task, 'STOCK:SEQUENCE' AS task_type, '' AS sql FROM customer
UNION ALL SELECT 'P' || c_custkey, 'T1', 'ExecuteSQLTask', 'INSERT INTO dw.c' || c_custkey || ' SELECT a FROM src.n' || c_nationkey FROM customer
UNION ALL SELECT 'P' || c_custkey, 'T2', 'Pipeline', 'SELECT 1 FROM x' || c_custkey FROM customer
"""
)
def dtsx_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package_xml.read_packages(fixtures.package_xml(spark, sf_dir)).select("package", "task", "task_type", F.array_join("sql", "\n").alias("sql"))


def _urn(name: str) -> str:
    return f"'urn:li:dataset:(urn:li:dataPlatform:oracle,' || {name} || ',PROD)'"


@query(
    f"""
SELECT 'urn:li:dataJob:(urn:li:dataFlow:(ssis,P' || c_custkey || ',PROD),T1)' AS job, 'input' AS role, {_urn("'DW.src.n' || c_nationkey")} AS dataset FROM customer
UNION ALL SELECT 'urn:li:dataJob:(urn:li:dataFlow:(ssis,P' || c_custkey || ',PROD),T1)', 'output', {_urn("'DW.dw.c' || c_custkey")} FROM customer
UNION ALL SELECT 'urn:li:dataJob:(urn:li:dataFlow:(ssis,P' || c_custkey || ',PROD),T2)', 'input', {_urn("'DW.dbo.x' || c_custkey")} FROM customer
"""
)
def package_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From package files to the datasets that each task reads and writes."""
    tasks = package_xml.read_packages(fixtures.package_xml(spark, sf_dir)).where("error is null")
    sql = tasks.select(urns.job_urn(urns.flow_urn("ssis", F.col("package")), F.col("task")).alias("job"), F.explode("sql").alias("sql"))
    io = sqlscan.sql_tables(sql, "sql", ["job"], "DW", "dbo")
    return io.select("job", "role", urns.dataset_urn("oracle", F.col("table")).alias("dataset")).distinct()


@query(
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type <> 'view' AS is_write, count(*)::BIGINT AS runs, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 4 ELSE 3 END)::BIGINT AS tables FROM events GROUP BY 1, 2
"""
)
def run_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement log replayed as a bounded stream: one run a statement; tables as the texts name them."""
    return observed.replay(spark, sf_dir)
