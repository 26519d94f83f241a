"""Logs of whole pipelines row by row: each aspect with its payload, and lineage edges of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import calc, records
from loomline.plans import fixtures, pipelines
from loomline.plans.catalogue import query
from loomline.session import read

_ROW = ("entity_urn", "entity_type", "aspect_name", "payload")


def _set(platform: str, name: str) -> str:
    return f"'urn:li:dataset:(urn:li:dataPlatform:{platform},' || {name} || ',PROD)'"


def _flow(platform: str, name: str) -> str:
    return f"'urn:li:dataFlow:({platform},' || {name} || ',PROD)'"


def _job(flow: str, name: str) -> str:
    return f"'urn:li:dataJob:(' || {flow} || ',' || {name} || ')'"


def _field(dataset: str, name: str) -> str:
    return f"'urn:li:schemaField:(' || {dataset} || ',' || {name} || ')'"


def _log(*parts: tuple[str, str, str, str, str]) -> str:
    """SQL of a log: urn, entity, aspect, payload and where the rows come from, a part each."""
    return " UNION ALL ".join(f"SELECT {u} AS entity_urn, '{e}' AS entity_type, '{a}' AS aspect_name, {p} AS payload FROM {t}" for u, e, a, p, t in parts)


_BOX = "CASE WHEN {0}o_orderkey % 7 = 0 THEN '__autosys__' ELSE 'BOX_' || {0}o_custkey END"
_UP = _job(_flow("autosys", "CASE WHEN u.o_orderkey IS NULL THEN '__autosys__' ELSE " + _BOX.format("u.") + " END"), "'J' || w.up")
_WORKFLOW = _job(_flow("informatica", "'folder'"), "'wf_' || o_custkey")


@query(
    "WITH w AS (SELECT *, unnest(CASE o_orderkey % 3 WHEN 1 THEN [o_orderkey - 1] ELSE [o_orderkey - 1, o_orderkey - 2] END) AS up FROM orders WHERE o_orderkey % 3 <> 0), "
    f"""e AS (SELECT w.o_orderkey, w.o_custkey, string_agg('{{"destinationUrn":"' || x.urn || '"}}', ',' ORDER BY x.urn) AS ups
  FROM (SELECT w.*, {_UP} AS urn FROM w LEFT JOIN orders u ON u.o_orderkey = w.up) x JOIN w ON w.o_orderkey = x.o_orderkey AND w.up = x.up GROUP BY 1, 2) """
    + _log(
        (_flow("autosys", "'__autosys__'"), "dataFlow", "dataFlowInfo", """'{"name":"__autosys__","description":"AutoSys standalone jobs"}'""", "(SELECT 1)"),
        (_flow("autosys", "box"), "dataFlow", "dataFlowInfo", """'{"name":"' || box || '","description":"AutoSys box"}'""", "(SELECT DISTINCT 'BOX_' || o_custkey AS box FROM orders WHERE o_orderkey % 7 <> 0)"),
        (
            _job(_flow("autosys", _BOX.format("")), "'J' || o_orderkey"), "dataJob", "dataJobInfo",
            f"""'{{"name":"J' || o_orderkey || '","type":"AUTOSYS_CMD","flowUrn":"' || {_flow("autosys", _BOX.format(""))} || '","customProperties":{{"command":"' || (CASE WHEN o_orderstatus = 'F' THEN 'infa -start wf_' || o_custkey ELSE 'run.sh ' || o_orderkey END) || (CASE WHEN o_orderkey % 3 = 2 THEN '\\ns(J' || (o_orderkey - 2) || ')' ELSE '' END) || (CASE WHEN o_orderstatus = 'F' THEN '","executes_informatica_job_urn":"' || {_WORKFLOW} ELSE '' END) || '"}}}}'""",
            "orders",
        ),
        (_job(_flow("autosys", _BOX.format("")), "'J' || o_orderkey"), "dataJob", "dataJobInputOutput", """'{"inputDatasets":[],"outputDatasets":[],"inputDatajobEdges":[' || ups || ']}'""", "e"),
    )
)
def scheduler_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.scheduler(fixtures.job_files(spark, sf_dir)).select(*_ROW)


_PK = _flow("ssis", "'P' || c_custkey")
_SRC, _DST, _X = (_set("mssql", n) for n in ("'DW.src.n' || c_nationkey", "'DW.dw.c' || c_custkey", "'DW.dbo.x' || c_custkey"))
_INSERT = "'INSERT INTO dw.c' || c_custkey || ' SELECT a FROM src.n' || c_nationkey"


def _task(name: str, kind: str, sql: str | None) -> tuple[str, str, str, str, str]:
    more = f""" || '","sql_preview":"' || {sql}""" if sql else ""
    head = f"""'{{"name":"{name}","type":"SSIS_{kind.upper()}","flowUrn":"' || {_PK} || '","customProperties":{{"ssis_task_type":"{kind}","package_path":"/pk/p_' || c_custkey || '.dtsx'"""
    return _job(_PK, f"'{name}'"), "dataJob", "dataJobInfo", f"""{head}{more} || '"}}}}'""", "customer"


def _io(ins: str | None, outs: str | None) -> str:
    """SQL of the payload of a job with at most one input and one output."""
    one = lambda k, x: f""","{k}":[{{"destinationUrn":"' || {x} || '"}}]""" if x else ""
    names = lambda x: f"""["' || {x} || '"]""" if x else "[]"
    return f"""'{{"inputDatasets":{names(ins)},"outputDatasets":{names(outs)}{one("inputDatasetEdges", ins)}{one("outputDatasetEdges", outs)}}}'"""


def _fine(op: str, *columns: tuple[list[str], str, str | None]) -> str:
    """SQL of column lineage in a payload: sources, target and text of each column."""
    text = lambda q: f""","query":"' || {q} || '\"""" if q else ""
    return ",".join("""{"upstreams":[""" + ",".join(f"""\"' || {u} || '\"""" for u in ups) + f"""],"downstreams":["' || {down} || '"],"transformOperation":"{op}"{text(q)}}}""" for ups, down, q in columns)


@query(
    _log(
        (_PK, "dataFlow", "dataFlowInfo", """'{"name":"P' || c_custkey || '","description":"SSIS package"}'""", "customer"),
        _task("Box", "STOCK:SEQUENCE", None), _task("T1", "ExecuteSQLTask", _INSERT), _task("T2", "Pipeline", "'SELECT 1 FROM x' || c_custkey"),
        *[(_set("mssql", n), "dataset", "datasetProperties", f"""'{{"name":"' || {n} || '"}}'""", "customer") for n in ("'DW.src.n' || c_nationkey", "'DW.dw.c' || c_custkey", "'DW.dbo.x' || c_custkey")],
        (_job(_PK, "'T1'"), "dataJob", "dataJobInputOutput", _io(_SRC, _DST), "customer"), (_job(_PK, "'T2'"), "dataJob", "dataJobInputOutput", _io(_X, None), "customer"),
        (_DST, "dataset", "upstreamLineage", f"""'{{"upstreams":[{{"dataset":"' || {_SRC} || '","type":"TRANSFORMED"}}],"fineGrainedLineages":[{_fine("SQL_SELECT", ([_field(_SRC, "'a'")], _field(_DST, "'a'"), _INSERT))}]}}'""", "customer"),
    )
)
def package_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.packages(fixtures.package_xml(spark, sf_dir), default_db="DW", default_schema="dbo").select(*_ROW)


_FOLDER = _flow("informatica", "'F' || p_size")
_MAP = _job(_FOLDER, "'M' || p_partkey")
_A, _T = _set("oracle", "'own.A' || p_partkey"), _set("oracle", "'T' || p_partkey")
_C1, _CN, _TX, _TY = _field(_A, "'C1'"), _field(_A, "'C' || (2 + p_partkey % 3)"), _field(_T, "'X'"), _field(_T, "'Y'")
_SELECT = "'select C1 from A' || p_partkey"


@query(
    _log(
        (_FOLDER, "dataFlow", "dataFlowInfo", """'{"name":"F' || p_size || '","description":"Informatica folder"}'""", "(SELECT DISTINCT p_size FROM part)"),
        (
            _MAP, "dataJob", "dataJobInfo",
            f"""'{{"name":"M' || p_partkey || '","type":"INFORMATICA_MAPPING","flowUrn":"' || {_FOLDER} || '","customProperties":{{"sql_snippet_count":"1","expression_count":"2","sql_snippets_sha256":"' || sha256({_SELECT}) || '","sql_snippets_preview":"' || {_SELECT} || '"}}}}'""",
            "part",
        ),
        (_MAP, "dataJob", "dataJobInputOutput", _io(_A, _T), "part"),
        (
            _T, "dataset", "upstreamLineage",
            f"""'{{"upstreams":[{{"dataset":"' || {_A} || '","type":"TRANSFORMED","properties":{{"source":"informatica_pmrep","folder":"F' || p_size || '"}}}}],"fineGrainedLineages":[{_fine("INFORMATICA_EXPRESSION", ([_C1, _CN], _TX, None), ([_CN], _TY, None))}]}}'""",
            "part",
        ),
    )
)
def mapping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.mapping_export(fixtures.mapping_xml(spark, sf_dir)).select(*_ROW)


_PROJECT = _flow("abinitio", "'abinitio'")
_LAYOUT = _set("abinitio", "'i1.part_' || p_partkey")
_P0, _P1 = _set("abinitio", "'i1.part_0'"), _set("abinitio", "'i1.part_1'")
_GRAPHS = ("g1", "g2", "z9")


def _list(urns: str) -> str:
    """SQL of the JSON list of URNs, and of the edges to them, out of an SQL list."""
    return f"""(CASE WHEN len({urns}) = 0 THEN '[]' ELSE '["' || array_to_string({urns}, '","') || '"]' END)"""


def _edges(key: str, urns: str) -> str:
    return f"""(CASE WHEN len({urns}) = 0 THEN '' ELSE ',"{key}":[{{"destinationUrn":"' || array_to_string({urns}, '"}},{{"destinationUrn":"') || '"}}]' END)"""


@query(
    f"""WITH io AS (
  SELECT g, CASE WHEN s_suppkey IS NULL THEN [] WHEN s_suppkey % 2 = 1 THEN [{_set("abinitio", "'i1.late.a'")}] ELSE [{_set("abinitio", "'i1.in.b'")}, {_set("abinitio", "'i1.in.n' || s_nationkey")}] END AS ins,
    CASE WHEN s_suppkey % 2 = 0 THEN [{_set("abinitio", "'i1.out.s' || s_suppkey")}] ELSE [] END AS outs
  FROM (VALUES ('g1'), ('g2'), ('z9')) t(g) LEFT JOIN supplier ON g = 'g' || s_suppkey
), x AS (
  SELECT p_partkey AS k, 'full_name' AS target, CASE WHEN p_partkey % 2 = 0 THEN 'string_concat(in.first, in.l' || p_size || ')' ELSE 'first' END AS expression, CASE WHEN p_partkey % 2 = 0 THEN ['first', 'l' || p_size] ELSE ['first'] END AS f, 0 AS i FROM part
  UNION ALL SELECT p_partkey, 'id', CASE WHEN p_partkey % 2 = 0 THEN 'in.key' ELSE 'k' || p_size END, CASE WHEN p_partkey % 2 = 0 THEN ['key'] ELSE ['k' || p_size] END, 1 FROM part
) """
    + _log(
        (_PROJECT, "dataFlow", "dataFlowInfo", """'{"name":"abinitio","description":"Ab Initio project"}'""", "(SELECT 1)"),
        (_LAYOUT, "dataset", "datasetProperties", """'{"name":"part_' || p_partkey || '"}'""", "part"),
        (_LAYOUT, "dataset", "dataPlatformInstance", """'{"platform":"urn:li:dataPlatform:abinitio","instance":"i1"}'""", "part"),
        (
            _LAYOUT, "dataset", "schemaMetadata",
            """'{"schemaName":"part_' || p_partkey || '","platform":"urn:li:dataPlatform:abinitio","version":0,"hash":"","fields":[{"fieldPath":"name","type":"STRING","nativeDataType":"string(' || p_size || ')"},{"fieldPath":"price","type":"STRING","nativeDataType":"' ||
  (CASE WHEN p_partkey % 2 = 0 THEN 'decimal(10)"},{"fieldPath":"made_' || p_partkey || '","type":"STRING","nativeDataType":"date(\\"YYYY-MM-DD\\")' ELSE 'decimal(10,2)' END) || '"}]}'""",
            "part",
        ),
        *[(_job(_PROJECT, f"'{g}'"), "dataJob", "dataJobInfo", f"""'{{"name":"{g}","type":"ABINITIO_GRAPH","flowUrn":"' || {_PROJECT} || '","customProperties":{{"graph_path":"/g/{g}.mp"}}}}'""", "(SELECT 1)") for g in _GRAPHS],
        (_job(_PROJECT, "g"), "dataJob", "dataJobInputOutput", f"""'{{"inputDatasets":' || {_list("ins")} || ',"outputDatasets":' || {_list("outs")} || {_edges("inputDatasetEdges", "ins")} || {_edges("outputDatasetEdges", "outs")} || '}}'""", "io"),
        ("outs[1]", "dataset", "upstreamLineage", """'{"upstreams":[' || array_to_string(list_transform(ins, lambda u: '{"dataset":"' || u || '","type":"TRANSFORMED"}'), ',') || ']}'""", "io WHERE len(ins) > 0 AND len(outs) > 0"),
        (
            _P1, "dataset", "upstreamLineage",
            f"""'{{"upstreams":[{{"dataset":"' || {_P0} || '","type":"TRANSFORMED"}}],"fineGrainedLineages":[' ||
  string_agg('{{"upstreams":["' || array_to_string(list_transform(f, lambda u: {_field(_P0, "u")}), '","') || '"],"downstreams":["' || {_field(_P1, "target")} || '"],"transformOperation":"XFR","query":"' || expression || '"}}', ',' ORDER BY k, i) || ']}}'""",
            "x",
        ),
    )
)
def graph_project_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A project of three graphs, all layouts and all transforms, on a platform instance."""
    graphs = [f"/g/{g}.mp" for g in _GRAPHS]
    log = pipelines.graph_project(spark, graphs, fixtures.layouts(spark, sf_dir), fixtures.transforms(spark, sf_dir), fixtures.io_files(spark, sf_dir), instance="i1")
    return log.select(*_ROW)


@query(
    """
WITH s AS (
  SELECT * FROM part WHERE p_partkey % 10 <> 0
)
SELECT 'F' || p_size AS folder, 's_' || p_partkey AS session, 'M' || p_partkey AS mapping, 'CONNECTOR' AS kind, 'own.A' || p_partkey AS source_dataset, 'C1' AS source_column, 'T' || p_partkey AS target_dataset, 'X' AS target_column, 1.0::DOUBLE AS confidence, 3 AS step_order FROM s
UNION ALL SELECT 'F' || p_size, 's_' || p_partkey, 'M' || p_partkey, 'CONNECTOR', 'own.A' || p_partkey, 'C' || (2 + p_partkey % 3), 'T' || p_partkey, unnest(['X', 'Y']), 1.0, 3 FROM s
"""
)
def session_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, _ = pipelines.session_lineage(fixtures.mapping_xml(spark, sf_dir))
    return edges.select("folder", "session", "mapping", "kind", "source_dataset", "source_column", "target_dataset", "target_column", "confidence", "step_order")


_SELECTED = "'select s.ID, s.N' || c_nationkey || ' as name from own.S_' || c_custkey || ' s'"


@query(
    f"""
WITH e AS (
  SELECT *, 'CONNECTOR' AS kind, 'own.S_' || c_custkey AS source_dataset, unnest(['ID', 'N' || c_nationkey]) AS source_column, unnest(['ID', 'NAME']) AS target_column, NULL AS expression, 1.0::DOUBLE AS confidence, 2 AS step_order, NULL AS "procedure" FROM customer
  UNION ALL SELECT *, 'DIRECT', 'own.S_' || c_custkey, 'D' || c_nationkey, 'D', NULL, 1.0, 1, NULL FROM customer
  UNION ALL SELECT *, 'SQL', 'own.S_' || c_custkey, unnest(['ID', 'N' || c_nationkey]), unnest(['ID', 'NAME']), {_SELECTED}, 0.95, 1, NULL FROM customer
  UNION ALL SELECT *, 'STORED_PROCEDURE', 'own.fill_' || c_custkey, '*', '*', 'call own.fill_' || c_custkey || '(1)', 0.95, 1, 'own.fill_' || c_custkey FROM customer WHERE c_custkey % 2 = 0
)
SELECT 'folder' AS folder, 'wf_' || c_custkey AS workflow, 's_' || c_custkey AS session, 'm_' || c_custkey AS mapping, kind, source_dataset, source_column, 'dw.T_' || c_custkey AS target_dataset, target_column, expression, confidence, step_order, "procedure" FROM e
"""
)
def workflow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds of edges: SQL of a source qualifier, procedure calls, direct ports and ports behind transformations."""
    return pipelines.session_lineage(fixtures.workflow_xml(spark, sf_dir))[0]


_WF = _flow("informatica", "'folder'")
_S, _TT = _set("oracle", "'own.S_' || c_custkey"), _set("oracle", "'dw.T_' || c_custkey")
_FILL = _set("oracle", "'own.fill_' || c_custkey")


def _scored(ups: list[str], column: str, op: str, confidence: str) -> str:
    return """{"upstreams":["' || """ + """ || '","' || """.join(ups) + f""" || '"],"downstreams":["' || {_field(_TT, column)} || '"],"transformOperation":"{op}","confidenceScore":{confidence}}}"""


_D, _I, _N = _scored([_field(_S, "'D' || c_nationkey")], "'D'", "DIRECT", "1.0"), _scored([_field(_S, "'ID'")], "'ID'", "CONNECTOR,SQL", "0.95"), _scored([_field(_S, "'N' || c_nationkey")], "'NAME'", "CONNECTOR,SQL", "0.95")
_STAR = _scored([_field(_FILL, "'*'")], "'*'", "STORED_PROCEDURE", "0.95")
#: Upstreams, and columns by their upstreams, come in the order of the URNs' bytes: capitals first.
_UP_S, _UP_FILL = ("""{"dataset":"' || """ + x + """ || '","type":"TRANSFORMED"}""" for x in (_S, _FILL))


def _job_row(name: str, shown: str, kind: str, props: str = "") -> tuple[str, str, str, str, str]:
    return _job(_WF, name), "dataJob", "dataJobInfo", f"""'{{"name":"' || {shown} || '","type":"{kind}","flowUrn":"' || {_WF} || '"{props}}}'""", "customer"


@query(
    _log(
        (_WF, "dataFlow", "dataFlowInfo", """'{"name":"folder","description":"Informatica folder"}'""", "(SELECT 1)"),
        _job_row("'wf_' || c_custkey", "'wf_' || c_custkey", "INFORMATICA_WORKFLOW"),
        _job_row("'wf_' || c_custkey || '.s_' || c_custkey", "'s_' || c_custkey", "INFORMATICA_SESSION", ""","customProperties":{"mapping":"m_' || c_custkey || '","position":"2","connections":""}"""),
        _job_row("'wf_' || c_custkey || '.s_' || c_custkey || '.sq'", "'sq'", "INFORMATICA_SOURCE_QUALIFIER", ""","customProperties":{"level":"1"}"""),
        (_TT, "dataset", "upstreamLineage", f"""CASE WHEN c_custkey % 2 = 0 THEN '{{"upstreams":[{_UP_S},{_UP_FILL}],"fineGrainedLineages":[{_D},{_I},{_N},{_STAR}]}}' ELSE '{{"upstreams":[{_UP_S}],"fineGrainedLineages":[{_D},{_I},{_N}]}}' END""", "customer"),
        (_job(_flow("oracle", "'stored_procedures'"), "'own.fill_' || c_custkey"), "dataJob", "dataJobInfo", """'{"name":"own.fill_' || c_custkey || '","type":"STORED_PROCEDURE"}'""", "customer WHERE c_custkey % 2 = 0"),
        (_FILL, "dataset", "datasetProperties", """'{"name":"own.fill_' || c_custkey || '"}'""", "customer WHERE c_custkey % 2 = 0"),
    )
)
def repository_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.repository(fixtures.workflow_xml(spark, sf_dir))[0].select(*_ROW)


@query(f"SELECT DISTINCT {_job(_WF, chr(39) + 'wf_' + chr(39) + ' || c_custkey')} AS urn, 'informatica' AS emitted_by, 'autosys' AS named_by FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def stitched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workflows that one source describes and scheduler jobs of another source start."""
    logs = {"autosys": pipelines.scheduler(fixtures.job_files(spark, sf_dir)), "informatica": pipelines.repository(fixtures.workflow_xml(spark, sf_dir))[0]}
    return records.stitch(logs).select("urn", F.array_join("emitted_by", ",").alias("emitted_by"), F.array_join("named_by", ",").alias("named_by"))


@query(
    """
SELECT 'dense' AS selector, 'd' || s_suppkey AS name FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'sparse', 'd' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'leaf', 'C' || c_custkey FROM customer UNION ALL SELECT 'leaf', 'N' || n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)
UNION ALL SELECT 'leaf', r_name FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'leaf', 'P' || p_partkey FROM part
UNION ALL SELECT 'calculated', 'P' || p_partkey FROM part WHERE p_partkey % 2 = 0
"""
)
def member_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    dims = read(spark, sf_dir, "supplier").select(F.concat(F.lit("d"), k.cast("string")).alias("name"), F.when(k % 3 == 0, "Dense").when(k % 3 == 1, "sparse").otherwise("other").alias("dim_type"))
    members = fixtures.members(spark, sf_dir).withColumn("storage", F.when(F.col("formula").isNotNull(), "dynamic_calc").otherwise("store"))
    parts = [calc.select_dimensions(dims, x).select(F.lit(x).alias("selector"), "name") for x in ("dense", "sparse")]
    parts += [calc.select_members(members, x).select(F.lit(x).alias("selector"), "name") for x in ("leaf", "calculated")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    """
SELECT 'S' || s_suppkey AS script, '_uncategorized_' AS dim, 'P' || s_suppkey || ',A' || s_nationkey || ',B' || s_suppkey || ',Market,Q' AS members FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 'Scenario', 'Plan,N' || s_nationkey FROM supplier
"""
)
def script_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.calc_scripts(spark, sf_dir).withColumn("content", F.concat("content", F.lit('"Q" = Scenario->Plan + Scenario->N'), F.regexp_extract("content", r"VAR v = (\d+)", 1), F.lit(" - Scenario->Plan;\n")))
    return calc.dimension_references(s).select("script", "dim", F.array_join("members", ",").alias("members"))


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN 'stg].[o' || user_id || ',dbo.c' || (user_id % 7) ELSE 'mart.t' || user_id || ',x' END AS tables FROM events")
def fallback_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of texts that no parser reads."""
    from loomline.functions.scalars import fallback_tables

    e = read(spark, sf_dir, "events")
    u, v = F.col("user_id").cast("string"), (F.col("user_id") % 7).cast("string")
    sql = F.when(F.col("event_type") == "view", F.concat(F.lit("?? FROM [stg].[o"), u, F.lit("] ))) Join dbo.c"), v, F.lit(" from [stg].[o"), u, F.lit("]"))).otherwise(F.concat(F.lit("INSERT INTO mart.t"), u, F.lit(" ((( update x"), F.lit(" set")))
    return e.select("event_id", F.array_join(fallback_tables(sql), ",").alias("tables"))


_APP, _CUBE = "'A' || n_regionkey", "'c' || n_nationkey"
_OFLOW = _flow("essbase", _APP)
_NAME = f"{_APP} || '.' || {_CUBE}"
_OSET = _set("essbase", _NAME)
_OPROPS = f"""{{"essbase_application":"' || {_APP} || '","essbase_cube":"' || {_CUBE} || '","dimension_count":"' || (1 + n_nationkey % 2) || '","number_of_blocks":"' || n_nationkey || '","block_density":"0.5"}}"""
_SCRIPT = _job(_OFLOW, f"{_CUBE} || '::S' || s_suppkey")


@query(
    f"""WITH m AS (SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) <= 200),
f AS (
  SELECT c_nationkey AS k, 'D0.C' || c_custkey AS path, 'member' AS native FROM m UNION ALL SELECT c_nationkey, 'D0', 'dimension(' || count(*) || ')' FROM m GROUP BY 1
  UNION ALL SELECT DISTINCT c_nationkey, '__measures__', 'double' FROM m
), s AS (SELECT k, string_agg('{{"fieldPath":"' || path || '","type":"' || (CASE WHEN native = 'double' THEN 'NUMBER' ELSE 'STRING' END) || '","nativeDataType":"' || native || '"}}', ',' ORDER BY path) AS fields FROM f GROUP BY k),
x AS (SELECT * FROM supplier JOIN nation ON n_nationkey = s_nationkey) """
    + _log(
        (_OFLOW, "dataFlow", "dataFlowInfo", f"""'{{"name":"' || {_APP} || '","description":"Essbase application"}}'""", "(SELECT DISTINCT n_regionkey FROM nation)"),
        (_OSET, "dataset", "datasetProperties", f"""'{{"name":"' || {_NAME} || '","customProperties":{_OPROPS}}}'""", "nation"),
        (_OSET, "dataset", "schemaMetadata", f"""'{{"schemaName":"' || {_NAME} || '_schema","platform":"urn:li:dataPlatform:essbase","version":0,"hash":"","fields":[' || fields || ']}}'""", "nation JOIN s ON k = n_nationkey"),
        (_job(_OFLOW, _CUBE), "dataJob", "dataJobInfo", f"""'{{"name":"' || {_CUBE} || '","type":"ESSBASE_CUBE","flowUrn":"' || {_OFLOW} || '","customProperties":{_OPROPS}}}'""", "nation"),
        (_job(_OFLOW, _CUBE), "dataJob", "dataJobInputOutput", _io(None, _OSET), "nation"),
        (_SCRIPT, "dataJob", "dataJobInfo", f"""'{{"name":"S' || s_suppkey || '","type":"ESSBASE_CALC_SCRIPT","flowUrn":"' || {_OFLOW} || '","customProperties":{{"essbase_application":"' || {_APP} || '","essbase_cube":"' || {_CUBE} || '","calc_script_name":"S' || s_suppkey || '","calc_script_content":"CALC DIM(D' || s_suppkey || ');"}}}}'""", "x"),
        (_SCRIPT, "dataJob", "dataJobInputOutput", _io(_OSET, _OSET), "x"),
    )
)
def cube_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube a nation in its region's application, with the nation's customers as members and its suppliers' scripts."""
    n = read(spark, sf_dir, "nation")
    text = lambda x, c: F.concat(F.lit(x), F.col(c).cast("string"))
    place = n.select("n_nationkey", text("A", "n_regionkey").alias("app"), text("c", "n_nationkey").alias("cube"))
    cubes = place.select("app", "cube", F.to_json(F.struct(F.col("n_nationkey").alias("numberOfBlocks"), F.lit(0.5).alias("blockDensity"))).alias("statistics"))
    dims = place.select("app", "cube", F.explode(F.sequence(F.lit(0), F.col("n_nationkey") % 2)).alias("dim_ord"))
    members = read(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    members = members.select("app", "cube", F.lit("D0").alias("dim"), F.lit(0).alias("dim_ord"), F.col("c_custkey").alias("ordinal"), text("C", "c_custkey").alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level"))
    scripts = read(spark, sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    scripts = scripts.select("app", "cube", text("S", "s_suppkey").alias("script"), F.concat(text("CALC DIM(D", "s_suppkey"), F.lit(");")).alias("content"))
    return pipelines.olap(cubes, dims, members, scripts).select(*_ROW)
