import json
from datetime import datetime, timezone

import pytest

from pyspark.sql import functions as F

from loomline.operators import order, records
from loomline.plans import pipelines, recipes
from loomline.streaming import observed

JIL = "insert_job: BOX_A\njob_type: BOX\n\ninsert_job: J1\njob_type: CMD\nbox_name: BOX_A\ncommand: infa -wf wf_load\n\ninsert_job: J2\njob_type: CMD\ncondition: s(J1) & s(ZZ)\n"


@pytest.fixture
def jil_recipe(tmp_path):
    (tmp_path / "a.jil").write_text(JIL)
    return {"source": {"type": "autosys_jil", "config": {"jil_paths": [str(tmp_path / "a.jil")], "custom_properties": {"team": "x"}}}, "sink": {"type": "json", "config": {"path": str(tmp_path / "out")}}}


def test_recipe(spark, jil_recipe, tmp_path):
    before = json.dumps(jil_recipe)
    log, report = recipes.run(spark, jil_recipe, dry_run=True, report_to=str(tmp_path / "r.json"))
    assert not (tmp_path / "out").exists() and json.dumps(jil_recipe) == before
    assert json.loads((tmp_path / "r.json").read_text())["workunits"] == 6 == report.workunits
    log, _ = recipes.run(spark, jil_recipe)
    assert spark.read.json(str(tmp_path / "out")).count() == 6
    rows = {(r.aspect_name, r.entity_urn): json.loads(r.payload) for r in log.collect()}
    job = rows["dataJobInfo", "urn:li:dataJob:(urn:li:dataFlow:(autosys,BOX_A,PROD),J1)"]
    assert job["type"] == "AUTOSYS_CMD" and job["customProperties"] == {"team": "x", "command": "infa -wf wf_load", "executes_informatica_job_urn": "urn:li:dataJob:(urn:li:dataFlow:(informatica,folder,PROD),wf_load)"}
    io = rows["dataJobInputOutput", "urn:li:dataJob:(urn:li:dataFlow:(autosys,__autosys__,PROD),J2)"]
    assert [e["destinationUrn"] for e in io["inputDatajobEdges"]] == ["urn:li:dataJob:(urn:li:dataFlow:(autosys,BOX_A,PROD),J1)", "urn:li:dataJob:(urn:li:dataFlow:(autosys,__autosys__,PROD),ZZ)"]
    assert recipes.run(spark, jil_recipe, preview=2, dry_run=True)[1].workunits == 2


def test_recipe_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        recipes.load_recipe(str(tmp_path / "none.yml"))
    with pytest.raises(recipes.RecipeError):
        recipes.run(spark, {"source": {"type": "other"}})
    with pytest.raises(recipes.RecipeError):
        recipes.run_task(spark)
    done = recipes.run_task(spark, recipe={"source": {"type": "oracle_operational"}})
    assert done["workunits"] == 0 and len(done["warnings"]) == 1


def test_packages(spark):
    x = '<DTS:Executable xmlns:DTS="www.microsoft.com/SqlServer/Dts" DTS:ObjectName="P"><DTS:Executables><DTS:Executable DTS:ObjectName="T" DTS:ExecutableType="A.Sql"><DTS:ObjectData><q SqlStatementSource="INSERT INTO f SELECT o.a AS x, o.b FROM dbo.o o"/></DTS:ObjectData></DTS:Executable></DTS:Executables></DTS:Executable>'
    df = spark.createDataFrame([("/p/a.dtsx", x), ("/p/b.dtsx", "<")], "file string, content string")
    log = pipelines.packages(df, default_db="DW", default_schema="S", instance="I")
    rows = {(r.aspect_name, r.entity_urn): json.loads(r.payload) for r in records.latest(log).collect()}
    out, src = "urn:li:dataset:(urn:li:dataPlatform:mssql,I.DW.S.f,PROD)", "urn:li:dataset:(urn:li:dataPlatform:mssql,I.DW.dbo.o,PROD)"
    up = rows["upstreamLineage", out]
    assert [u["dataset"] for u in up["upstreams"]] == [src]
    assert [(f["upstreams"], f["downstreams"]) for f in up["fineGrainedLineages"]] == [([f"urn:li:schemaField:({src},a)"], [f"urn:li:schemaField:({out},x)"]), ([f"urn:li:schemaField:({src},b)"], [f"urn:li:schemaField:({out},b)"])]


def test_graph_project(spark):
    t = lambda *rows: spark.createDataFrame([(f, i, c) for i, (f, c) in enumerate(rows)], "file string, ord long, content string")
    log = pipelines.graph_project(spark, ["/g/one.mp", "/g/two.mp"], t(("/d/src.dml", "a : int"), ("/d/dst.dml", "b : int")), t(("x.xfr", "out.b :: in.a;")), t(("io", '{"one": {"inputs": ["i", "i"], "outputs": ["o"]}}')))
    rows = {(r.aspect_name, r.entity_urn): json.loads(r.payload) for r in records.latest(log).collect()}
    assert rows["dataJobInputOutput", "urn:li:dataJob:(urn:li:dataFlow:(abinitio,abinitio,PROD),one)"]["inputDatasets"] == ["urn:li:dataset:(urn:li:dataPlatform:abinitio,i,PROD)"]
    assert rows["dataJobInputOutput", "urn:li:dataJob:(urn:li:dataFlow:(abinitio,abinitio,PROD),two)"]["inputDatasets"] == []
    assert rows["upstreamLineage", "urn:li:dataset:(urn:li:dataPlatform:abinitio,dst,PROD)"]["fineGrainedLineages"][0]["transformOperation"] == "XFR"


def test_long_lineage_is_not_dealt(spark, monkeypatch):
    t = lambda rows: spark.createDataFrame([(f, i, c) for i, f, c in rows], "file string, ord long, content string")
    texts = [(i // 2, f"{9999 - i}.xfr", f"out.t{i % 2} :: in.a{i:04} + in.b;") for i in range(2301)]  # two files of one ord each
    seen = []
    keep = order.cut
    monkeypatch.setattr(order, "cut", lambda df: [out := keep(df), seen.extend(out.select(F.max(F.length("payload"))).first() if "payload" in out.columns else [])][0])
    dml = t([(0, "/d/src.dml", "a : int"), (1, "/d/dst.dml", "b : int")])
    log = pipelines.graph_project(spark, ["/g/one.mp"], dml, t(texts), t([(0, "io", "{}")]))
    rows = log.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(len(rows))) and [r.workunit_id for r in rows] == [f"abinitio:{i}" for i in range(len(rows))]
    src, dst = ("urn:li:dataset:(urn:li:dataPlatform:abinitio,src,PROD)", "urn:li:dataset:(urn:li:dataPlatform:abinitio,dst,PROD)")
    fine = [{"upstreams": [f"urn:li:schemaField:({src},{x})" for x in (f"a{i:04}", "b")], "downstreams": [f"urn:li:schemaField:({dst},t{i % 2})"], "transformOperation": "XFR", "query": f"in.a{i:04} + in.b"} for i in range(len(texts))]
    want = {"upstreams": [{"dataset": src, "type": "TRANSFORMED"}], "fineGrainedLineages": fine}
    assert rows[-1].entity_urn == dst and rows[-1].payload == json.dumps(want, separators=(",", ":"))
    assert seen and max(seen) < len(rows[-1].payload) // 100
    none = pipelines.graph_project(spark, ["/g/one.mp"], dml, t([(0, "x.xfr", "# nothing")]), t([(0, "io", "{}")]))
    assert not none.where("aspect_name = 'upstreamLineage'").count()


def test_olap(spark):

    log, report = recipes.run(spark, {"source": {"type": "essbase", "config": {"base_url": "http://x", "fixture": "test_sources:fake_server"}}}, dry_run=True)
    kinds = report.by_aspect
    assert kinds == {"dataFlowInfo": 1, "datasetProperties": 1, "schemaMetadata": 1, "dataJobInfo": 3, "dataJobInputOutput": 3}


def test_yaml_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], {"k": "v"})], "n long, xs array<string>, m map<string,string>")
    recipes.to_yaml(df, str(tmp_path / "x.yml"))
    text = recipes.to_yaml(df)
    assert text == (tmp_path / "x.yml").read_text() and recipes.to_yaml(df.limit(0)) == "[]\n"
    back = recipes.from_yaml(spark, (tmp_path / "x.yml").read_text(), df.schema.simpleString().removeprefix("struct<").removesuffix(">").replace("n:", "n ", 1).replace("xs:", "xs ", 1).replace(",m:", ",m ", 1))
    assert back.collect() == df.collect() and "xs" in text


def rows_since(since, limit):
    t = lambda m: datetime(2024, 1, 1, 0, m, tzinfo=timezone.utc)
    every = [("a", "s", "select 1 from x", t(1), 1), ("b", "s", "x", t(1), 1), ("c", "s", "y", t(1), 1), ("d", "s", "z", t(2), 1)]
    return [r for r in every if r[3] >= since][:limit]


def test_cursor_loses_nothing_at_a_cut():
    r = observed.StatementReader(rows_since, datetime(2023, 1, 1, tzinfo=timezone.utc), 2)
    offset, got = r.initialOffset(), []
    for _ in range(4):
        start = offset
        rows, offset = r.read(start)
        rows = list(rows)
        got += [x[0] for x in rows]
        assert [x[0] for x in r.readBetweenOffsets(start, offset)] == [x[0] for x in rows]
    assert got == ["a", "b", "c", "d"]


def test_runs(spark):
    t = "2024-01-01 00:00:0"
    rows = [("1", "s", "INSERT INTO a SELECT * FROM b", f"{t}1", 2), ("1", "s", "INSERT INTO a SELECT * FROM b", f"{t}1", 2), ("2", "s", "select 1", f"{t}2", 1), ("3", "s", "SELECT x FROM d.c", "2024-01-01 02:00:00", 1)]
    s = spark.createDataFrame(rows, "sql_id string, parsing_schema string, sql_text string, last_active_time string, executions long")
    runs = observed.runs(s, db="DB", schema="S")
    got = {r.run_id: (r.is_write, len(r.inputs), len(r.outputs)) for r in runs.collect()}
    assert got == {"oracle_sql:1": (True, 2, 2), "oracle_sql:3": (False, 1, 0)}
    from pyspark.sql import functions as F

    assert [r.kind for r in observed.run_events(runs.where("run_id = 'oracle_sql:3'"), F.lit("j")).orderBy("o").collect()] == ["start", "inputs", "end"]
    assert sorted((r.runs, r.writes) for r in observed.windowed(runs).collect()) == [(1, 0), (1, 1)]
    assert observed.sessions(runs).count() == 2


def test_stream_source(spark):


    spark.dataSource.register(observed.StatementSource)
    stream = spark.readStream.format("statements").option("fixture", "test_pipelines:rows_since").option("lookbackMinutes", str(60 * 24 * 3650)).load()
    q = stream.writeStream.format("memory").queryName("seen").trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").count() == 4


def test_repository(spark):
    from test_sources import XML

    x = XML.replace("</MAPPING>", '<CONNECTOR FROMINSTANCE="s1" FROMFIELD="A" TOINSTANCE="r1" TOFIELD="I"/><CONNECTOR FROMINSTANCE="r1" FROMFIELD="O" TOINSTANCE="t1" TOFIELD="Z"/><TABLEATTRIBUTE NAME="Pre SQL" VALUE="call own.p(1)"/></MAPPING><SESSION NAME="a" MAPPINGNAME="M"/><SESSION NAME="b" MAPPINGNAME="none"/>')
    log, summary, missing = pipelines.repository(spark.createDataFrame([("f.xml", x)], "file string, content string"))
    rows = {(r.aspect_name, r.entity_urn): json.loads(r.payload) for r in records.latest(log).collect()}
    flow = "urn:li:dataFlow:(informatica,F,PROD)"
    assert rows["dataJobInfo", f"urn:li:dataJob:({flow},W.a)"]["customProperties"]["position"] == "2"
    assert rows["dataJobInfo", f"urn:li:dataJob:({flow},W.a.r1)"]["customProperties"] == {"level": "1"}
    up = rows["upstreamLineage", "urn:li:dataset:(urn:li:dataPlatform:oracle,T,PROD)"]["fineGrainedLineages"]
    assert sorted((f["transformOperation"], f["confidenceScore"]) for f in up) == [("CONNECTOR", 1.0), ("STORED_PROCEDURE", 0.95)]
    assert ("dataJobInfo", "urn:li:dataJob:(urn:li:dataFlow:(oracle,stored_procedures,PROD),own.p)") in rows
    assert [r.session for r in missing.collect()] == ["b"]
    s = summary.first()
    assert (s.total_edges, s.procedures, s.mappings) == (2, 1, 1)


def test_rest_sink_batches():
    class Row(dict):
        asDict = dict.copy

    sent = []

    def send(method, url, headers, body, timeout):
        sent.append(json.loads(body))
        return 200, b""

    recipes.post_rows("http://x", 2, {}, (Row(n=i) for i in range(5)), send)
    assert [len(s) for s in sent] == [2, 2, 1]
    with pytest.raises(recipes.RecipeError):
        recipes.post_rows("http://x", 2, {}, [Row(n=1)], lambda *a: (500, b"no"))


def test_statements_from_a_database(tmp_path, monkeypatch):
    """A poll through a DB-API driver pages by cursor and loses nothing."""
    import sqlite3

    sqlite3.register_adapter(datetime, lambda d: d.isoformat())
    file = tmp_path / "s.db"
    with sqlite3.connect(file) as c:
        c.execute("create table seen (sql_id, owner, sql_text, last_active_time, executions)")
        c.executemany("insert into seen values (?, 's', 'select 1 from t', ?, 1)", [(x, datetime(2024, 1, 1, 0, m, tzinfo=timezone.utc)) for x, m in (("a", 1), ("b", 1), ("c", 1), ("d", 2))])
    r = observed.StatementReader(observed.from_database(lambda: sqlite3.connect(file), "seen", "owner", "?"), datetime(2023, 1, 1, tzinfo=timezone.utc), 2)
    offset, got = r.initialOffset(), []
    for _ in range(4):
        rows, offset = r.read(offset)
        got += [x[0] for x in rows]
    assert got == ["a", "b", "c", "d"]


def test_query_sources(spark):
    assert observed.read_statements(spark, "jdbc:none", "2024-01-01", query_sources=("audit",)).count() == 0


def test_packages_with_schemas(spark):
    sql = ["INSERT INTO f SELECT * FROM dbo.o", "INSERT INTO f SELECT a, k FROM dbo.o JOIN dbo.p ON o.i = p.i"]
    tasks = "".join(f'<DTS:Executable DTS:ObjectName="T{i}" DTS:ExecutableType="A.Sql"><DTS:ObjectData><q SqlStatementSource="{s}"/></DTS:ObjectData></DTS:Executable>' for i, s in enumerate(sql))
    x = f'<DTS:Executable xmlns:DTS="www.microsoft.com/SqlServer/Dts" DTS:ObjectName="P"><DTS:Executables>{tasks}</DTS:Executables></DTS:Executable>'
    schemas = spark.createDataFrame([("dw.dbo.o", "a"), ("dw.dbo.o", "b"), ("dw.dbo.p", "k"), ("dw.dbo.other", "a")], "table string, column string")
    log = pipelines.packages(spark.createDataFrame([("/p/a.dtsx", x)], "file string, content string"), schemas=schemas)
    got = {}
    for r in log.where("aspect_name = 'upstreamLineage'").orderBy("seq").collect():
        for f in json.loads(r.payload)["fineGrainedLineages"]:
            got.setdefault(r.seq, []).append((f["upstreams"][0].split(",")[-1][:-1], f["upstreams"][0].split(",")[1], f["downstreams"][0].split(",")[-1][:-1]))
    assert list(got.values()) == [[("a", "dbo.o", "a"), ("b", "dbo.o", "b")], [("a", "dbo.o", "a"), ("k", "dbo.p", "k")]]


def broken_server(method, url, headers, body, timeout):
    """The fake server with a second application that is down and a second script that can't be read."""
    from test_sources import fake_server

    path = url.split("/rest/v1", 1)[1]
    if path == "/applications":
        return 200, b'{"items": [{"name": "A"}, {"name": "B"}]}'
    if path.startswith("/applications/B/") or path.endswith("/scripts/bad"):
        return 500, b""
    if path.endswith("/scripts"):
        return 200, b'{"items": [{"name": "S"}, {"name": "bad"}]}'
    return fake_server(method, url, headers, body, timeout)


def test_olap_lineage_goes_on_without_what_fails(spark):
    config = {"base_url": "http://x", "fixture": "test_pipelines:broken_server"}
    log, report = recipes.run(spark, {"source": {"type": "essbase_lineage", "config": config}}, dry_run=True)
    assert report.by_aspect == {"upstreamLineage": 1}
    assert [e.split(":")[0] for e in report.errors] == ["B"] and report.warnings == ["1 calculation scripts could not be read"]
    _, report = recipes.run(spark, {"source": {"type": "essbase", "config": config | {"applications": ["A"]}}}, dry_run=True)
    assert report.by_aspect["dataJobInfo"] == 3 and len(report.warnings) == 1


def test_repository_recipe(spark, tmp_path, capsys):
    from loomline import cli
    from loomline.plans import fixtures

    x = fixtures.workflow_xml(spark, "/root/testdata/sf0.001").orderBy("file").first().content
    (tmp_path / "w.xml").write_text(x.replace("</WORKFLOW>", '</WORKFLOW><SESSION NAME="lost" MAPPINGNAME="gone"/>'))
    assert cli.main(["extract-repository", str(tmp_path / "w.xml"), "--out", str(tmp_path / "out")]) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["details"]["total_edges"] == 6 and said["warnings"] == ["1 sessions have no mapping in the export"]
    assert spark.read.json(str(tmp_path / "out")).count() == said["workunits"]


def test_deltas_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    schema = "sql_id string, last_active_time timestamp, executions long"
    at = lambda m: datetime(2024, 1, 1, 0, m)
    batches = [[("a", at(2), 7), ("a", at(1), 3), ("b", at(1), 1), ("b", at(1), None)], [("a", at(3), 2), ("b", at(2), 1)], [("c", at(5), 9), ("a", at(4), 6)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = observed.execution_deltas(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        write = lambda b, n: b.write.mode("append").parquet(str(tmp_path / "out"))
        q.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, observed.execution_deltas(spark.read.schema(schema).parquet(str(tmp_path / "in"))).collect()))
    assert got == want and [r[3] for r in got] == [3, 4, 2, 4, 1, 0, 9]


@pytest.fixture
def far_parts(spark, tmp_path):
    """Parts so far apart that the mapping which part 10's session misses is another part's, in a folder of the same name."""
    schema = "p_partkey long, p_size int"
    spark.createDataFrame([(10, 1), (11, 2), (1000010, 1), (2000010, 2)], schema).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def against_sql(spark, place, name):
    import duckdb

    from loomline.plans import catalogue

    catalogue.load()
    c = duckdb.connect()
    c.execute(f"create view part as select * from '{place}/part.parquet/*.parquet'")
    got = catalogue.QUERIES[name](spark, place).toPandas()
    want = c.execute(catalogue.ORACLES[name]).df()[list(got.columns)]
    return sorted(map(tuple, got.astype(str).to_numpy())), sorted(map(tuple, want.astype(str).to_numpy()))


def test_missing_sessions_by_export(spark, far_parts):
    got, want = against_sql(spark, far_parts, "missing_sessions")
    assert got == want and ("s_10", "M1000010") in got


def test_session_edges_by_export(spark, far_parts):
    got, want = against_sql(spark, far_parts, "session_edges")
    assert got == want and not [r for r in got if r[1] == "s_10"]


def test_exports_of_one_folder_are_read_by_themselves(spark):
    """Two files hold a folder, a mapping and a session of one name: each has its own edges, and what both give comes once."""
    x = '<FOLDER NAME="F"><SOURCE NAME="A"/><TARGET NAME="T"/><MAPPING NAME="M"><INSTANCE NAME="a" TYPE="SOURCE" REFOBJECTNAME="A"/><INSTANCE NAME="t" TYPE="TARGET" REFOBJECTNAME="T"/><CONNECTOR FROMINSTANCE="a" FROMFIELD="I" TOINSTANCE="t" TOFIELD="I"/></MAPPING><SESSION NAME="s" MAPPINGNAME="M"/></FOLDER>'
    files = [("a.xml", x), ("b.xml", x.replace('FROMFIELD="I"', 'FROMFIELD="J"')), ("c.xml", x), ("d.xml", '<FOLDER NAME="F"><SESSION NAME="lone" MAPPINGNAME="M"/></FOLDER>')]
    edges, missing = pipelines.session_lineage(spark.createDataFrame(files, "file string, content string"))
    assert sorted((r.folder, r.session, r.source_column, r.target_column) for r in edges.collect()) == [("F", "s", "I", "I"), ("F", "s", "J", "I")]
    assert [(r.folder, r.session) for r in missing.collect()] == [("F", "lone")]


def test_session_counts_by_export(spark, far_parts):
    got, want = against_sql(spark, far_parts, "session_lineage")
    assert got == want == [("CONNECTOR", "3", "1", "3")]
