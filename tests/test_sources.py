import json

import pytest

from loomline.sources import export, files, jil, mapping_xml, olap_rest, package_xml


def texts(spark, *rows):
    return spark.createDataFrame([(f, i, c) for i, (f, c) in enumerate(rows)], "file string, ord long, content string")


def test_job_definitions(spark):
    a = "junk: 1\r\ninsert_job: BOX_1\r\njob_type: BOX\r\n\r\n/* c */\ninsert_job: JOB_1   job_type: CMD\nbox_name: BOX_1\ncommand: run a\n  more\n// x\nINSERT_JOB: JOB_2\njob_type: c\nbox_name: BOX_1\ncondition: s(JOB_1) &\n  s(JOB_0)\nowner: a:b\nowner: c\n"
    got = {r.name: r for r in jil.parse_jil(texts(spark, ("a.jil", a), ("b.jil", ""), ("c.jil", None))).collect()}
    assert list(got) == ["BOX_1", "JOB_1", "JOB_2"]
    assert got["JOB_1"].command == "run a\nmore" and got["JOB_1"].job_type == "CMD" and got["JOB_1"].condition is None
    assert got["JOB_2"].condition == "s(JOB_1) & s(JOB_0)" and got["JOB_2"].raw["owner"] == "c"
    jobs = jil.parse_jil(texts(spark, ("a", a), ("b", "insert_job: JOB_1\njob_type: FT\nbox_name: B2\n")))
    last = {r.name: (r.job_type, r.box_name) for r in jil.last_definitions(jobs).collect()}
    assert last["JOB_1"] == ("FT", "B2")
    assert {tuple(r) for r in jil.box_members(jobs).collect()} >= {("BOX_1", "JOB_1"), ("B2", "JOB_1")}


XML = """<POWERMART><REPOSITORY><FOLDER NAME="F"><SOURCE NAME="S"/><TARGET NAME="T"/><TRANSFORMATION NAME="R" TYPE="Expression" REUSABLE="YES"><TRANSFORMFIELD NAME="I" PORTTYPE="INPUT"/><TRANSFORMFIELD NAME="O" PORTTYPE="OUTPUT" EXPRESSION="I"/></TRANSFORMATION>
<MAPPING NAME="M"><INSTANCE NAME="s1" TYPE="SOURCE" TRANSFORMATION_NAME="S"/><INSTANCE NAME="r1" TYPE="TRANSFORMATION" TRANSFORMATION_NAME="R"/><INSTANCE NAME="t1" TYPE="TARGET" TRANSFORMATION_NAME="T"/></MAPPING>
<WORKFLOW NAME="W"><TASKINSTANCE NAME="Start" TASKTYPE="Start"/><TASKINSTANCE NAME="b" TASKTYPE="Session"/><TASKINSTANCE NAME="a" TASKTYPE="Session"/><WORKFLOWLINK FROMTASK="Start" TOTASK="a"/><WORKFLOWLINK FROMTASK="a" TOTASK="b"/></WORKFLOW></FOLDER></REPOSITORY></POWERMART>"""
LOOSE = """<ROOT><MAPPING NAME="m"><SOURCE NAME="SRC"><TABLEATTRIBUTE NAME="Owner Name" VALUE="own"/><TABLEATTRIBUTE NAME="Sql Query" VALUE="select 1"/></SOURCE><TARGET NAME="TGT"/>
<INSTANCE NAME="SRC_INST" TYPE="SOURCE" TRANSFORMATIONNAME="SRC"/><INSTANCE NAME="TGT_INST" TYPE="TARGET" TRANSFORMATIONNAME="TGT"/>
<TRANSFORMFIELD TRANSFORMATIONNAME="TGT_INST" NAME="COL_A" PORTTYPE="INPUT" EXPRESSION="COL_B"/><TRANSFORMFIELD TRANSFORMATIONNAME="TGT_INST" NAME="COL_B"/>
<CONNECTOR FROMINSTANCE="SRC_INST" FROMFIELD="SRC_COL" TOINSTANCE="TGT_INST" TOFIELD="COL_B"/></MAPPING></ROOT>"""


def test_mapping_exports(spark):
    from loomline.operators import lineage

    f = mapping_xml.read_folders(texts(spark, ("a.xml", XML), ("b.xml", LOOSE), ("c.xml", "no xml"), ("d.xml", None)))
    bound = {(r.mapping, r.instance, r.role, r.name, r.schema) for r in mapping_xml.bound_tables(f).collect()}
    assert bound == {("M", "s1", "source", "S", None), ("M", "t1", "target", "T", None), ("m", "SRC_INST", "source", "SRC", "own"), ("m", "TGT_INST", "target", "TGT", None)}
    assert {(r.instance, r.field) for r in mapping_xml.ports(f).collect()} == {("r1", "I"), ("r1", "O"), ("TGT_INST", "COL_A"), ("TGT_INST", "COL_B")}
    assert [r.sql for r in mapping_xml.snippets(f).collect()] == ["select 1"]
    bounds = mapping_xml.bound_tables(f)
    cols = lineage.column_lineage(mapping_xml.connectors(f), mapping_xml.ports(f), bounds.where("role = 'source'"), bounds.where("role = 'target'"))
    assert {(r.target_field, r.source_instance, r.source_field) for r in cols.collect()} == {("COL_A", "SRC_INST", "SRC_COL"), ("COL_B", "SRC_INST", "SRC_COL")}
    assert {r.file for r in mapping_xml.unreadable(texts(spark, ("a.xml", XML), ("c.xml", "no xml"), ("d.xml", None))).collect()} == {"c.xml", "d.xml"}


def test_workflow_order(spark):
    from loomline.plans.pipelines import workflow_order

    got = sorted((r.position, r.node) for r in workflow_order(texts(spark, ("a.xml", XML))).collect())
    assert [n for _, n in got] == ["Start", "a", "b"]


def test_packages(spark):
    ok = '<DTS:Executable xmlns:DTS="http://schemas.microsoft.com/SqlServer/Dts"><DTS:Property DTS:Name="PackageName">Pkg</DTS:Property><DTS:Executable DTS:ExecutableType="A.B"><DTS:Property DTS:Name="ObjectName">One</DTS:Property><DTS:ObjectData><x><property name="SqlCommand">select 1 from a</property></x></DTS:ObjectData></DTS:Executable></DTS:Executable>'
    rows = {r.file: r for r in package_xml.read_packages(texts(spark, ("p/a.dtsx", ok), ("p/bad.dtsx", "<a>"), ("p/none.dtsx", None))).collect()}
    assert (rows["p/a.dtsx"].package, rows["p/a.dtsx"].task, rows["p/a.dtsx"].task_type, rows["p/a.dtsx"].sql) == ("Pkg", "One", "B", ["select 1 from a"])
    assert rows["p/bad.dtsx"].error and rows["p/none.dtsx"].error


def test_layouts_and_transforms(spark):
    df = texts(spark, ("/x/a.dml", "record\n string(\",\") name; // c\n decimal(10, 2) price;\nend;"), ("/x/b.dml", "# c\nname : string(5)\nid: int\n"), ("/x/e.dml", ""))
    got = [(r.schema, r.ordinal, r.name, r.native_type) for r in files.record_layouts(df).orderBy("schema", "ordinal").collect()]
    assert got == [("a", 0, "name", 'string(",")'), ("a", 1, "price", "decimal(10, 2)"), ("b", 0, "name", "string(5)"), ("b", 1, "id", "int")]
    x = texts(spark, ("t.xfr", "out.a :: f(in.b, in0.c);\nd = e;\n# z = y;\n"))
    assert [(r.target, r.expression, r.source_fields) for r in files.transform_mappings(x).orderBy("ordinal").collect()] == [("a", "f(in.b, in0.c)", ["b", "c"]), ("d", "e", ["e"])]
    assert {tuple(r) for r in files.parameter_sets(texts(spark, ("p", "# c\nA = 1=2\nB=\n"))).select("key", "value").collect()} == {("A", "1=2"), ("B", "")}


def test_json_maps(spark):
    df = texts(spark, ("a", '{"T": ["x", "y"], "U": {"p": 1}, "V": 3}'), ("b", '{"T": ["z"]}'))
    assert {tuple(r) for r in files.table_columns(df).collect()} == {("T", "z"), ("U", "p")}
    io = texts(spark, ("a", '{"g": {"inputs": ["i"], "outputs": ["o"]}, "h": 5}'), ("b", '{"g": {"inputs": "bad"}}'))
    assert [(r.graph, r.inputs, r.outputs) for r in files.io_mappings(io).collect()] == [("g", [], [])]


def test_paths(tmp_path, spark):
    for n in ("b.jil", "a.jil", "sub/c.jil", "d.txt"):
        p = tmp_path / n
        p.parent.mkdir(exist_ok=True)
        p.write_text("insert_job: x\n" + n)
    got = files.expand_paths([str(tmp_path / "b.jil")], [str(tmp_path), "/missing"], [".jil"])
    assert [g.rsplit("/", 1)[-1] for g in got] == ["b.jil", "a.jil", "c.jil"]
    assert sorted(r.ord for r in files.read_texts(spark, got).collect()) == [0, 1, 2]
    assert files.read_texts(spark, []).count() == 0


def test_export_disconnects_whatever_happens(tmp_path, monkeypatch):
    monkeypatch.setenv("PW", "x")
    calls = []

    def command(cmd, **kw):
        calls.append(cmd[1])
        if cmd[1] == "objectexport":
            raise export.CommandError("no")

    e = export.FolderExport("bin", "d", "r", "u", "PW", "F", str(tmp_path / "F.xml"))
    with pytest.raises(export.CommandError):
        e.run(command)
    assert calls == ["connect", "objectexport", "disconnect"]
    (tmp_path / "F.xml").write_text("x")
    assert e.run(command).endswith("F.xml") and len(calls) == 3
    with pytest.raises(export.CommandError):
        export.run_command(["false"])


def fake_server(method, url, headers, body, timeout):
    path = url.split("/rest/v1", 1)[1]
    if path.startswith("/applications/A/databases/C/dimensions/D/members"):
        offset = int(path.split("offset=")[1].split("&")[0])
        items = [{"name": f"m{i}", "parent": "m0" if i else None, "levelNumber": 0, "consolidation": "-", "formula": '"m0"' if i == 2 else None} for i in range(3)]
        return 200, json.dumps({"items": items[offset : offset + 2]}).encode()
    found = {
        "/applications": {"items": [{"name": "A"}]}, "/applications/A/databases": {"items": [{"name": "C"}]}, "/applications/A/databases/C": {"name": "C"}, "/applications/A/databases/C/statistics": {"numberOfBlocks": 7},
        "/applications/A/databases/C/dimensions": {"items": [{"name": "D"}]}, "/applications/A/databases/C/scripts": {"items": [{"name": "S"}]}, "/applications/A/databases/C/scripts/S": {"content": "CALC ALL;"},
        "/applications/A/databases/C/rules?type=data": {"items": [{"name": "R"}]}, "/applications/A/databases/C/rules?type=dimension": {"items": []}, "/applications/A/databases/C/rules/R?type=data": {"name": "R", "dataSource": {"type": "sql", "connection": "x"}, "fieldMappings": [{"fieldNumber": 1, "dimension": "D"}]},
    }
    return (200, json.dumps(found[path]).encode()) if path in found else (404, b"")


def test_rest_client():
    tries = []

    def flaky(*a):
        tries.append(1)
        if len(tries) < 3:
            raise TimeoutError("slow")
        return 200, b"{}"

    c = olap_rest.Client("http://x", send=flaky, delay=0)
    assert c.about() == {} and len(tries) == 3
    with pytest.raises(olap_rest.OlapError):
        olap_rest.Client("http://x", send=lambda *a: (401, b"")).applications()
    c = olap_rest.Client("http://x", send=fake_server)
    assert c.application("none") is None and [m["name"] for m in c.members("A", "C", "D", 2)] == ["m0", "m1", "m2"]


def test_rest_source(spark):
    o = {"url": "http://x", "fixture": "test_sources:fake_server", "pageSize": "2"}

    m = olap_rest.member_rows(olap_rest.read_olap(spark, "members", **o))
    assert [(r.name, r.parent, r.consolidation, r.formula) for r in m.orderBy("ordinal").collect()] == [("m0", None, "-", None), ("m1", "m0", "-", None), ("m2", "m0", "-", '"m0"')]
    assert olap_rest.cube_statistics(olap_rest.read_olap(spark, "cubes", **o)).first().number_of_blocks == 7
    assert olap_rest.read_olap(spark, "members", cubes="other", **o).count() == 0


def test_paths_with_a_scheme(spark, tmp_path, monkeypatch):
    """Folders with a scheme are listed by Spark's file systems; long lists of paths are joined by hash."""
    for n in ("b.dml", "sub/a.dml", "c.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(n)
    paths = files.expand_paths(None, [f"file://{tmp_path}", f"file://{tmp_path}/none"], [".dml"])
    assert [p.rsplit("/", 1)[-1] for p in paths] == ["b.dml", "a.dml"]
    want = [(0, "b.dml"), (1, "sub/a.dml")]
    assert sorted((r.ord, r.content) for r in files.read_texts(spark, paths).collect()) == want
    monkeypatch.setattr(files, "BROADCAST_PATHS", 1)
    assert sorted((r.ord, r.content) for r in files.read_texts(spark, paths).collect()) == want
