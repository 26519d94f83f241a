import json

from loomline import cli

JIL = "insert_job: B\njob_type: BOX\n\ninsert_job: J\njob_type: CMD\nbox_name: B\ncondition: s(K)\n"


def test_jobs_and_dump(spark, tmp_path, capsys):
    (tmp_path / "a.jil").write_text(JIL)
    assert cli.main(["inspect-jobs", str(tmp_path / "a.jil")]) == 0
    assert [json.loads(x)["name"] for x in capsys.readouterr().out.splitlines()] == ["B", "J"]
    assert cli.main(["dump-graph", str(tmp_path / "a.jil"), "--out", str(tmp_path / "out")]) == 0
    rows = {(r.kind, r.key): json.loads(r.value) for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert rows["box", "B"] == {"jobs": ["J"]} and rows["job", "J"]["upstreams"] == ["K"]


def test_ingest(spark, tmp_path, capsys):
    (tmp_path / "a.jil").write_text(JIL)
    (tmp_path / "r.yml").write_text(f"source:\n  type: autosys_jil\n  config:\n    jil_paths: ['{tmp_path}/a.jil']\nsink:\n  type: parquet\n  config:\n    path: {tmp_path}/log\n")
    assert cli.main(["ingest", "-c", str(tmp_path / "r.yml"), "--report-to", str(tmp_path / "report.json")]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["workunits"] == spark.read.parquet(str(tmp_path / "log")).count() == 5
