"""Command line: run recipes, look into artifacts, dump the scheduler graph, list and extract OLAP metadata."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from loomline.operators import calc, jobs
from loomline.plans import recipes
from loomline.session import cut, session
from loomline.sources import files, jil, mapping_xml, olap_rest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomline")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("ingest", help="run a recipe")
    run.add_argument("-c", "--config", required=True)
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("--preview", type=int)
    run.add_argument("--report-to")
    look = sub.add_parser("inspect-mappings", help="folders, mappings and tables of mapping exports")
    look.add_argument("paths", nargs="+")
    look.add_argument("--limit", type=int, default=10)
    job = sub.add_parser("inspect-jobs", help="jobs of definition files")
    job.add_argument("paths", nargs="+")
    job.add_argument("--limit", type=int, default=15)
    dump = sub.add_parser("dump-graph", help="boxes and jobs as JSON lines, written by the executors")
    dump.add_argument("paths", nargs="+")
    dump.add_argument("--out", required=True)
    repo = sub.add_parser("extract-repository", help="lineage of exported folders, written by the executors; prints its summary")
    repo.add_argument("paths", nargs="+")
    repo.add_argument("--out", required=True)
    for name, text in (("olap-test", "test the connection"), ("olap-list", "list applications and cubes"), ("olap-extract", "write lineage of cubes as YAML")):
        olap = sub.add_parser(name, help=text)
        olap.add_argument("--url", required=True)
        olap.add_argument("--user", default="")
        olap.add_argument("--password-env", default="")
        olap.add_argument("--applications", default="")
        olap.add_argument("--cubes", default="")
        olap.add_argument("--out")
    return p


def _show(df, limit: int) -> None:
    for row in df.limit(limit).toJSON().collect():
        print(row)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    if a.command == "olap-test":
        import os

        ok = olap_rest.Client(a.url, a.user, os.environ.get(a.password_env, "")).test()
        print("ok" if ok else "no connection")
        return int(not ok)
    spark = session()
    if a.command == "ingest":
        log, report = recipes.run_file(spark, a.config, dry_run=a.dry_run, preview=a.preview, report_to=a.report_to)
        if a.preview:
            _show(log, a.preview)
        print(json.dumps(report.summary()))
        return int(bool(report.errors))
    if a.command == "inspect-mappings":
        found = mapping_xml.read_folders(files.read_texts(spark, a.paths))
        tables = mapping_xml.bound_tables(found).groupBy("folder", "mapping").agg(F.array_sort(F.collect_set(F.when(F.col("role") == "source", F.col("name")))).alias("sources"), F.array_sort(F.collect_set(F.when(F.col("role") == "target", F.col("name")))).alias("targets"))
        _show(tables.orderBy("folder", "mapping"), a.limit)
    elif a.command == "extract-repository":
        recipe = {"source": {"type": "informatica_repository", "config": {"xml_paths": a.paths}}, "sink": {"type": "json", "config": {"path": a.out}}}
        print(json.dumps(recipes.run(spark, recipe)[1].summary()))
    elif a.command in ("inspect-jobs", "dump-graph"):
        every = jil.parse_jil(files.read_texts(spark, a.paths))
        boxes, rest = jobs.graph_dump(jil.last_definitions(every), jil.box_members(every))
        if a.command == "inspect-jobs":
            _show(rest.orderBy("name"), a.limit)
        else:
            jobs.as_json(boxes, rest).write.mode("overwrite").json(a.out)
    else:
        o = {"url": a.url, "user": a.user, "password_env": a.password_env, "applications": a.applications, "cubes": a.cubes}
        if a.command == "olap-list":
            cubes = cut(olap_rest.read_olap(spark, "cubes", **o).select("app", "cube"))
            _show(cubes.orderBy("app", "cube"), max(1, cubes.count()))
        else:
            members = olap_rest.member_rows(olap_rest.read_olap(spark, "members", **o))
            edges = calc.all_lineage(members, olap_rest.read_olap(spark, "scripts", **o), olap_rest.read_olap(spark, "rules", **o))
            text = recipes.to_yaml(edges, a.out)
            if not a.out:
                print(text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
