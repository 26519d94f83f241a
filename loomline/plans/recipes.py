"""Recipes: a source by name, its settings, and a sink; run to the log of aspects."""

from __future__ import annotations

import copy
import json
import re
from dataclasses import dataclass, field
from functools import partial
from itertools import islice
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import records
from loomline.sources.olap_rest import http


class RecipeError(ValueError):
    pass


def load_recipe(path: str) -> dict:
    if not Path(path).exists():
        raise FileNotFoundError(path)
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


@dataclass
class Report:
    """What a run emitted, and what it had to say."""

    workunits: int = 0
    by_aspect: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    details: dict = field(default_factory=dict)

    def summary(self) -> dict:
        out = {"workunits": self.workunits, "by_aspect": self.by_aspect, "warnings": self.warnings, "failures": self.errors}
        return out | ({"details": self.details} if self.details else {})

    def write(self, path: str) -> None:
        Path(path).write_text(json.dumps(self.summary(), indent=2), encoding="utf-8")


def registry() -> dict:
    from loomline.plans import pipelines

    return dict(pipelines.SOURCES)


def register(name: str, source) -> None:
    """Add a source: a function of (spark, config, report) that returns the log."""
    from loomline.plans import pipelines

    pipelines.SOURCES[name] = source


def camel_to_snake(config: dict) -> dict:
    return {re.sub(r"(?<=[a-z])(?=[A-Z])", "_", k).lower(): v for k, v in config.items()}


def write(log: DataFrame, sink: dict) -> None:
    """Write a log: parquet, json or file, table, kafka, rest, noop, or foreach (a function that gets each partition's rows)."""
    kind, config = sink.get("type", "noop"), sink.get("config") or {}
    if kind == "noop":
        log.write.format("noop").mode("overwrite").save()
    elif kind in ("parquet", "json", "file"):
        log.write.mode(config.get("mode", "overwrite")).format("json" if kind == "file" else kind).save(config.get("path") or config["filename"])
    elif kind == "table":
        log.write.mode(config.get("mode", "append")).saveAsTable(config["name"])
    elif kind == "kafka":
        value = F.to_json(F.struct("seq", "workunit_id", "entity_urn", "entity_type", "aspect_name", "payload"))
        log.select(F.col("entity_urn").alias("key"), value.alias("value")).write.format("kafka").options(**config).save()
    elif kind == "rest":
        log.foreachPartition(partial(post_rows, config["server"], config.get("batch", 100), config.get("headers") or {}))
    elif kind == "foreach":
        log.foreachPartition(config["function"])
    else:
        raise RecipeError(f"unknown sink {kind}")


def post_rows(server: str, batch: int, headers: dict[str, str], rows, send=http) -> None:
    """POST rows as JSON lists of a bounded number. The receiver upserts, so a task that runs again does no harm."""
    rows = iter(rows)
    while now := list(islice(rows, batch)):
        body = json.dumps([r.asDict() for r in now]).encode()
        status, answer = send("POST", server, {"Content-Type": "application/json", **headers}, body, 30)
        if status >= 400:
            raise RecipeError(f"{server} answered {status}: {answer[:200]!r}")


def run(spark: SparkSession, recipe: dict, dry_run: bool = False, preview: int | None = None, report_to: str | None = None) -> tuple[DataFrame, Report]:
    """Run a recipe. dry_run writes nowhere; preview keeps the first rows only; the recipe itself is never changed."""
    recipe = copy.deepcopy(recipe)
    source = recipe.get("source") or {}
    make = registry().get(source.get("type"))
    if make is None:
        raise RecipeError(f"unknown source {source.get('type')}")
    report = Report()
    log = make(spark, source.get("config") or {}, report)
    if preview is not None:
        log = log.orderBy("seq").limit(preview)
    rows = records.report(log).collect()  # one row for each kind of aspect
    report.by_aspect = {r.aspect_name: r.emitted for r in rows}
    report.workunits = sum(r.emitted for r in rows)
    write(log, {"type": "noop"} if dry_run else recipe.get("sink") or {"type": "noop"})
    if report_to:
        report.write(report_to)
    return log, report


def run_file(spark: SparkSession, path: str, **options) -> tuple[DataFrame, Report]:
    return run(spark, load_recipe(path), **options)


def run_task(spark: SparkSession, recipe_path: str | None = None, recipe: dict | None = None, dry_run: bool = False, report_to: str | None = None) -> dict:
    """For schedulers: exactly one of a path and a recipe; returns the run's summary."""
    if (recipe_path is None) == (recipe is None):
        raise RecipeError("give either a recipe path or a recipe")
    _, report = run(spark, recipe if recipe is not None else load_recipe(recipe_path), dry_run=dry_run, report_to=report_to)
    return report.summary()


def to_yaml(df: DataFrame, path: str | None = None) -> str:
    """A result as a YAML list: into a file, row by row (the driver holds a partition at a time), or returned as text."""
    rows = df.select(F.to_json(F.struct("*")).alias("x")).toLocalIterator()
    parts = (yaml.safe_dump([json.loads(r.x)], sort_keys=False, allow_unicode=True) for r in rows)
    if not path:
        return "".join(parts) or "[]\n"
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for n, part in enumerate(parts, 1):
            f.write(part)
        if not n:
            f.write("[]\n")
    return ""


def from_yaml(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """Rows of a YAML list, read leniently: what a row lacks is null."""
    rows = [json.dumps(x, default=str) for x in yaml.safe_load(text) or []]
    return spark.createDataFrame([(r,) for r in rows], "v string").select(F.from_json("v", schema).alias("x")).select("x.*")
