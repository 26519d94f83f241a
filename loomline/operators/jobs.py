"""Scheduler jobs as a graph: flows, dependency edges, bridges to the workflows they start, and the graph dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.scalars import bridged_workflow, upstream_jobs, upstream_jobs_raw
from loomline.functions.urns import flow_urn, job_urn

STANDALONE = "__autosys__"


def with_flow(jobs: DataFrame, platform: str = "autosys", env: str = "PROD") -> DataFrame:
    """Jobs with flow_urn (that of their box, or of the flow of standalone jobs) and job_urn."""
    flow = flow_urn(platform, F.coalesce("box_name", F.lit(STANDALONE)), env)
    return jobs.withColumn("flow_urn", flow).withColumn("job_urn", job_urn(F.col("flow_urn"), F.col("name")))


def dependency_edges(jobs: DataFrame, platform: str = "autosys", env: str = "PROD", raw: bool = True) -> DataFrame:
    """name, upstream, src_urn (the upstream job), dst_urn: an unknown upstream is taken for a standalone job.

    raw: names as the conditions write them after a one-letter status; else of all statuses, without look-backs.
    """
    named = (upstream_jobs_raw if raw else upstream_jobs)(F.col("condition"))
    wants = with_flow(jobs, platform, env).select("name", F.col("job_urn").alias("dst_urn"), F.explode(named).alias("upstream"))
    boxes = jobs.select(F.col("name").alias("upstream"), "box_name")
    up = wants.join(boxes, "upstream", "left")
    return up.select("name", "upstream", job_urn(flow_urn(platform, F.coalesce("box_name", F.lit(STANDALONE)), env), F.col("upstream")).alias("src_urn"), "dst_urn")


def bridges(jobs: DataFrame, platform: str = "informatica", flow: str = "folder", env: str = "PROD") -> DataFrame:
    """name, workflow, workflow_urn of jobs whose command starts a workflow."""
    wf = bridged_workflow(F.col("command"))
    return jobs.select("name", wf.alias("workflow")).where("workflow is not null").withColumn("workflow_urn", job_urn(flow_urn(platform, F.lit(flow), env), F.col("workflow")))


def graph_dump(jobs: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boxes with their sorted jobs, and jobs with type, box, sorted upstreams and command."""
    boxes = members.groupBy(F.col("box_name").alias("box")).agg(F.array_sort(F.collect_set("name")).alias("jobs"))
    return boxes, jobs.select("name", F.col("job_type").alias("type"), F.col("box_name").alias("box"), F.array_sort(upstream_jobs_raw(F.coalesce("condition", F.lit("")))).alias("upstreams"), "command")


def as_json(boxes: DataFrame, jobs: DataFrame) -> DataFrame:
    """One JSON document a row, kind first: files of them can be read back without a driver."""
    a = boxes.select(F.lit("box").alias("kind"), F.col("box").alias("key"), F.to_json(F.struct("jobs")).alias("value"))
    return a.unionByName(jobs.select(F.lit("job").alias("kind"), F.col("name").alias("key"), F.to_json(F.struct("type", "box", "upstreams", "command")).alias("value")))


def run_hierarchy(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """run_id, name, box_name, parent_run: the box's run that a job's run belongs to, the last one started before it or with it.

    runs: run_id, name, started (of jobs and of boxes alike); jobs: name, box_name. A run whose box has not run yet has
    no parent; of box runs started at once the greatest run_id counts. One pass over each box's runs in order of time.
    """
    mine = jobs.where("box_name is not null").select("name", "box_name").distinct()
    child = runs.join(mine, "name").select("box_name", "started", F.lit(1).alias("kind"), "run_id", "name")
    boxes = mine.select(F.col("box_name").alias("name")).distinct()
    parent = runs.join(boxes, "name").select(F.col("name").alias("box_name"), "started", F.lit(0).alias("kind"), "run_id", F.lit(None).cast("string").alias("name"))
    order = Window.partitionBy("box_name").orderBy("started", "kind", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    both = child.unionByName(parent).withColumn("parent_run", F.last(F.when(F.col("kind") == 0, F.col("run_id")), ignorenulls=True).over(order))
    return both.where("kind = 1").select("run_id", "name", "box_name", "parent_run")
