"""Scheduler job definitions (JIL): text in, one row a job definition out. No shuffle: a file is cut up in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.order import numbered


def _lines(record: Column) -> Column:
    """Trimmed lines without blanks and comments."""
    trimmed = F.transform(F.split(record, r"\r?\n"), lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: (x != "") & ~x.startswith("/*") & ~x.startswith("//"))


def _key(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def _value(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"^[^:]*:", ""))


def _at(name: str) -> Column:
    """Where the last value of a key stands, or -1."""
    return F.array_max(F.transform("lines", lambda x, i: F.when(x.contains(":") & (_key(x) == name), i).otherwise(-1)))


def _continued(at: Column, sep: str) -> Column:
    """The value at a place, joined with the lines without a colon that follow it."""
    rest = F.filter("lines", lambda x, i: (i > at) & ~x.contains(":"))
    return F.when(at >= 0, F.array_join(F.concat(F.array(_value(F.get("lines", at))), rest), sep))


def parse_jil(files: DataFrame, file: str = "file", content: str = "content", order: str = "ord") -> DataFrame:
    """file, ord, at, name, job_type, box_name, command, condition, raw for each definition in order.

    A definition opens with insert_job (in any case; job_type may follow on the same line); text before the first one,
    blank lines and comment lines are skipped; a key given twice keeps its last value; lines without a colon continue
    the command and the condition before them.
    """
    opened = F.regexp_replace(F.col(content), r"(?im)^([ \t]*insert_job[ \t]*:[ \t]*\S+)[ \t]+(job_type[ \t]*:)", "$1\n$2")
    records = F.split(opened, r"(?im)^(?=[ \t]*insert_job[ \t]*:)")
    df = files.select(F.col(file).alias("file"), F.col(order).alias("ord"), F.posexplode(records).alias("at", "record"))
    df = df.where(F.col("record").rlike(r"(?i)^[ \t]*insert_job[ \t]*:[ \t]*\S"))
    # one-element explodes: what they make is worked out once, however often it is used further up
    df = df.select("file", "ord", "at", F.explode(F.array(_lines(F.col("record")))).alias("lines"))
    pairs = F.transform(F.filter("lines", lambda x: x.contains(":")), lambda x: F.struct(_key(x).alias("key"), _value(x).alias("value")))
    df = df.select("*", F.explode(F.array(F.struct(pairs.alias("pairs"), _at("command").alias("command"), _at("condition").alias("condition")))).alias("x"))
    later = lambda e, i: F.exists(F.slice("x.pairs", i + 2, F.size("x.pairs")), lambda y: y["key"] == e["key"])
    df = df.select("*", F.explode(F.array(F.map_from_entries(F.filter("x.pairs", lambda e, i: ~later(e, i))))).alias("raw"))
    get = lambda k: F.nullif(F.try_element_at("raw", F.lit(k)), F.lit(""))
    return df.select("file", "ord", "at", get("insert_job").alias("name"), F.coalesce(get("job_type"), F.lit("")).alias("job_type"), get("box_name").alias("box_name"), _continued(F.col("x.command"), "\n").alias("command"), _continued(F.col("x.condition"), " ").alias("condition"), "raw")


def last_definitions(jobs: DataFrame) -> DataFrame:
    """One definition of each job: that of the last file, and the last one in it."""
    columns = [c for c in jobs.columns if c != "name"]
    newest = F.max_by(F.struct(*columns), F.struct("ord", "at"))  # partial sums: no window over a hot name
    return jobs.groupBy("name").agg(newest.alias("x")).select("name", *[F.col(f"x.{c}").alias(c) for c in columns])


def box_members(jobs: DataFrame) -> DataFrame:
    """box_name, name of all definitions: a job stays in a box that an earlier definition put it into."""
    return jobs.where("box_name is not null").select("box_name", "name").distinct()


def definition_order(jobs: DataFrame) -> DataFrame:
    """Definitions numbered in the order of files and lines."""
    return numbered(jobs, ["ord", "at"], "seq")
