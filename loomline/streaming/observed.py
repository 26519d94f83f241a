"""Run-level lineage from observed statements: a poll, a stream source of it, and the streaming query."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import closing
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from loomline.functions.scalars import observed_tables, written_tables_hint
from loomline.functions.urns import dataset_urn, normalise_observed
from loomline.session import checkpoint_dir

STATEMENT = "sql_id string, parsing_schema string, sql_text string, last_active_time timestamp, executions long"
#: Fixed value: the view of recent statements, the only query source there is.
VIEW = "v$sql"
POLL_S, LOOKBACK_MIN, MAX_ROWS, LATENESS = 60, 180, 2000, "10 minutes"


def poll(statements: DataFrame, since: Column, limit: int = MAX_ROWS, time: str = "last_active_time", tie: str = "sql_id") -> DataFrame:
    """The first statements from a time on, in order; both the condition and the order reach a JDBC source."""
    return statements.where(F.col(time) >= since).orderBy(time, tie).limit(limit)


def read_statements(spark: SparkSession, url: str, since: str, limit: int = MAX_ROWS, query_sources: tuple[str, ...] = (VIEW,), **options: str) -> DataFrame:
    """The poll against a database's view of recent statements; nothing where that view is not among the query sources."""
    if VIEW not in [x.lower() for x in query_sources]:
        return spark.createDataFrame([], STATEMENT)
    table = "(SELECT sql_id, parsing_schema_name AS parsing_schema, sql_text, last_active_time, executions FROM v$sql) s"
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return poll(df, F.lit(since).cast("timestamp"), limit)


class StatementReader(SimpleDataSourceStreamReader):
    """Offsets are (time, ids already seen at that time): a full batch that ends inside a second loses nothing."""

    def __init__(self, fetch: Callable[[datetime, int], list[tuple]], start: datetime, limit: int):
        self.fetch, self.start, self.limit = fetch, start, limit

    def initialOffset(self) -> dict:
        return {"time": self.start.isoformat(), "seen": []}

    def _after(self, offset: dict) -> list[tuple]:
        since, seen = datetime.fromisoformat(offset["time"]), set(offset["seen"])
        limit = self.limit + len(seen)
        return [r for r in self.fetch(since, limit) if r[0] not in seen or r[3] > since][: self.limit]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = self._after(start)
        if not rows:
            return iter([]), start
        last = max(r[3] for r in rows)
        at_last = [r[0] for r in rows if r[3] == last]
        if last == datetime.fromisoformat(start["time"]):
            at_last += start["seen"]
        return iter(rows), {"time": last.isoformat(), "seen": sorted(set(at_last))}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        until, ids = datetime.fromisoformat(end["time"]), set(end["seen"])
        return iter([r for r in self._after(start) if r[3] < until or (r[3] == until and r[0] in ids)])


def _time(x) -> datetime:
    x = datetime.fromisoformat(x) if isinstance(x, str) else x
    return x if x.tzinfo else x.replace(tzinfo=timezone.utc)


def from_database(connect: Callable, table: str = VIEW, schema_column: str = "parsing_schema_name", marker: str = ":1") -> Callable[[datetime, int], list[tuple]]:
    """A function of (since, limit) that polls a database through its DB-API driver; connect opens a connection."""
    sql = f"SELECT sql_id, {schema_column}, sql_text, last_active_time, executions FROM {table} WHERE last_active_time >= {marker} ORDER BY last_active_time, sql_id"

    def fetch(since: datetime, limit: int) -> list[tuple]:
        with closing(connect()) as c, closing(c.cursor()) as cursor:
            cursor.execute(sql, (since,))
            return [(*r[:3], _time(r[3]), r[4]) for r in cursor.fetchmany(limit)]

    return fetch


class StatementSource(DataSource):
    """Stream of statements. options: connect (module:function that opens a DB-API connection; with table, schemaColumn
    and marker, the driver's form of a bind variable) or fixture (module:function of (since, limit) -> rows);
    lookbackMinutes, maxRows."""

    @classmethod
    def name(cls) -> str:
        return "statements"

    def schema(self) -> str:
        return STATEMENT

    def simpleStreamReader(self, schema) -> StatementReader:
        import importlib

        o = {k.lower(): v for k, v in dict(self.options).items()}
        module, function = o["connect" if "connect" in o else "fixture"].split(":")
        fetch = getattr(importlib.import_module(module), function)
        if "connect" in o:
            fetch = from_database(fetch, o.get("table", VIEW), o.get("schemacolumn", "parsing_schema_name"), o.get("marker", ":1"))
        back = timedelta(minutes=float(self.options.get("lookbackminutes", self.options.get("lookbackMinutes", str(LOOKBACK_MIN)))))
        limit = int(self.options.get("maxrows", self.options.get("maxRows", str(MAX_ROWS))))
        return StatementReader(fetch, datetime.now(timezone.utc) - back, limit)


def runs(statements: DataFrame, platform: str = "oracle", env: str = "PROD", instance: str | None = None, db: str | None = None, schema: str | None = None, lateness: str | None = LATENESS) -> DataFrame:
    """One run for each execution of a statement that names tables: run_id, job-independent inputs and outputs.

    Works on batches and streams. A statement seen twice at the same time counts once within the watermark. is_write
    holds for statements that write by their form, wherever the verb stands; then all tables are outputs, as no parser
    is asked.
    """
    s = statements.withColumn("ts", F.col("last_active_time").cast("timestamp"))
    if lateness and s.isStreaming:
        s = s.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["sql_id", "ts"])
    else:
        s = s.dropDuplicates(["sql_id", "ts"])
    tables = F.transform(observed_tables(F.col("sql_text")), lambda t: dataset_urn(platform, normalise_observed(t, db, schema), env, instance))
    write = F.col("sql_text").rlike(r"(?i)^\s*(?:/\*.*?\*/\s*)?(?:insert|update|merge|delete)\b") | written_tables_hint(F.col("sql_text"))
    out = s.withColumn("inputs", F.array_sort(F.array_distinct(tables))).where(F.size("inputs") > 0)
    none = F.array().cast("array<string>")
    return out.select(F.concat(F.lit("oracle_sql:"), "sql_id").alias("run_id"), "ts", "parsing_schema", "executions", write.alias("is_write"), "inputs", F.when(write, F.col("inputs")).otherwise(none).alias("outputs"), F.lit("COMPLETE").alias("event"), F.lit("SUCCESS").alias("result"))


def run_events(runs_: DataFrame, job: Column) -> DataFrame:
    """Runs as log rows: start, inputs, outputs (if any), end."""
    ms = F.unix_millis("ts")
    kinds = F.filter(F.array(
        F.struct(F.lit(0).alias("o"), F.lit("start").alias("kind"), F.to_json(F.struct(ms.alias("timestampMillis"), F.lit("STARTED").alias("status"))).alias("payload")),
        F.struct(F.lit(1).alias("o"), F.lit("inputs").alias("kind"), F.to_json(F.struct("inputs")).alias("payload")),
        F.struct(F.lit(2).alias("o"), F.lit("outputs").alias("kind"), F.when(F.size("outputs") > 0, F.to_json(F.struct("outputs"))).alias("payload")),
        F.struct(F.lit(3).alias("o"), F.lit("end").alias("kind"), F.to_json(F.struct(ms.alias("timestampMillis"), F.col("event").alias("status"), F.col("result").alias("result"))).alias("payload")),
    ), lambda x: x["payload"].isNotNull())
    return runs_.select(job.alias("job_urn"), "run_id", "ts", F.explode(kinds).alias("x")).select("job_urn", "run_id", "ts", "x.o", "x.kind", "x.payload")


def _added(key, chunks, state):
    """Rows of one statement of a micro-batch in order of time, against the counter kept from the batches before."""
    import pandas as pd

    rows = pd.concat(list(chunks)).sort_values(["ts", "executions"], kind="stable")
    last, added = state.get[0] if state.exists else 0, []
    for n in rows["executions"]:
        added.append(n - last if n >= last else n)
        last = n
    state.update((int(last),))
    yield rows.assign(added=added)[["sql_id", "ts", "executions", "added"]]


def execution_deltas(statements: DataFrame) -> DataFrame:
    """sql_id, ts, executions, added: what a statement's running counter grew by since it was seen last.

    A counter that falls has been reset, and counts from nothing. Batches use a window; streams keep the last counter of
    each statement as state, and give the same rows as long as batches arrive in order. Rows without a counter are left out.
    """
    s = statements.select("sql_id", F.col("last_active_time").cast("timestamp").alias("ts"), "executions").where("executions is not null")
    if s.isStreaming:
        return s.groupBy("sql_id").applyInPandasWithState(_added, "sql_id string, ts timestamp, executions long, added long", "last long", "append", "NoTimeout")
    before = F.coalesce(F.lag("executions").over(Window.partitionBy("sql_id").orderBy("ts", "executions")), F.lit(0))
    return s.withColumn("added", F.when(F.col("executions") >= before, F.col("executions") - before).otherwise(F.col("executions")))


def windowed(runs_: DataFrame, every: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Runs, writes and executions by event-time window."""
    w = F.window("ts", every, slide) if slide else F.window("ts", every)
    return runs_.groupBy(w.alias("w")).agg(F.count("*").alias("runs"), F.sum(F.col("is_write").cast("int")).alias("writes"), F.sum("executions").alias("executions")).select("w.start", "w.end", "runs", "writes", "executions")


def sessions(runs_: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of runs by schema: a session ends after a gap."""
    return runs_.groupBy(F.session_window("ts", gap).alias("w"), "parsing_schema").agg(F.count("*").alias("runs")).select("parsing_schema", "w.start", "w.end", "runs")


def write_runs(runs_: DataFrame, sink, checkpoint: str, available_now: bool = False, every_s: int = POLL_S):
    """Start the query: sink(batch, id) gets each micro-batch; it should be an upsert, as a batch may come twice."""
    w = runs_.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{every_s} seconds")).start()


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream of statements, run to its end; the runs it wrote, counted by day and kind."""
    import uuid

    from loomline.plans import fixtures

    place = f"{checkpoint_dir(spark)}/replay-{uuid.uuid4().hex}"
    rows = fixtures.statements(spark, sf_dir)
    log = rows.select(F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("sql_id"), F.lit("S").alias("parsing_schema"), F.col("sql").alias("sql_text"), F.col("ts").cast("timestamp").alias("last_active_time"), F.lit(1).cast("long").alias("executions"))
    log.write.parquet(f"{place}/in")
    stream = runs(spark.readStream.schema(STATEMENT).parquet(f"{place}/in"), db="DW", schema="S", lateness="60 days")
    write_runs(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{place}/out/batch={n}"), f"{place}/state", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{place}/out")
    return out.groupBy(F.to_date("ts").cast("string").alias("day"), "is_write").agg(F.count("*").alias("runs"), F.sum(F.size("inputs")).alias("tables"))
