"""Session helpers shared by all operators."""

from __future__ import annotations

import gc
import io
import os
import site
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bounds of the batches that go to Python workers: texts are long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

#: Used only where the cluster names no shared folder (tests, one machine).
LOCAL_CHECKPOINT_DIR = "/tmp/checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir where it is set, else a local default on one machine."""
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = LOCAL_CHECKPOINT_DIR
    sc.setCheckpointDir(place)
    return place


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def spilled(df: DataFrame) -> Iterator[DataFrame]:
    """df as a Parquet table in the shared folder, for the time of the block: less than half the bytes of a checkpoint."""
    spark, schema = df.sparkSession, df.schema
    place = f"{checkpoint_dir(spark)}/spill-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    try:
        df.write.parquet(place)
        del df  # or its shuffle files would stay
        yield spark.read.schema(schema).parquet(place)
    finally:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases now; it does so only when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make a session ready for Python workers: bounded batches, and this package on the executors.

    The package is sent once for each context, unless the executors find it as the driver's environment says.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    if getattr(sc, "_loomline_shipped", False) or str(root.parent) in {os.path.realpath(p) for p in found if p}:
        return
    sc._loomline_shipped = True
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    place = f"{checkpoint_dir(spark)}/{root.name}-{uuid.uuid4().hex}.zip"  # in the shared folder: no local file is made
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(place)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_file(spark: SparkSession, path: str) -> str:
    """A driver's file where all executors see it: itself on one machine, else a copy in the shared folder."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        return path
    place = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}/{Path(path).name}"
    made = spark._jvm.org.apache.hadoop.fs.Path
    target = made(place)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).copyFromLocalFile(made(path), target)
    return place


def session() -> SparkSession:
    """The session of spark-submit or of the caller; a local one where there is neither."""
    if SparkSession.getActiveSession() or "PYSPARK_GATEWAY_PORT" in os.environ:
        return SparkSession.builder.getOrCreate()
    return local_session()


def local_session(cpus: int = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loomline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
