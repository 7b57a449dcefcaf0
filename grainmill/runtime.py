"""Sessions, the shared scratch folder, and cutting lineage through written tables.

Iterative operators and operators whose intermediate result is read more than once write
it as Parquet under ``spark.checkpoint.dir`` (a folder every executor and the driver
share) and read it back. A lost executor then costs a re-read, never a re-run of the whole
lineage, and Catalyst sees true sizes for the tables it joins next.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cpus: int | None = None, name: str = "grainmill") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GRAINMILL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables that executors and driver share.

    Reads ``spark.checkpoint.dir`` from the session. Only where that is unset and the
    master is a single process is a temporary folder of this machine used instead; on a
    cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = "file://" + tempfile.mkdtemp(prefix="grainmill-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under :func:`shared_dir` that nothing else uses."""
    return f"{shared_dir(spark)}/grainmill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """While it lasts, batches for Python functions have at most so many rows.

    For rows with whole texts, of which the default ten thousand take much memory on both sides.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settle(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and return a DataFrame that reads it back.

    ``batch_rows`` bounds the batches of Python functions while it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with arrow_batches(spark, batch_rows) if batch_rows else nullcontext():
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._grainmill_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames made by :func:`settle` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_grainmill_path", None)
        if path:
            delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a path through Spark's own file systems."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application. Results that still read them break."""
    delete_path(spark, f"{shared_dir(spark)}/grainmill-{spark.sparkContext.applicationId}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_enough(df: DataFrame, rows: int) -> DataFrame | None:
    """``F.broadcast(df)`` if the (settled) frame has at most ``rows`` rows, else None."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else None
