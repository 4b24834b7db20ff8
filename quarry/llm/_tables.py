"""Shared-folder tables: where intermediate results are cut from their lineage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A batch of rows on its way to a Python worker is in memory three times (JVM, pipe, worker), so it is kept small.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Where none is named, a local master gets a temporary one; on a cluster that would be a folder of the driver's
    machine alone, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quarry-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named if "://" in named or not named.startswith("/") else "file://" + named


def small_batches(spark: SparkSession) -> None:
    """Let this session hand Arrow batches of at most BATCH_BYTES to Python workers; a smaller setting stays."""
    if int(spark.conf.get(_BATCH_BYTES).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that is not taken, upper and lower case alike: the wanted one, with underscores if need be."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder; it is deleted when the driver's Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/quarry/{name}-{uuid.uuid4().hex}"

    def forget() -> None:
        try:
            drop_path(spark, path)
        except Exception:  # the session may be gone by now
            pass

    atexit.register(forget)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: later steps no longer depend on lost executors.

    While the write runs, Spark removes the finished query's shuffle files, so steps do not pile up on disk.
    """
    return materialize_at(df, name)[0]


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As materialize(), with the path, so that a step can drop the table when nothing reads it any more."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path
