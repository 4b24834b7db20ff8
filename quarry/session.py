"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """A session with the settings the engine relies on; an existing session is reused."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Paths are handed to Spark as they are, so any file system it knows works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def default_sf_dir(sf: str = "sf0.001") -> str:
    return os.environ.get("QUARRY_DATA", "/root/testdata") + "/" + sf


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, checkpointed in the shared folder that the cluster names; a temporary one only where none is named."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and (not context.master.startswith("local") or context.master.startswith("local-")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="quarry-"))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name where the cluster shares files, deleted when the driver's Python ends.

    That is under spark.checkpoint.dir. Where it is not set, a local master gets a temporary folder; on a cluster that
    would be a folder of the driver's machine alone, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by now
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
