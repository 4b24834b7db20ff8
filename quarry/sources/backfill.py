"""Backfill in place: a table in hash buckets of its key, of which only those with something to fill are written again."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The partition column.
BUCKET = "bucket"


@dataclass(frozen=True)
class Filled:
    """What a backfill did: status 'success', or 'skipped' where there is no table."""

    status: str
    processed: int = 0
    skipped: int = 0
    unknown: int = 0
    buckets: tuple[int, ...] = ()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def create(rows: DataFrame, path: str, key: str, buckets: int, later: dict[str, str]) -> None:
    """Write rows by bucket of their key, with columns to be filled later as nulls (name: type).

    A bucket is what a task holds, so their number goes with the table's size; it is kept in the table's `layout` folder, with the columns.
    Rows with a null key are in a bucket as well.
    """
    spark = rows.sparkSession
    wide = rows.withColumns({c: F.lit(None).cast(t) for c, t in later.items() if c not in rows.columns}).withColumn(BUCKET, _bucket(key, buckets))
    wide.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows")
    spark.createDataFrame([(key, buckets, wide.schema.json())], "key string, buckets int, columns string").coalesce(1).write.parquet(f"{path}/layout")


def _open(spark: SparkSession, path: str) -> tuple[DataFrame, str, int]:
    layout = spark.read.parquet(f"{path}/layout").first()
    return spark.read.schema(StructType.fromJson(json.loads(layout["columns"]))).parquet(f"{path}/rows"), layout["key"], layout["buckets"]


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows."""
    return _open(spark, path)[0].drop(BUCKET)


def backfill(spark: SparkSession, path: str, new: DataFrame, skip_existing: bool = True) -> Filled:
    """Fill columns of a table from rows with the same key, in place. Every column of `new` but the key is filled.

    With skip_existing a row whose first new column has a value stays as it is; else new values replace old ones. A null
    in `new` never replaces anything. The other columns, and all buckets without a row to fill, are not touched: the
    first pass reads the key and whether there is a value, and the second reads and writes the buckets found, whose numbers are
    all that the driver gets. `new` may repeat a key: the least of its rows counts, so a second call changes nothing.
    Keys that the table lacks are counted as unknown; null keys meet nothing. Rows that share a key in the table are all
    filled. No table: status 'skipped'. Buckets are staged and put in place at the commit, so lost executors do no harm;
    a driver lost during the commit can leave some buckets old, and the same call mends that. `new` must not read the table.
    """
    if not exists(spark, f"{path}/layout"):
        return Filled("skipped")
    table, key, buckets = _open(spark, path)
    columns = [c for c in new.columns if c != key]
    missing = [c for c in columns if c not in table.columns]
    if missing or not columns:
        raise ValueError(f"columns to fill must be the table's own: {missing or 'none given'}")
    given = new.filter(F.col(key).isNotNull() & F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in columns]))
    values = given.groupBy(key).agg(F.min(F.struct(*columns)).alias("__new"))
    marks = table.select(F.col(key), BUCKET, F.col(columns[0]).isNotNull().alias("__has"))
    known = marks.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("__rows"), F.sum(F.col("__has").cast("long")).alias("__has"))
    fill = (F.col("__rows") - F.col("__has")) if skip_existing else F.col("__rows")
    plan = known.join(values.select(key, F.lit(True).alias("__met")), key, "full")
    tally = (
        plan.withColumn("__fill", F.when(F.col("__met"), F.coalesce(fill, F.lit(0))).otherwise(0))
        .groupBy(BUCKET)
        .agg(F.sum("__fill").alias("fill"), F.sum(F.coalesce("__rows", F.lit(0)) - F.col("__fill")).alias("rest"), F.count(F.lit(1)).alias("keys"))
        .collect()  # a row for each bucket, and one for the unknown keys
    )
    touched = tuple(sorted(r[BUCKET] for r in tally if r[BUCKET] is not None and r.fill > 0))
    if touched:
        due = (F.col(columns[0]).isNull() if skip_existing else F.lit(True)) & F.col("__new").isNotNull()
        met = table.filter(F.col(BUCKET).isin(list(touched))).join(values.filter(_bucket(key, buckets).isin(list(touched))), key, "left")
        filled = met.withColumns({c: F.when(due, F.coalesce(f"__new.{c}", F.col(c))).otherwise(F.col(c)) for c in columns}).select(table.columns)
        writer = filled.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(f"{path}/rows")
    known_rows = [r for r in tally if r[BUCKET] is not None]
    unknown = sum(r["keys"] for r in tally if r[BUCKET] is None)
    return Filled("success", sum(r.fill for r in known_rows), sum(r.rest for r in known_rows), unknown, touched)
