"""Sinks: records with error sidecars, keyed upserts, N-Triples, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.triples import n_triples


def write_records(df: DataFrame, path: str, csv: bool = False) -> None:
    """Records as JSON lines, and as CSV beside them if asked for."""
    df.write.mode("overwrite").json(f"{path}/json")
    if csv:
        flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
        flat.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def write_split(valid: DataFrame, errors: DataFrame, path: str) -> None:
    """Valid records, and the others with what is wrong with them."""
    valid.write.mode("overwrite").json(f"{path}/records")
    errors.write.mode("overwrite").json(f"{path}/errors")


def upsert(store: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The store with rows of the same key replaced and the others added. One anti join; the caller writes the result."""
    return store.join(rows.select(*key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def fill_missing(store: DataFrame, rows: DataFrame, key: str, column: str) -> DataFrame:
    """Set a column where it is null, from rows with the same key."""
    new = rows.select(F.col(key), F.col(column).alias("__new")).dropDuplicates([key])
    return store.join(new, key, "left").withColumn(column, F.coalesce(column, "__new")).drop("__new")


def write_n_triples(triples: DataFrame, path: str) -> None:
    n_triples(triples).write.mode("overwrite").text(path)


def report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key: what a load report holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def rebuilt(spark: SparkSession, old: str, new: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A table written anew beside its old form, from that; the caller drops the old one when nothing reads it any more."""
    change(spark.read.parquet(old)).write.parquet(new)
    return spark.read.parquet(new)
