"""Faceted filtering and counting: conjunctive filters, one-pass multi-facet counts, paged facet values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quarry.operators.graph import page_after


def values(df: DataFrame, name: str) -> Column:
    """A facet column as an array, so scalar and multi-valued facets are handled alike."""
    if isinstance(df.schema[name].dataType, ArrayType):
        return F.coalesce(F.array_distinct(F.col(name).cast("array<string>")), F.array().cast("array<string>"))
    return F.when(F.col(name).isNotNull(), F.array(F.col(name).cast("string"))).otherwise(
        F.array().cast("array<string>")
    )


def _named(name: str, key: str, value: str):
    """A function of an element that pairs it with a fixed name."""
    return lambda v: F.struct(F.lit(name).alias(key), v.alias(value))


def filter_all(df: DataFrame, filters: dict[str, list[str]], mode: str = "all") -> DataFrame:
    """Keep rows that meet every facet's values; mode "any" accepts one value of each facet instead.

    With mode "all" a scalar column can only meet a single value, as conjunctions of equalities do.
    """
    parts: list[Column] = []
    for name, values in filters.items():
        if isinstance(df.schema[name].dataType, ArrayType):
            tests = [F.array_contains(F.col(name), v) for v in values]
        else:
            tests = [F.col(name) == F.lit(v) for v in values]
        if tests:
            parts.append(reduce(lambda a, b: (a & b) if mode == "all" else (a | b), tests))
    return df.filter(reduce(lambda a, b: a & b, parts)) if parts else df


def facet_counts(df: DataFrame, facets: list[str], size: int = 10) -> DataFrame:
    """(facet, value, n, rk): counts of every facet's values in one scan, the top `size` of each.

    One explode over the facet columns feeds one partial-then-final aggregation on (facet, value); the rank
    runs over the counted values only. Order: count descending, then value.
    """
    pairs = F.flatten(F.array(*[F.transform(values(df, f), _named(f, "facet", "value")) for f in facets]))
    counted = (
        df.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value"))
    return counted.withColumn("rk", rank).filter(F.col("rk") <= size)


def facet_counts_in_context(df: DataFrame, filters: dict[str, list[str]]) -> DataFrame:
    """(facet, value, n): counts of each filtered facet under the filters of the other facets."""
    parts = []
    for name in filters:
        others = {k: v for k, v in filters.items() if k != name}
        rows = filter_all(df, others).select(F.explode(values(df, name)).alias("value"))
        parts.append(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("facet"), "value", "n"))
    return reduce(DataFrame.unionByName, parts)


def facet_page(df: DataFrame, facet: str, after: str | None, size: int) -> DataFrame:
    """(value, n, has_more): a page of a facet's values in order, behind a key."""
    rows = df.select(F.explode(values(df, facet)).alias("value"))
    counted = (rows.filter(F.col("value") > F.lit(after)) if after is not None else rows).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return page_after(counted, "value", None, size)


def facet_search(df: DataFrame, facet: str, term: str, size: int, case_insensitive: bool = False) -> DataFrame:
    """(value, n): the commonest values that contain the lower-cased term."""
    value = F.lower("value") if case_insensitive else F.col("value")
    rows = df.select(F.explode(values(df, facet)).alias("value")).filter(F.contains(value, F.lit(term.lower())))
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(size)


def month_histogram(df: DataFrame, column: str) -> DataFrame:
    """(month, n) from the first to the last month, months without rows with 0; month as yyyy-MM-dd."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.date_trunc("month", column).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    span = counted.agg(F.explode(F.sequence(F.min("m"), F.max("m"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return span.join(counted, "m", "left").select(F.date_format("m", "yyyy-MM-dd").alias("month"), F.coalesce("n", F.lit(0)).alias("n"))


#: Where exact_medians cuts a key's values, in parts of them; about a thousandth of them is ranked.
MEDIAN_CUTS = (0.1, 0.4, 0.49, 0.4995, 0.5005, 0.51, 0.6, 0.9)


def exact_medians(df: DataFrame, key: str, value: str, cuts: tuple[float, ...] = MEDIAN_CUTS) -> DataFrame:
    """(key, median) without a group's values in one task.

    Approximate quantiles of a key cut its values into ranges, so that outliers move no cut. Equal values are counted first;
    exact sums over the ranges (a few numbers a key) show which of them hold the middle ranks, and only the distinct values
    in those are ranked. The quantiles only choose the ranges: the median is exact whatever they are. Nulls do not count,
    NaN is the greatest value, a key without values has no row.
    """
    rows = df.select(F.col(key).alias("__k"), F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    counted = rows.groupBy("__k", "__v").agg(F.count(F.lit(1)).alias("n"))
    quantiles = rows.groupBy("__k").agg(F.percentile_approx("__v", list(cuts), 10_000).alias("cuts"), F.count(F.lit(1)).alias("all"))
    at = sum(((F.col("__v") > F.get("cuts", i)).cast("int") for i in range(len(cuts))), F.lit(0))
    same = F.col("__k").eqNullSafe(F.col("__key"))
    placed = counted.join(quantiles.withColumnRenamed("__k", "__key"), same).drop("__key").withColumn("b", at)
    ranges = placed.groupBy("__k", "all", "b").agg(F.sum("n").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("__k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first, second = F.floor((F.col("all") + 1) / 2), F.floor((F.col("all") + 2) / 2)
    holds = ((F.col("before") < first) & (first <= F.col("before") + F.col("held"))) | ((F.col("before") < second) & (second <= F.col("before") + F.col("held")))
    middle = ranges.withColumn("before", before).filter(holds).select(F.col("__k").alias("__key"), F.col("b").alias("__b"), "before")
    upto = F.sum("n").over(Window.partitionBy("__k", "b").orderBy("__v")) + F.col("before")
    ranked = placed.join(middle, same & (F.col("b") == F.col("__b"))).withColumn("upto", upto).withColumn("under", F.col("upto") - F.col("n"))
    has = lambda rank: ((F.col("under") < rank) & (rank <= F.col("upto"))).cast("int")
    hit = ranked.withColumn("times", has(first) + has(second)).filter("times > 0")
    return hit.groupBy(F.col("__k").alias(key)).agg((F.sum(F.col("__v") * F.col("times")) / 2).alias("median"))
