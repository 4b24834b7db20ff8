"""Wildcard search over the values of a column: trigram postings, intersected, then verified by the pattern.

The index is three tables: grams (gram, key), values (key, value) and held (value, id). The key is a hash of the value; two
values with one key do no harm, as each is verified by itself. Values are in lower case, and each is indexed once, however
many rows hold it. Grams are sorted, so a look-up reads the row groups of its own grams; the postings of a frequent gram
are spread by key over several files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import relevance


@dataclass(frozen=True)
class Wildcards:
    """The tables of an index."""

    grams: DataFrame
    values: DataFrame
    held: DataFrame


def trigrams(value: Column) -> Column:
    """The runs of three characters of a text, each once; none in a shorter one."""
    return F.array_distinct(F.regexp_extract_all(value, F.lit("(?s)(?=(...))"), 1))


def build(rows: DataFrame, id_col: str, column: str, path: str) -> Wildcards:
    """Write the index of a column under a path and read it back. Null values are not in it; empty ones are."""
    spark = rows.sparkSession
    held = rows.select(F.lower(F.col(column).cast("string")).alias("value"), F.col(id_col).alias("id")).filter("value IS NOT NULL").distinct()
    held.repartitionByRange("value", "id").sortWithinPartitions("value", "id").write.parquet(f"{path}/held")
    values = spark.read.parquet(f"{path}/held").select("value").distinct().select(F.xxhash64("value").alias("key"), "value")
    values.repartitionByRange("key", "value").sortWithinPartitions("key").write.parquet(f"{path}/values")
    grams = spark.read.parquet(f"{path}/values").select(F.explode(trigrams(F.col("value"))).alias("gram"), "key").distinct()
    grams.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.parquet(f"{path}/grams")
    return read(spark, path)


def read(spark: SparkSession, path: str) -> Wildcards:
    return Wildcards(*[spark.read.parquet(f"{path}/{t}") for t in ("grams", "values", "held")])


def like_of(pattern: str) -> str:
    """A pattern of * and ? as one of LIKE."""
    return re.sub(r"[\\%_]", r"\\\g<0>", pattern.lower()).replace("*", "%").replace("?", "_")


def grams_of(pattern: str) -> list[str]:
    """The trigrams that every match of a pattern holds."""
    runs = re.split(r"[*?]", pattern.lower())
    return list(dict.fromkeys(run[i : i + 3] for run in runs for i in range(len(run) - 2)))


def matching_values(index: Wildcards, patterns: list[str]) -> DataFrame:
    """(pattern, value): the values that match patterns of * and ?, whatever the case.

    A pattern with three fixed characters in a row reads the postings of its grams alone; values with all of them are
    verified. Patterns without go over the distinct values once, all together.
    """
    spark = index.values.sparkSession
    asked = [(p, like_of(p), grams_of(p)) for p in dict.fromkeys(patterns)]
    rare = [(p, like, g, len(gs)) for p, like, gs in asked for g in gs]
    short = [F.struct(F.lit(p).alias("pattern"), F.lit(like).alias("like")) for p, like, gs in asked if not gs]
    out = spark.createDataFrame([], "pattern string, value string")
    if rare:
        wanted = spark.createDataFrame(rare, "pattern string, like string, gram string, n int")
        met = index.grams.filter(F.col("gram").isin(sorted({g for _, _, g, _ in rare}))).join(F.broadcast(wanted), "gram")  # the patterns' grams
        near = met.groupBy("pattern", "like", "n", "key").agg(F.count(F.lit(1)).alias("met")).filter("met = n")
        out = out.unionByName(near.join(index.values, "key").filter(F.like("value", F.col("like"))).select("pattern", "value"))
    if short:
        each = index.values.select("value", F.explode(F.array(*short)).alias("asked"))
        out = out.unionByName(each.filter(F.like("value", F.col("asked.like"))).select("asked.pattern", "value"))
    return out


def search(index: Wildcards, patterns: list[str]) -> DataFrame:
    """(pattern, id): the rows whose value matches. A value that many rows hold meets them in one equi join."""
    return matching_values(index, patterns).join(index.held, "value").select("pattern", "id").distinct()


def any_author(index: Wildcards, words: relevance.Index, field: str, authors: list[str]) -> DataFrame:
    """(id): rows whose author holds any of the given texts, or has a word within the edits of any of their words."""
    held = search(index, [f"*{a}*" for a in authors]).select("id")
    spark = index.values.sparkSession
    asked = spark.createDataFrame([(w,) for a in authors for w in relevance.query_words(a)], "word string")
    near = relevance.fuzzy_terms(asked, words).select("term").distinct()
    return held.unionByName(words.postings.filter(F.col("field") == field).join(near, "term").select(F.col("doc").alias("id"))).distinct()
