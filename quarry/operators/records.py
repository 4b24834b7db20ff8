"""Joins, deduplication and validation of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in the given order, which must be total for a fixed result."""
    at = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__n", at).filter("__n = 1").drop("__n")


def keep_last(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the last; order is given descending."""
    return keep_first(df, key, order)


def left_with_stub(ids: DataFrame, found: DataFrame, key: str, source: str = "not_found") -> DataFrame:
    """Every requested id with what was found, or a stub row: enriched says which, source names the stub."""
    known = found.dropDuplicates([key]).withColumn("__hit", F.lit(True))
    out = ids.select(key).distinct().join(known, key, "left")
    return out.withColumn("enriched", F.coalesce("__hit", F.lit(False))).withColumn("source", F.when(F.col("__hit"), F.lit("found")).otherwise(F.lit(source))).drop("__hit")


def lookup(df: DataFrame, column: str, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """Translate a column by a table of names; what has no name stays as it is. The table's size decides the join."""
    pairs = names.select(F.col(key).alias("__k"), F.col(name).alias("__v"))
    return df.join(pairs, F.col(column) == F.col("__k"), "left").withColumn(out, F.coalesce("__v", F.col(column).cast("string"))).drop("__k", "__v")


def lookup_arrays(df: DataFrame, id_col: str, columns: list[str], names: DataFrame, key: str, name: str) -> DataFrame:
    """The same for the elements of some array columns, keeping their order: one explode and one join for all columns.

    Rows are told apart by their id and arrays together, so repeated ids keep their own arrays; null ids are one id.
    """
    none = F.array().cast("array<string>")
    packed = df.withColumn("__packed", F.array(*[F.coalesce(F.col(c).cast("array<string>"), none) for c in columns]))
    long = packed.select(id_col, "__packed").distinct().select(id_col, "__packed", F.posexplode("__packed").alias("__field", "__items"))
    named = lookup(long.select(id_col, "__packed", "__field", F.posexplode("__items").alias("__pos", "__item")), "__item", names, key, name, "__name")
    found = named.filter(F.col("__name").isNotNull()).groupBy(F.col(id_col).alias("__id"), F.col("__packed").alias("__same"))
    back = found.agg(F.array_sort(F.collect_list(F.struct("__field", "__pos", "__name"))).alias("__all"))
    out = packed.join(back, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__packed") == F.col("__same")), "left")

    def own(at: int) -> Column:
        return F.coalesce(F.transform(F.filter("__all", lambda x: x["__field"] == at), lambda x: x["__name"]), none)

    return out.withColumns({c: own(i) for i, c in enumerate(columns)}).drop("__packed", "__id", "__same", "__all")


def lookup_array(df: DataFrame, id_col: str, column: str, names: DataFrame, key: str, name: str) -> DataFrame:
    """lookup_arrays() for one column."""
    return lookup_arrays(df, id_col, [column], names, key, name)


def first_hit(df: DataFrame, column: str, tables: list[tuple[DataFrame, str]], value: str, key: Column | None = None) -> DataFrame:
    """Look a value up in several tables by several keys; the first table that has it wins."""
    out = df
    hits = []
    for i, (table, own) in enumerate(tables):
        part = table.select(F.col(own).alias(f"__k{i}"), F.col(value).alias(f"__v{i}")).dropDuplicates([f"__k{i}"])
        out = out.join(part, (key if key is not None else F.col(column)) == F.col(f"__k{i}"), "left")
        hits.append(F.col(f"__v{i}"))
    return out.withColumn(value, F.coalesce(*hits)).drop(*[f"__{c}{i}" for i in range(len(tables)) for c in "kv"])


def without(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not known."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all rules, and the others with the names of the rules they break. A null outcome breaks a rule."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    judged = df.withColumn("errors", broken)
    return judged.filter(F.size("errors") == 0).drop("errors"), judged.filter(F.size("errors") > 0)


def enough_information(tag: Column, tags: Column, card: Column, least: int = 200) -> Column:
    """The record has a task, a tag and a card that is long enough and not the unfilled template."""
    card = F.coalesce(card, F.lit(""))
    marks = [F.contains(card, F.lit(m)).cast("int") for m in TEMPLATE_MARKS]
    gap = "[More Information Needed]"
    gaps = (F.length(card) - F.length(F.replace(card, F.lit(gap), F.lit("")))) / len(gap)
    unfilled = (gaps >= 38) & (reduce(lambda a, b: a + b, marks) >= 7)
    return (F.coalesce(tag, F.lit("")) != "") & (F.size(F.coalesce(tags, F.array().cast("array<string>"))) > 0) & (F.length(card) >= least) & ~unfilled


#: Sentences of the unfilled card template.
TEMPLATE_MARKS = (
    "<!-- Provide a quick summary of what the model is/does. -->",
    "This is the model card of a 🤗 transformers model that has been pushed on the Hub. This model card has been automatically generated.",
    "[More Information Needed]",
    "<!-- Address questions around how the model is intended to be used, including the foreseeable users of the model and those affected by the model. -->",
    "<!-- This relates heavily to the Technical Specifications. Content here should link to that section when it is relevant to the training procedure. -->",
    "<!-- This section is meant to convey recommendations with respect to the bias, risk, and technical limitations. -->",
    "<!-- Provide the basic links for the model. -->",
    "## Model Card Contact",
)


def has_minimum(columns: list[str], texts: list[str], missing: tuple[str, ...] = ("", "Unknown")) -> Column:
    """All columns are there, and the texts among them are none of the values that stand for missing ones."""
    out = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    for c in texts:
        out = out & ~F.coalesce(F.col(c), F.lit("")).isin(*missing)
    return out


def date_filter(column: Column, given: str) -> Column:
    """from,to with either end open, or one exact day."""
    day = F.date_format(column, "yyyy-MM-dd")
    if "," not in given:
        return day == F.lit(given.strip())
    low, _, high = (p.strip() for p in given.partition(","))
    out = F.lit(True)
    if low:
        out = out & (day >= F.lit(low))
    if high:
        out = out & (day <= F.lit(high))
    return out
