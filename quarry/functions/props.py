"""Property maps of graph entities: pruning, short and plain names, values as lists. Pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for a missing value.
NULL_LIKE = ("", "Information not found")


def is_null_like(value: Column) -> Column:
    return value.isNull() | value.isin(*NULL_LIKE)


def prune(values: Column) -> Column:
    """A map from property to list without the properties whose values are all null-like."""
    return F.map_filter(values, lambda _, v: ~F.forall(v, is_null_like))


def short_keys(values: Column) -> Column:
    """schema__name -> name. Of keys that become equal the last in the order of the long ones counts."""
    entries = F.array_sort(F.map_entries(values))
    named = F.transform(entries, lambda e: F.struct(F.element_at(F.split(e["key"], "__"), -1).alias("key"), e["value"].alias("value")))
    keys = F.transform(named, lambda e: e["key"])
    return F.map_from_entries(F.filter(named, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])))


def renamed(values: Column, aliases: dict[str, str]) -> Column:
    """Keys that have an alias under that name, others as they are."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.transform_keys(values, lambda k, _: F.coalesce(F.try_element_at(table, k), k))


def as_lists(values: Column, labels: Column) -> Column:
    """A map from property to list of texts without nulls, with the entity's types: its labels that name a vocabulary.

    An entity that is a bare resource has the type schema__url.
    """
    known = F.map_filter(F.transform_values(values, lambda _, v: F.array_compact(v)), lambda k, _: k != "type")
    bare = F.when((F.size(labels) == 1) & (F.get(labels, 0) == "Resource"), F.array(F.lit("schema__url"))).otherwise(F.array().cast("array<string>"))
    types = F.concat(F.filter(labels, lambda x: F.contains(x, F.lit("__"))), bare)
    return F.when(F.size(labels) > 0, F.map_concat(known, F.create_map(F.lit("type"), types))).otherwise(known)


def overlaid(base: Column, over: Column) -> Column:
    """Two maps as one; entries of the second win."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def links(values: Column) -> Column:
    """All values of a map from property to list that are web addresses, each once, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.map_values(values)), lambda v: F.startswith(v, F.lit("https://")))))
