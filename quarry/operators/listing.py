"""List views composed: one filtered set with its page, total and facets; exact look-ups; related records by rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.operators import facets, graph, records, search


@dataclass(frozen=True)
class Facet:
    """How a facet is shown."""

    field: str
    label: str
    kind: str
    many_values: bool
    size: int
    searchable: bool
    pinned: bool


#: The facets of model lists.
FACETS = {
    "mlTask": Facet("ml_tasks", "ML Tasks", "keyword", False, 20, True, True),
    "license": Facet("license", "Licenses", "keyword", False, 10, True, True),
    "keywords": Facet("keywords", "Keywords", "keyword", True, 20, True, True),
    "sharedBy": Facet("shared_by", "Shared By", "keyword", True, 10, True, False),
    "datasets": Facet("datasets", "Datasets", "keyword", True, 10, True, False),
    "platform": Facet("source", "Platform", "keyword", False, 5, False, True),
    "dateCreated": Facet("datecreated", "Date Created", "date", False, 12, False, True),
}

#: Fields that a listed model must have, and those of them that must not be a stand-in.
REQUIRED = ("db_identifier", "name", "url", "shared_by", "datecreated", "datemodified", "description", "keywords", "license", "readme", "ml_tasks", "source")
REQUIRED_TEXTS = ("name", "description", "shared_by", "license", "readme", "source")


def facet_table(spark: SparkSession, config: dict[str, Facet] = FACETS) -> DataFrame:
    """(facet, field, label, kind, many_values, size, searchable, pinned)."""
    rows = [(k, f.field, f.label, f.kind, f.many_values, f.size, f.searchable, f.pinned) for k, f in config.items()]
    return spark.createDataFrame(rows, "facet string, field string, label string, kind string, many_values boolean, size int, searchable boolean, pinned boolean")


def listed(docs: DataFrame, required: tuple[str, ...] = REQUIRED, texts: tuple[str, ...] = REQUIRED_TEXTS) -> DataFrame:
    """The rows with the minimum of metadata; an empty list counts as missing."""
    arrays = [n for n, t in docs.dtypes if n in required and t.startswith("array")]
    enough = records.has_minimum(list(required), list(texts))
    for name in arrays:
        enough = enough & (F.size(name) > 0)
    return docs.filter(enough)


def faceted_search(
    docs: DataFrame,
    id_col: str,
    query: str = "",
    fields: dict[str, float] | None = None,
    filters: dict[str, list[str]] | None = None,
    exclude: DataFrame | None = None,
    facet_fields: dict[str, int] | None = None,
    number: int = 1,
    size: int = 20,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Page, facet counts and total of one filtered set.

    The page has the columns of docs and `score`; facets are (facet, value, n, rk), each with its own size; the total is
    (total). Rows in `exclude` (column id_col) are left out of the page only, so that counts stay while one pages.
    Without a query all rows match with score 0 and are in the order of their ids.
    """
    found = facets.filter_all(docs, filters or {})
    found = found.withColumn("score", search.text_score(query, fields or {}) if query else F.lit(0.0))
    if query:
        found = found.filter("score > 0")
    shown = records.without(found, exclude, [id_col]) if exclude is not None else found
    page = graph.page(shown, [F.desc("score"), id_col], number, size, excluding=exclude is not None)
    counts = facets.facet_counts(found, list(facet_fields or {}), max((facet_fields or {"": 1}).values()))
    for name, most in (facet_fields or {}).items():
        counts = counts.filter((F.col("facet") != name) | (F.col("rk") <= most))
    return page, counts, found.agg(F.count(F.lit(1)).alias("total"))


def by_identifier(docs: DataFrame, identifiers: str, iri: Column, id_col: str) -> DataFrame:
    """The row that has the IRI among its identifiers; the least id if there are several."""
    return docs.filter(F.array_contains(F.col(identifiers), iri)).orderBy(id_col).limit(1)


def sharing(docs: DataFrame, ref: DataFrame, id_col: str, column: str, first: int | None = None) -> DataFrame:
    """Rows of docs with `shared`, how many of the reference's values (or the first few of them) they have; at least one.

    ref is one row; the reference itself is left out.
    """
    wanted = F.col(column) if first is None else F.slice(column, 1, first)
    one = ref.select(F.col(id_col).alias("__ref"), F.array_distinct(wanted).alias("__wanted")).limit(1)
    both = docs.join(F.broadcast(one), F.col(id_col) != F.col("__ref"))  # one row
    counted = both.withColumn("shared", F.size(F.array_intersect(F.array_distinct(column), "__wanted")))
    return counted.filter("shared > 0").drop("__ref", "__wanted")


def other_sizes(docs: DataFrame, ref: DataFrame, id_col: str, name_col: str, least: int = 4) -> DataFrame:
    """Rows whose name without size marks is the reference's, or holds it; none if that is shorter than `least`."""
    one = ref.select(F.col(id_col).alias("__ref"), F.lower(text.without_size(F.col(name_col))).alias("__base")).limit(1).filter(F.length("__base") >= least)
    alike = (F.col(id_col) != F.col("__ref")) & F.contains(F.lower(name_col), F.col("__base"))
    return docs.join(F.broadcast(one), alike).drop("__ref", "__base")  # one row


def only(related: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Related rows whose attributes are among the wanted values, all of them."""
    keep = F.lit(True)
    for column, values in wanted.items():
        keep = keep & F.coalesce(F.col(column).isin(*values), F.lit(False))
    return related.filter(keep)


def epoch_filter(column: Column, given: str) -> Column:
    """from,to or one day, as milliseconds since 1970 (UTC); both ends count, the last day whole."""
    at = F.unix_millis(column)
    start = lambda d: F.unix_millis(F.to_timestamp(F.lit(d + " 00:00:00")))
    if "," not in given:
        return at == start(given.strip())
    low, _, high = (p.strip() for p in given.partition(","))
    out = F.lit(True)
    if low:
        out = out & (at >= start(low))
    if high:
        out = out & (at <= start(high) + 86_399_000)
    return out
