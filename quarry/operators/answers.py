"""Composed answers: models of an entity with their cards, related records with filter and facets, details with metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import catalogue, facets, listing, temporal
from quarry.session import cut_lineage


def entity_named(nodes: DataFrame, name: str) -> DataFrame:
    """(id) of the node with a name, whatever its case; the least id of several, no row if there is none."""
    return nodes.filter(F.lower("name") == F.lower(F.lit(name))).select("id").orderBy("id").limit(1)


def models_of(edges: DataFrame, nodes: DataFrame, entity: DataFrame, label: str, card_rels: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """(model, name, rel, total, relations): a page of the models linked to an entity in either direction.

    entity is one row (id), as entity_named() gives it; nodes are (id, label, name) with distinct ids. Models are in the
    order of their name, or id where they have none, then of their id; `rel` is the least relation to the entity,
    `total` counts the models of all pages. `relations` maps each card relation that a model has to its sorted targets;
    a model without any stays, with an empty map. A negative offset is 0, a negative limit none.

    The page is cut before the cards are looked up, so only the edges of its models are grouped.
    """
    one = F.broadcast(entity.select(F.col("id").alias("__id")).limit(1))  # one row
    into = edges.join(one, F.col("dst") == F.col("__id")).select(F.col("src").alias("model"), "rel")
    out_of = edges.join(one, F.col("src") == F.col("__id")).select(F.col("dst").alias("model"), "rel")
    linked = into.unionByName(out_of).groupBy("model").agg(F.min("rel").alias("rel"))
    # written once, as the total and the page read it: two readers of the plan would each scan the edges
    found = cut_lineage(linked.join(nodes.filter(F.col("label") == label).select(F.col("id").alias("model"), "name"), "model"))
    order = [F.coalesce("name", "model"), F.col("model")]
    shown = found.orderBy(*order).offset(max(offset, 0))
    bounded = limit is not None and limit >= 0
    shown = shown.limit(limit) if bounded else shown
    page = shown.join(F.broadcast(found.agg(F.count(F.lit(1)).alias("total"))))  # one row
    keys = page.select(F.col("model").alias("src"))
    own = edges.filter(F.col("rel").isin(*card_rels)).join(F.broadcast(keys) if bounded else keys, "src", "left_semi")  # a page
    by_rel = own.groupBy("src", "rel").agg(F.array_sort(F.collect_set("dst")).alias("targets"))
    cards = by_rel.groupBy(F.col("src").alias("model")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rel", "targets")))).alias("relations"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    return page.join(cards, "model", "left").withColumn("relations", F.coalesce("relations", none)).orderBy(*order)


def related_answer(
    docs: DataFrame,
    ref: DataFrame,
    id_col: str,
    categories: dict[str, Callable[[Column], Column]],
    wanted: dict[str, list[str]] | None = None,
    facet_fields: list[str] | None = None,
    most: int = 10,
) -> DataFrame:
    """(part, category, facet, value, n): related records by category, filtered, with the facets of what is left.

    ref is one row of docs; each category maps that row (a struct) to a score, and a record with a score above 0 is
    related. The best `most` of each category, by score and then id, are filtered by `wanted`; what is left is counted
    for the facets. Parts are `model` (value: the id, n: its rank in the category before the filter), `facet` and `total`
    (over all categories, a record once for each).

    One scan of docs: the rank keeps `most` rows of a category in each task before the shuffle, and all parts come from
    one grouping of the few rows that are left.
    """
    one = F.broadcast(ref.limit(1).select(F.struct(*ref.columns).alias("__ref")))  # one row
    pairs = docs.join(one, F.col(id_col) != F.col(f"__ref.{id_col}"))
    scored = F.array(*[F.struct(F.lit(name).alias("category"), rule(F.col("__ref")).cast("double").alias("score")) for name, rule in categories.items()])
    fields = list(dict.fromkeys([id_col, *(wanted or {}), *(facet_fields or [])]))
    hits = pairs.select(*fields, F.explode(F.filter(scored, lambda s: s["score"] > 0)).alias("__hit"))
    rank = F.row_number().over(Window.partitionBy("__hit.category").orderBy(F.desc("__hit.score"), id_col))
    best = listing.only(hits.withColumn("__rank", rank).filter(F.col("__rank") <= most), wanted or {})
    none, category = F.lit(None).cast("string"), F.col("__hit.category")
    entry = lambda part, cat, facet, value, n: F.struct(F.lit(part).alias("part"), cat.alias("category"), facet.alias("facet"), value.alias("value"), n.cast("long").alias("n"))
    said = [F.array(entry("model", category, none, F.col(id_col).cast("string"), F.col("__rank")), entry("total", none, none, none, F.lit(1)))]
    in_facet = lambda name: lambda v: entry("facet", category, F.lit(name), v, F.lit(1))
    said += [F.transform(facets.values(best, name), in_facet(name)) for name in facet_fields or []]
    parts = best.select(F.explode(F.flatten(F.array(*said))).alias("p")).select("p.*")
    return parts.groupBy("part", "category", "facet", "value").agg(F.sum("n").alias("n"))


def detail_with_extraction(docs: DataFrame, edges: DataFrame, store: DataFrame, iri: str) -> DataFrame:
    """catalogue.model_detail() with `extraction`: a map from predicate to how its latest open snapshot was extracted."""
    own = temporal.current_metadata(store.filter(F.col("model_uri") == iri))
    entries = F.struct("predicate_iri", F.struct("extraction_method", "confidence", "notes"))
    return catalogue.model_detail(docs, edges, iri).join(F.broadcast(own.agg(F.map_from_entries(F.array_sort(F.collect_list(entries))).alias("extraction"))))  # one row


def history_with_extraction(store: DataFrame, names: DataFrame, model: str) -> DataFrame:
    """(moment, predicate_iri, values): a model's states, newest first; values are (name, method, confidence, notes), sorted."""
    own = store.filter(F.col("model_uri") == model)
    named = catalogue.named_states(own, names)
    value = F.struct(F.col("v_name").alias("name"), F.col("extraction_method").alias("method"), "confidence", "notes")
    return named.groupBy("moment", "predicate_iri").agg(F.array_sort(F.collect_set(value)).alias("values")).orderBy(F.desc("moment"), "predicate_iri")
