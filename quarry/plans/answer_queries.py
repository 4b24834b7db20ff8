"""Queries over composed answers, with customers, parts and events standing in for models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.operators import answers
from quarry.plans.graph_queries import edges_of
from quarry.session import table


def _node(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _card_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations' graph, the segments of customers and the priorities of their orders."""
    segments = table(spark, sf_dir, "customer").select(_node("c", "c_custkey").alias("src"), F.lit("segment").alias("rel"), F.col("c_mktsegment").alias("dst"))
    orders = table(spark, sf_dir, "orders").select(_node("c", "o_custkey").alias("src"), F.lit("priority").alias("rel"), F.col("o_orderpriority").alias("dst"))
    return edges_of(spark, sf_dir).unionByName(segments).unionByName(orders)


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are the models, a third of them without a name; nations are entities."""
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(_node("c", "c_custkey").alias("id"), F.lit("Customer").alias("label"), F.when(k % 3 != 0, F.col("c_name")).alias("name"))
    nations = table(spark, sf_dir, "nation").select(_node("n", "n_nationkey").alias("id"), F.lit("Nation").alias("label"), F.col("n_name").alias("name"))
    return customers.unionByName(nations)


def _cards_sql(nation: str, page: str) -> str:
    return f"""
    WITH m AS (SELECT c_custkey, 'c' || c_custkey AS model, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name, c_mktsegment
               FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {nation}),
    p AS (SELECT *, (SELECT count(*) FROM m) AS total FROM m ORDER BY coalesce(name, model), model {page})
    SELECT model, name, 'customer_of' AS rel, total::BIGINT AS total, c_mktsegment AS segments,
           (SELECT string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS priorities FROM p"""


def _cards(found: DataFrame) -> DataFrame:
    said = lambda rel, name: F.array_join(F.try_element_at("relations", F.lit(rel)), ",").alias(name)
    return found.select("model", "name", "rel", "total", said("segment", "segments"), said("priority", "priorities"))


@register("models_of_entity", _cards_sql("n_nationkey = 3", "LIMIT 4 OFFSET 1"))
def models_of_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second to fifth customer of a nation, with how many there are and what their cards show."""
    nodes = _nodes(spark, sf_dir)
    return _cards(answers.models_of(_card_edges(spark, sf_dir), nodes, nodes.filter("id = 'n3'"), "Customer", ["segment", "priority"], 1, 4))


@register("models_of_entity_name", _cards_sql("n_name = 'NATION_7'", ""))
def models_of_entity_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers of a nation that is given by name, with their cards."""
    nodes = _nodes(spark, sf_dir)
    named = answers.entity_named(nodes.filter("label = 'Nation'"), "nation_7")
    return _cards(answers.models_of(_card_edges(spark, sf_dir), nodes, named, "Customer", ["segment", "priority"]))


@register(
    "related_answer",
    """
    WITH p AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS kind, p_size AS size, string_split(p_name, ' ') AS words FROM part),
    r AS (SELECT * FROM p WHERE id = 3),
    s AS (SELECT 'same_brand' AS category, p.*, 1 AS score FROM p, r WHERE p.id <> 3 AND p.brand = r.brand
          UNION ALL SELECT 'alike_words', p.*, len(list_intersect(p.words, r.words)) FROM p, r WHERE p.id <> 3 AND len(list_intersect(p.words, r.words)) > 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, id) AS rk FROM s),
    f AS (SELECT * FROM k WHERE rk <= 40 AND kind IN ('ECONOMY', 'PROMO', 'STANDARD')),
    w AS (SELECT category, unnest(list_distinct(words)) AS value FROM f)
    SELECT 'model' AS part, category, NULL AS facet, id::VARCHAR AS value, rk::BIGINT AS n FROM f
    UNION ALL SELECT 'facet', category, 'kind', kind, count(*)::BIGINT FROM f GROUP BY ALL
    UNION ALL SELECT 'facet', category, 'words', value, count(*)::BIGINT FROM w GROUP BY ALL
    UNION ALL SELECT 'total', NULL, NULL, NULL, count(*)::BIGINT FROM f
    """,
)
def related_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts related to part 3 by brand and by words, filtered by type, with facets of both categories and the total."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.split("p_name", " ").alias("words"))
    categories = {
        "same_brand": lambda ref: (F.col("brand") == ref["brand"]).cast("int"),
        "alike_words": lambda ref: F.size(F.array_intersect("words", ref["words"])),
    }
    wanted = {"kind": ["ECONOMY", "PROMO", "STANDARD"]}
    return answers.related_answer(parts, parts.filter("id = 3"), "id", categories, wanted, ["kind", "words"], most=40)


def _event_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as models: every event is a snapshot of its type's predicate until the type's next one."""
    until = F.lead("event_id").over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    return table(spark, sf_dir, "events").select(
        _node("c", "user_id").alias("model_uri"), F.col("event_type").alias("predicate_iri"), F.col("props").alias("value"), F.lit(None).cast("string").alias("value_uri"),
        F.concat(F.lit("from "), "event_type").alias("extraction_method"), (F.col("event_id") % 100 / 100).alias("confidence"), F.lit(None).cast("string").alias("notes"),
        F.col("event_id").alias("valid_from"), until.alias("valid_to"), F.col("event_id").cast("string").alias("snapshot_hash"),
    )


@register(
    "model_detail_extraction",
    """
    WITH l AS (SELECT event_type, max(event_id) AS last FROM events WHERE user_id = 13 GROUP BY event_type)
    SELECT 13::BIGINT AS model_id, 'n' || c_nationkey AS nation, event_type AS predicate, 'from ' || event_type AS method, (last % 100) / 100.0::DOUBLE AS confidence
    FROM l, customer WHERE c_custkey = 13
    """,
)
def model_detail_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model with its related entities and how each of its predicates was extracted last."""
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("model_id"), _node("c", "c_custkey").alias("iri"))
    found = answers.detail_with_extraction(docs, edges_of(spark, sf_dir), _event_store(spark, sf_dir), "c13")
    rows = found.select("model_id", F.try_element_at("related", F.lit("customer_of"))[0].alias("nation"), F.explode("extraction").alias("predicate", "m"))
    return rows.select("model_id", "nation", "predicate", F.col("m.extraction_method").alias("method"), F.col("m.confidence").alias("confidence"))


@register(
    "model_history_extraction",
    """
    WITH e AS (SELECT event_id, event_type, props, lead(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS until FROM events WHERE user_id = 13)
    SELECT m.event_id AS moment, e.event_type AS predicate_iri, upper(e.props) AS name, 'from ' || e.event_type AS method, (e.event_id % 100) / 100.0::DOUBLE AS confidence
    FROM e JOIN e AS m ON e.event_id <= m.event_id AND (e.until IS NULL OR e.until > m.event_id)
    """,
)
def model_history_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model's states at each of its changes, every value by name and with how it was extracted."""
    names = table(spark, sf_dir, "events").filter("user_id = 13").select(F.col("props").alias("iri"), F.upper("props").alias("name")).distinct()
    states = answers.history_with_extraction(_event_store(spark, sf_dir), names, "c13")
    return states.select("moment", "predicate_iri", F.explode("values").alias("v")).select("moment", "predicate_iri", "v.name", "v.method", "v.confidence")
