"""Queries over the catalogue's transforms, with documents and parts standing in for model records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.catalog import register
from quarry.functions import idents
from quarry.operators import catalogue, identify
from quarry.session import table


@register(
    "extract_page",
    """
    WITH s AS (SELECT 'm' || c_custkey AS id, DATE '2020-01-01' + c_custkey::INTEGER AS d, c_acctbal AS b FROM customer
               UNION ALL SELECT 'm' || c_custkey, DATE '2034-01-01' + c_custkey::INTEGER, c_acctbal FROM customer WHERE c_custkey % 10 = 0),
    k AS (SELECT id, max(d) AS d, any_value(b) AS b FROM s GROUP BY id)
    SELECT id AS "modelId", strftime(d, '%Y-%m-%d') AS last_modified FROM k WHERE b > 0 ORDER BY d DESC, id LIMIT 20 OFFSET 5
    """,
)
def extract_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda start: F.expr(f"date_add(DATE '{start}', CAST(c_custkey AS INT))").alias("last_modified")
    name = F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("modelId")
    customers = table(spark, sf_dir, "customer")
    snapshot = customers.select(name, day("2020-01-01"), "c_acctbal")
    recent = customers.filter("c_custkey % 10 = 0").select(name, day("2034-01-01"), "c_acctbal")
    out = catalogue.extract_page(snapshot, recent, F.col("c_acctbal") > 0, limit=20, offset=5)
    return out.select("modelId", F.date_format("last_modified", "yyyy-MM-dd").alias("last_modified"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify.identify(docs, "doc_id", {"language": F.array("lang"), "source": F.array("source")})


_SIDE = f"""
    e AS (SELECT DISTINCT 'language' AS kind, lang AS value, 'Language' AS type FROM documents
          UNION SELECT DISTINCT 'source', source, 'WebSite' FROM documents),
    i AS (SELECT *, '{idents.GRAPH}' || sha256('{{"id": "' || value || '", "platform": "HF", "type": "' || kind || '"}}') AS iri FROM e)
"""


@register(
    "side_entities",
    f"WITH {_SIDE} SELECT kind, value, iri, type, CASE WHEN value = 'en' THEN 'English' ELSE value END AS name, value = 'en' AS enriched FROM i",
)
def side_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = spark.createDataFrame([("language", "en", "English", None, None)], "kind string, value string, name string, description string, url string")
    return catalogue.side_entities(_links(spark, sf_dir), "HF", details).select("kind", "value", "iri", "type", "name", "enriched")


@register(
    "linked_documents",
    f"WITH {_SIDE} SELECT doc_id, l.iri AS language, s.iri AS source FROM documents JOIN i l ON l.kind = 'language' AND l.value = lang JOIN i s ON s.kind = 'source' AND s.value = source",
)
def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = identify.linked(_links(spark, sf_dir), "doc_id", "HF")
    first = lambda k: F.get(F.try_element_at("links", F.lit(k)), 0).alias(k)
    return linked.select("doc_id", first("language"), first("source"))


@register(
    "translation_map",
    f"WITH {_SIDE} SELECT iri, CASE WHEN kind = 'language' THEN upper(value) ELSE value END AS name FROM i",
)
def translation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = catalogue.side_entities(_links(spark, sf_dir), "HF").select("kind", "iri", "name")
    later = entities.filter("kind = 'language'").withColumn("name", F.upper("name"))
    return catalogue.translation([entities, later])


@register(
    "facets_of_related",
    """
    WITH r AS (SELECT 'same_brand' AS category, p.* FROM part p, part q WHERE q.p_partkey = 1 AND p.p_brand = q.p_brand AND p.p_partkey <> 1
               UNION ALL SELECT 'same_type', p.* FROM part p, part q WHERE q.p_partkey = 1 AND p.p_type = q.p_type AND p.p_partkey <> 1)
    SELECT category, p_size::VARCHAR AS value, count(*)::BIGINT AS n FROM r GROUP BY 1, 2
    """,
)
def facets_of_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    ref = parts.filter("p_partkey = 1").select(F.col("p_brand").alias("b"), F.col("p_type").alias("t"))
    joined = parts.filter("p_partkey <> 1").join(F.broadcast(ref))  # one row
    kinds = F.array_compact(F.array(F.when(F.col("p_brand") == F.col("b"), F.lit("same_brand")), F.when(F.col("p_type") == F.col("t"), F.lit("same_type"))))
    rows = joined.select(F.explode(kinds).alias("category"), F.col("p_size").cast("string").alias("value"))
    return rows.groupBy("category", "value").agg(F.count(F.lit(1)).alias("n"))


@register("schema_fields", "SELECT * FROM (VALUES " + ", ".join(f"('{f.name}', {repr(f.metadata.get('iri')) if f.metadata.get('iri') else 'NULL'}, '{f.dataType.simpleString()}')" for f in schemas.MODEL) + ") AS t(property, iri, type)")
def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.field_table(spark)
