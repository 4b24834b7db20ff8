"""Queries over the search side: facets, paging, filters, text and vector search, related records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import maths, text
from quarry.operators import facets, graph, records, search
from quarry.session import table


@register(
    "facet_counts",
    """
    WITH f AS (SELECT * FROM documents WHERE lang = 'en'),
    c AS (
      SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM f WHERE lang IS NOT NULL GROUP BY lang
      UNION ALL
      SELECT 'source', source, count(*) FROM f WHERE source IS NOT NULL GROUP BY source),
    r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rk FROM c)
    SELECT facet, value, CAST(n AS BIGINT) AS n, CAST(rk AS INTEGER) AS rk FROM r WHERE rk <= 10
    """,
)
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return facets.facet_counts(facets.filter_all(docs, {"lang": ["en"]}), ["lang", "source"], size=10)


@register(
    "facet_multivalued",
    """
    WITH t AS (SELECT unnest(string_split(p_type, ' ')) AS value, p_partkey FROM part),
    c AS (SELECT value, count(DISTINCT p_partkey) AS n FROM t GROUP BY value)
    SELECT 'types' AS facet, value, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rk FROM c
    QUALIFY rk <= 20
    """,
)
def facet_multivalued(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("types", F.split("p_type", " "))
    return facets.facet_counts(parts, ["types"], size=20)


@register(
    "facet_filter_any_all",
    """
    SELECT 'all' AS mode, count(*)::BIGINT AS n FROM documents WHERE lang = 'en' AND lang = 'fr'
    UNION ALL SELECT 'any', count(*)::BIGINT FROM documents WHERE lang IN ('en', 'fr') AND source IN ('src1', 'src2')
    """,
)
def facet_filter_any_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    every = facets.filter_all(docs, {"lang": ["en", "fr"]}).agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("mode"), "n")
    some = facets.filter_all(docs, {"lang": ["en", "fr"], "source": ["src1", "src2"]}, mode="any")
    return every.union(some.agg(F.count(F.lit(1)).alias("n")).select(F.lit("any").alias("mode"), "n"))


@register(
    "facet_values_page",
    """
    WITH c AS (SELECT source AS value, count(*)::BIGINT AS n FROM documents WHERE source > 'src1' GROUP BY source),
    p AS (SELECT *, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS total FROM c)
    SELECT value, n, total > 5 AS has_more FROM p WHERE i <= 5
    """,
)
def facet_values_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet_page(table(spark, sf_dir, "documents"), "source", after="src1", size=5)


@register(
    "facet_values_search",
    "SELECT source AS value, count(*)::BIGINT AS n FROM documents WHERE contains(source, '1') GROUP BY source ORDER BY n DESC, value LIMIT 8",
)
def facet_values_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet_search(table(spark, sf_dir, "documents"), "source", "1", size=8)


@register(
    "facet_context_excl_self",
    """
    SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*)::BIGINT AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 2
    UNION ALL
    SELECT 'o_orderpriority', o_orderpriority, count(*)::BIGINT FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
    """,
)
def facet_context_excl_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT"]}
    return facets.facet_counts_in_context(table(spark, sf_dir, "orders"), filters)


@register(
    "month_histogram",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate) AS mo, count(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT unnest(generate_series(min(mo), max(mo), INTERVAL 1 MONTH)) AS mo FROM m)
    SELECT strftime(s.mo, '%Y-%m-%d') AS month, coalesce(n, 0)::BIGINT AS n FROM s LEFT JOIN m USING (mo)
    """,
)
def month_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.month_histogram(table(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "min_metadata_filter",
    "SELECT count(*)::BIGINT AS n FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND text NOT IN ('', 'Unknown') AND lang NOT IN ('', 'Unknown')",
)
def min_metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = records.has_minimum(["text", "lang", "source"], ["text", "lang"])
    return table(spark, sf_dir, "documents").filter(keep).agg(F.count(F.lit(1)).alias("n"))


@register(
    "quality_filter",
    "SELECT doc_id FROM documents WHERE coalesce(lang, '') <> '' AND length(coalesce(text, '')) >= 200",
)
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.filter(records.enough_information(F.col("lang"), F.array("source"), F.col("text"))).select("doc_id")


@register(
    "date_range_filter",
    "SELECT count(*)::BIGINT AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1996-01-01' AND '1996-06-30'",
)
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.filter(records.date_filter(F.col("o_orderdate"), "1996-01-01,1996-06-30")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "recent_updates",
    """
    SELECT event_type, count(*)::BIGINT AS n FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events) GROUP BY event_type
    """,
)
def recent_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    last = events.agg((F.max("ts") - F.expr("INTERVAL 7 DAY")).alias("since"))
    recent = events.join(F.broadcast(last), F.col("ts") >= F.col("since"))  # one row
    return recent.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register(
    "exclude_ids_page",
    "SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) ORDER BY n_chars DESC, doc_id LIMIT 20",
)
def exclude_ids_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", "n_chars")
    seen = table(spark, sf_dir, "labels").filter("quality = 0")
    return graph.page(records.without(docs, seen, ["doc_id"]), [F.desc("n_chars"), "doc_id"], 2, 20, excluding=True)


@register("documents_page_3", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25 OFFSET 50")
def documents_page_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 3, 25)


@register(
    "keyset_page",
    """
    WITH r AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey > 100 ORDER BY c_custkey LIMIT 11),
    n AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS i, count(*) OVER () AS total FROM r)
    SELECT c_custkey, c_name, total > 10 AS has_more FROM n WHERE i <= 10
    """,
)
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page_after(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 100, 10)


_TERMS = search.terms_of("the license_with care")
_FIELDS = {"text": 2.5, "source": 1.0}
_SCORE = " + ".join(f"CASE WHEN contains(lower(coalesce({f}, '')), '{t}') THEN {b} ELSE 0 END" for t in _TERMS for f, b in _FIELDS.items())


@register("text_match_bool", f"SELECT doc_id, CAST({_SCORE} AS DOUBLE) AS score FROM documents WHERE ({_SCORE}) > 0")
def text_match_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", search.text_score("the license_with care", _FIELDS).alias("score")).filter("score > 0")


@register("text_search_page", f"SELECT doc_id, CAST({_SCORE} AS DOUBLE) AS score FROM documents WHERE ({_SCORE}) > 0 ORDER BY score DESC, doc_id LIMIT 20 OFFSET 20")
def text_search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.text_search(docs, "the license_with care", _FIELDS, "doc_id", number=2).select("doc_id", "score")


@register(
    "fuzzy_name_match",
    """
    SELECT p_partkey, p_name FROM part
    WHERE len(list_filter(string_split(p_name, ' '), lambda w: levenshtein(lower(w), 'widgit') <= 2)) > 0
       OR len(list_filter(string_split(p_brand, '#'), lambda w: levenshtein(lower(w), 'brend') <= 1)) > 0
    """,
)
def fuzzy_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    hit = search.fuzzy_match(F.split("p_name", " "), "widgit") | search.fuzzy_match(F.split("p_brand", "#"), "brend")
    return parts.filter(hit).select("p_partkey", "p_name")


_QUERY_VECTOR = [((i * 37) % 11 - 5) / 5.0 for i in range(64)]
_VECTOR_SQL = "[" + ", ".join(f"{v}::DOUBLE" for v in _QUERY_VECTOR) + "]"


@register(
    "vector_topk",
    f"""
    SELECT vec_id, label, round((list_cosine_similarity(embedding::DOUBLE[], {_VECTOR_SQL}) + 1) / 2, 6) AS score
    FROM embeddings ORDER BY (list_cosine_similarity(embedding::DOUBLE[], {_VECTOR_SQL}) + 1) / 2 DESC, vec_id LIMIT 10
    """,
)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = F.array(*[F.lit(v) for v in _QUERY_VECTOR])
    top = search.vector_top_k(table(spark, sf_dir, "embeddings"), query, 10, "vec_id", "embedding")
    return top.select("vec_id", "label", F.round("score", 6).alias("score"))


@register(
    "vector_topk_filtered",
    f"""
    SELECT vec_id, round((list_cosine_similarity(embedding::DOUBLE[], {_VECTOR_SQL}) + 1) / 2, 6) AS score
    FROM embeddings WHERE label = 1 ORDER BY (list_cosine_similarity(embedding::DOUBLE[], {_VECTOR_SQL}) + 1) / 2 DESC, vec_id LIMIT 10
    """,
)
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = F.array(*[F.lit(v) for v in _QUERY_VECTOR])
    vectors = table(spark, sf_dir, "embeddings").filter("label = 1")
    return search.vector_top_k(vectors, query, 10, "vec_id", "embedding").select("vec_id", F.round("score", 6).alias("score"))


@register(
    "vector_exact_l2_topk",
    f"""
    SELECT vec_id, round(list_distance(embedding::DOUBLE[], {_VECTOR_SQL}), 6) AS distance
    FROM embeddings ORDER BY list_distance(embedding::DOUBLE[], {_VECTOR_SQL}), vec_id LIMIT 3
    """,
)
def vector_exact_l2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = F.array(*[F.lit(v) for v in _QUERY_VECTOR])
    gaps = F.zip_with("embedding", query, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    scored = table(spark, sf_dir, "embeddings").withColumn("d", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)))
    return scored.orderBy("d", "vec_id").limit(3).select("vec_id", F.round("d", 6).alias("distance"))


_REF = 1
_RELATED_SQL = """
    WITH p AS (SELECT p_partkey, p_name, p_brand, list_distinct(string_split(p_type, ' ')) AS ts, list_distinct(string_split(p_name, ' ')) AS ks FROM part),
    r AS (SELECT * FROM p WHERE p_partkey = 1),
    s AS (SELECT p.p_partkey,
      0.4 * len(list_intersect(p.ts, r.ts)) / greatest(len(p.ts), len(r.ts))
      + 0.25 * len(list_intersect(p.ks, r.ks)) / greatest(len(p.ks), len(r.ks))
      + CASE WHEN contains(lower(p.p_name), lower(r.p_name)) OR contains(lower(r.p_name), lower(p.p_name)) THEN 0.1 ELSE 0 END
      + CASE WHEN (lower(p.p_brand) SIMILAR TO '.*(mit|apache|gpl|bsd|open).*') = (lower(r.p_brand) SIMILAR TO '.*(mit|apache|gpl|bsd|open).*') THEN 0.05 ELSE 0 END AS score,
      len(list_intersect(p.ks, r.ks)) AS shared
      FROM p, r WHERE p.p_partkey <> 1)
"""


def _scored_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", F.split("p_type", " ").alias("ts"), F.split("p_name", " ").alias("ks"))
    ref = parts.filter(F.col("p_partkey") == _REF).select(*[F.col(c).alias(f"r_{c}") for c in parts.columns])
    joined = parts.filter(F.col("p_partkey") != _REF).join(F.broadcast(ref))  # the reference is one row
    score = maths.relevance(*[F.col(c) for c in ("ts", "r_ts", "ks", "r_ks", "p_name", "r_p_name", "p_brand", "r_p_brand")])
    shared = F.size(F.array_intersect(F.array_distinct("ks"), F.array_distinct("r_ks")))
    return joined.select("p_partkey", score.alias("score"), shared.alias("shared"))


@register("related_score", _RELATED_SQL + "SELECT p_partkey, round(least(score, 1.0), 6) AS score FROM s WHERE score > 0.2")
def related_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_parts(spark, sf_dir).filter("score > 0.2").select("p_partkey", F.round("score", 6).alias("score"))


@register(
    "overlap_topk",
    _RELATED_SQL + "SELECT p_partkey, shared::INTEGER AS shared, round(score, 6) AS score FROM s WHERE shared >= 1 ORDER BY shared DESC, round(score, 6) DESC, p_partkey LIMIT 10",
)
def overlap_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_parts(spark, sf_dir).filter("shared >= 1").withColumn("score", F.round("score", 6))
    return rows.orderBy(F.desc("shared"), F.desc("score"), "p_partkey").limit(10)


@register(
    "related_by_category",
    """
    WITH r AS (SELECT * FROM part WHERE p_partkey = 1),
    c AS (SELECT 'same_brand' AS category, p.p_partkey FROM part p, r WHERE p.p_brand = r.p_brand AND p.p_partkey <> 1
          UNION ALL SELECT 'same_type', p.p_partkey FROM part p, r WHERE p.p_type = r.p_type AND p.p_partkey <> 1
          UNION ALL SELECT 'same_size', p.p_partkey FROM part p, r WHERE p.p_size = r.p_size AND p.p_partkey <> 1)
    SELECT category, p_partkey, CAST(rk AS INTEGER) AS rk, total::BIGINT AS total FROM (
      SELECT *, row_number() OVER (PARTITION BY category ORDER BY p_partkey) AS rk, count(*) OVER (PARTITION BY category) AS total FROM c) WHERE rk <= 5
    """,
)
def related_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    keys = {"same_brand": "p_brand", "same_type": "p_type", "same_size": "p_size"}
    tagged = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(k).cast("string").alias("k")) for c, k in keys.items()])).alias("x")
    every = parts.select("p_partkey", tagged).select("p_partkey", "x.category", "x.k")
    ref = every.filter(F.col("p_partkey") == _REF).select("category", "k")
    found = every.filter(F.col("p_partkey") != _REF).join(F.broadcast(ref), ["category", "k"])  # three rows
    total = found.groupBy("category").agg(F.count(F.lit(1)).alias("total"))
    top = search.top_per_group(found, ["category"], [F.col("p_partkey")], 5)
    return top.join(total, "category").select("category", "p_partkey", "rk", "total")


@register(
    "query_terms_probe",
    """
    WITH q AS (SELECT part.p_partkey, string_split_regex(p_name, '[ \\-_.]') AS w, p_name FROM part)
    SELECT p_partkey, len(list_distinct(list_filter(list_concat([trim(a[i] || ' ' || a[i + 1]) FOR i IN range(1, len(a))], [trim(p_name)]), lambda x: x <> '')))::INTEGER AS n
    FROM (SELECT p_partkey, p_name, list_concat(w, string_split_regex(lower(p_name), '[ \\-_.]')) AS a FROM q)
    """,
)
def query_terms_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.size(text.query_terms(F.col("p_name"))).alias("n"))


@register(
    "last_3_messages",
    """
    SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rk FROM conversations) WHERE rk <= 3
    """,
)
def last_3_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_per_group(table(spark, sf_dir, "conversations"), ["conv_id"], [F.desc("turn")], 3).select("conv_id", "turn", "role")


@register(
    "stats_platform",
    """
    SELECT (SELECT count(*) FROM documents)::BIGINT AS documents, (SELECT count(DISTINCT source) FROM documents)::BIGINT AS sources,
           (SELECT count(DISTINCT lang) FROM documents)::BIGINT AS langs, (SELECT count(*) FROM labels)::BIGINT AS labelled
    """,
)
def stats_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("source").alias("sources"), F.countDistinct("lang").alias("langs"))
    return docs.join(F.broadcast(table(spark, sf_dir, "labels").agg(F.count(F.lit(1)).alias("labelled"))))  # one row each


@register(
    "latency_summary",
    "SELECT event_type, count(*)::BIGINT AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type",
)
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    whole = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    medians = facets.exact_medians(events, "event_type", "value").select("event_type", F.round("median", 6).alias("median"))
    return whole.join(medians, "event_type").select("event_type", "n", "mean", "median", "lo", "hi")


@register(
    "bigrams_top",
    """
    WITH t AS (SELECT conv_id, turn, string_split(lower(text), ' ') AS w FROM conversations),
    b AS (SELECT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS bigram FROM t)
    SELECT bigram, count(*)::BIGINT AS n FROM b GROUP BY bigram ORDER BY n DESC, bigram LIMIT 25
    """,
)
def bigrams_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "conversations").select(F.split(F.lower("text"), " ").alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.concat(a, F.lit(" "), b))
    return words.select(F.explode(pairs).alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "bigram").limit(25)


@register(
    "document_text_embedding_join",
    """
    SELECT label, count(*)::BIGINT AS n, round(avg(n_chars), 6) AS mean_chars FROM embeddings JOIN documents ON doc_id = vec_id GROUP BY label
    """,
)
def document_text_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, docs = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    joined = vectors.join(docs, vectors.vec_id == docs.doc_id)
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


@register(
    "task_first_facet",
    """
    WITH v AS (SELECT DISTINCT lower(lang) AS value, 'lang' AS facet, 1 AS rank FROM documents UNION SELECT DISTINCT lower(source), 'source', 2 FROM documents),
    t AS (SELECT unnest(['src1', 'en', 'nothing', 'fr']) AS token)
    SELECT token, min_by(facet, rank) AS facet FROM t JOIN v ON token = value GROUP BY token
    """,
)
def task_first_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pairs = F.explode(F.array(*[F.struct(F.lower(c).alias("value"), F.lit(c).alias("facet"), F.lit(i).alias("rank")) for i, c in enumerate(("lang", "source"))])).alias("p")
    values = docs.select(pairs).select("p.*").distinct()
    tokens = spark.createDataFrame([("src1",), ("en",), ("nothing",), ("fr",)], "token string")
    return tokens.join(values, F.col("token") == F.col("value")).groupBy("token").agg(F.min_by("facet", "rank").alias("facet"))


