"""Queries over records: identity, tags, joins, deduplication, validation, text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import dates, idents, text
from quarry.operators import records
from quarry.session import table
from quarry.sources import readers, writers

GRAPH = idents.GRAPH


@register(
    "entity_hash_ids",
    f"""SELECT n_name, '{GRAPH}' || sha256('{{"id": "' || n_name || '", "platform": "HF", "type": "Model"}}') AS iri FROM nation""",
)
def entity_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_name", idents.entity_iri(F.lit("HF"), F.lit("Model"), F.col("n_name")).alias("iri"))


@register(
    "subject_minting",
    f"""
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{GRAPH}' || page_id
                         WHEN page_id % 3 = 1 AND regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#\\s]+/\\S*$') THEN url
                         ELSE '{GRAPH}' || sha256(url) END AS subject FROM pages
    """,
)
def subject_minting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = F.col("page_id") % 3
    ids = F.when(kind == 0, F.array(F.lit("x"), F.concat(F.lit(GRAPH), F.col("page_id").cast("string")))).when(kind == 1, F.array("url")).otherwise(F.array(F.lit("x")))
    return pages.select("page_id", idents.mint_subject(ids, F.col("url"), F.lit("{}")).alias("subject"))


@register(
    "uri_parse",
    """
    SELECT page_id, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#\\s]+/\\S*$') AS is_iri,
           regexp_matches(trim(url), '^(?i)https?://[^/?#\\s]+') AS is_http,
           reverse(string_split(reverse(url), '/')[1]) AS tail FROM pages
    """,
)
def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", idents.is_iri(url).alias("is_iri"), idents.is_http_url(url).alias("is_http"), text.short_name(url).alias("tail"))


@register(
    "tag_identify",
    """
    WITH t AS (SELECT p_partkey, ['dataset:' || lower(p_brand), 'license:' || string_split(p_type, ' ')[1], 'x', 'dataset:' || lower(p_brand)] AS tags FROM part)
    SELECT p_partkey, array_to_string(list_distinct([replace(x, 'dataset:', '') FOR x IN tags IF starts_with(x, 'dataset:')]), ',') AS datasets,
           array_to_string([replace(x, 'license:', '') FOR x IN tags IF starts_with(x, 'license:')], ',') AS licences FROM t
    """,
)
def tag_identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.concat(F.lit("dataset:"), F.lower("p_brand"))
    tags = F.array(own, F.concat(F.lit("license:"), F.get(F.split("p_type", " "), 0)), F.lit("x"), own)
    rows = table(spark, sf_dir, "part").select("p_partkey", tags.alias("tags"))
    return rows.select(
        "p_partkey",
        F.array_join(text.tag_values(F.col("tags"), "dataset:"), ",").alias("datasets"),
        F.array_join(text.tag_values(F.col("tags"), "license:"), ",").alias("licences"),
    )


@register(
    "entity_links_long",
    """
    WITH t AS (SELECT doc_id, lang, source FROM documents)
    SELECT kind, value, count(*)::BIGINT AS n FROM (
      SELECT 'language' AS kind, lang AS value FROM t UNION ALL SELECT 'publisher', source FROM t UNION ALL SELECT 'keyword', lang || '-' || source FROM t)
    GROUP BY kind, value
    """,
)
def entity_links_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators import identify

    docs = table(spark, sf_dir, "documents")
    found = identify.identify(
        docs, "doc_id",
        {"language": F.array("lang"), "publisher": F.array("source"), "keyword": F.array(F.concat_ws("-", "lang", "source"))},
    )
    return found.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


@register(
    "size_label",
    """
    SELECT p_partkey, nullif(upper(regexp_extract(nm, '(\\d+(\\.\\d+)?[BM])', 1, 'i')), '') AS label,
           nullif(regexp_extract(nm, '\\b(\\d+(\\.\\d+)?[BM])\\b', 1, 'i'), '') AS token
    FROM (SELECT p_partkey, 'net-' || p_size || CASE WHEN p_partkey % 2 = 0 THEN 'b-chat' WHEN p_partkey % 3 = 0 THEN '.5mx' ELSE 'k' END AS nm FROM part)
    """,
)
def size_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.concat(F.lit("org/net-"), F.col("p_size").cast("string"), F.when(key % 2 == 0, "b-chat").when(key % 3 == 0, ".5mx").otherwise("k"))
    return table(spark, sf_dir, "part").select("p_partkey", text.size_label(name).alias("label"), text.size_token(name).alias("token"))


def _order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    factor = F.when(key % 4 == 0, 1).when(key % 4 == 1, 1000).when(key % 4 == 2, 1_000_000).otherwise(100_000_000).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.round("o_totalprice").cast("long") * factor).alias("v"))


_COUNT_LABELS = """
    WITH c AS (SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 100000000 END AS v FROM orders),
    f AS (SELECT o_orderkey, v, CASE WHEN v >= 1000000000000 THEN 12 WHEN v >= 1000000000 THEN 9 WHEN v >= 1000000 THEN 6 WHEN v >= 1000 THEN 3 ELSE 0 END AS p FROM c),
    h AS (SELECT *, CASE WHEN p > 0 THEN (v + 5 * (10::BIGINT ** (p - 3))::BIGINT) // (10::BIGINT ** (p - 2))::BIGINT END AS hundredths FROM f)
    SELECT o_orderkey, CASE p WHEN 0 THEN v::VARCHAR ELSE rtrim(rtrim((hundredths // 100)::VARCHAR || '.' || lpad((hundredths % 100)::VARCHAR, 2, '0'), '0'), '.')
      || CASE p WHEN 3 THEN 'K' WHEN 6 THEN 'M' WHEN 9 THEN 'B' ELSE 'T' END END AS label FROM h
"""


@register("parameter_count_format", _COUNT_LABELS)
def parameter_count_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, half-way cases included; the SQL rounds in whole numbers."""
    return _order_counts(spark, sf_dir).select("o_orderkey", text.format_count(F.col("v")).alias("label"))


_SCALED = """
    SELECT c_custkey, CAST(round(abs(round(c_acctbal, 1)) * CASE c_custkey % 4 WHEN 0 THEN 1e3 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1 END) AS BIGINT) AS n FROM customer
    """


@register("scaled_numbers", _SCALED)
def scaled_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, zero balances included."""
    return _scaled(table(spark, sf_dir, "customer"))


def _scaled(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    unit = F.when(key % 4 == 0, "K").when(key % 4 == 1, "m").when(key % 4 == 2, "B").otherwise("")
    said = F.concat(F.format_string("%.1f", F.abs(F.round("c_acctbal", 1))), unit)
    return customers.select("c_custkey", text.scaled_number(said).alias("n"))


_ARXIV = """
    WITH t AS (SELECT page_id, 'see ' || (1000 + page_id % 9000) || '.' || (10000 + page_id) || 'v2 and https://arxiv.org/abs/' || (2000 + page_id % 90) || '.1234 or 12.345' AS body FROM pages)
    SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(body, '\\b(\\d{4}\\.\\d{4,5})(v\\d+)?\\b', 1))), ',') AS ids FROM t
    """


@register("arxiv_like_extract", _ARXIV)
def arxiv_like_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, those whose two numbers begin alike included."""
    return _arxiv(table(spark, sf_dir, "pages"))


def _arxiv(pages: DataFrame) -> DataFrame:
    key = F.col("page_id")
    body = F.format_string("see %d.%dv2 and https://arxiv.org/abs/%d.1234 or 12.345", 1000 + key % 9000, 10000 + key, 2000 + key % 90)
    ids = F.array_sort(text.arxiv_ids(body))
    return pages.select("page_id", F.array_join(ids, ",").alias("ids"))


@register(
    "doi_collect",
    """
    SELECT page_id, 'https://doi.org/10.' || (1000 + page_id % 5000) || '/abc.' || page_id AS uri FROM pages
    """,
)
def doi_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id")
    body = F.format_string("As in DOI 10.%d/ABC.%d. And (10.%d/abc.%d).", 1000 + key % 5000, key, 1000 + key % 5000, key)
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.dois(body)).alias("d")).select("page_id", text.doi_uri(F.col("d")).alias("uri"))


@register(
    "json_first_hit",
    "SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), '') AS value FROM events",
)
def json_first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.coalesce(F.get_json_object("props", "$.missing"), F.get_json_object("props", "$.k"), F.lit(""))
    return table(spark, sf_dir, "events").select("event_id", hit.alias("value"))


@register("props_flatten", "SELECT k, count(*)::BIGINT AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k")
def props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.explode(F.json_object_keys("props")).alias("k")
    return table(spark, sf_dir, "events").select(keys).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@register(
    "dedup_keep_first",
    "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1",
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.keep_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@register(
    "dedup_keep_last",
    "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
)
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.keep_last(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@register(
    "translation_join",
    "SELECT c_custkey, coalesce(n_name, c_nationkey::VARCHAR) AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def translation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return records.lookup(table(spark, sf_dir, "customer"), "c_nationkey", nations, "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@register(
    "translation_join_all",
    """
    WITH c AS (SELECT c_custkey, c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS k FROM customer)
    SELECT c_custkey, coalesce(n_name, k::VARCHAR) AS nation FROM c LEFT JOIN nation ON k = n_nationkey
    """,
)
def translation_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations; every fifth customer has a key that no nation has."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + F.when(F.col("c_custkey") % 5 == 0, 100).otherwise(0)).alias("k"))
    return records.lookup(customers, "k", table(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@register(
    "translation_array",
    """
    WITH m AS (SELECT s_suppkey, [s_nationkey, (s_nationkey + 1) % 25] AS ks FROM supplier),
    x AS (SELECT s_suppkey, unnest(ks) AS k, generate_subscripts(ks, 1) AS i FROM m)
    SELECT s_suppkey, string_agg(coalesce(n_name, k::VARCHAR), ',' ORDER BY i) AS names
    FROM x LEFT JOIN nation ON k = n_nationkey GROUP BY s_suppkey
    """,
)
def translation_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.array("s_nationkey", (F.col("s_nationkey") + 1) % 25).alias("names"))
    return records.lookup_array(rows, "s_suppkey", "names", nations, "n_nationkey", "n_name").select("s_suppkey", F.array_join("names", ",").alias("names"))


@register(
    "translation_array_all",
    """
    WITH m AS (SELECT s_suppkey, [s_nationkey + CASE WHEN s_suppkey % 5 = 0 THEN 100 ELSE 0 END, (s_nationkey + 1) % 25] AS ks FROM supplier),
    x AS (SELECT s_suppkey, unnest(ks) AS k, generate_subscripts(ks, 1) AS i FROM m)
    SELECT s_suppkey, string_agg(coalesce(n_name, k::VARCHAR), ',' ORDER BY i) AS names FROM x LEFT JOIN nation ON k = n_nationkey GROUP BY s_suppkey
    """,
)
def translation_array_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations; every fifth supplier has a key that no nation has."""
    own = F.col("s_nationkey") + F.when(F.col("s_suppkey") % 5 == 0, 100).otherwise(0)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.array(own, (F.col("s_nationkey") + 1) % 25).alias("names"))
    named = records.lookup_array(rows, "s_suppkey", "names", table(spark, sf_dir, "nation"), "n_nationkey", "n_name")
    return named.select("s_suppkey", F.array_join("names", ",").alias("names"))


@register(
    "stub_left_join",
    """
    WITH a AS (SELECT l_orderkey, count(*)::BIGINT AS lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT o_orderkey, lines, lines IS NOT NULL AS enriched, CASE WHEN lines IS NOT NULL THEN 'found' ELSE 'not_found' END AS source
    FROM (SELECT DISTINCT o_orderkey FROM orders) LEFT JOIN a ON o_orderkey = l_orderkey
    """,
)
def stub_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"))
    return records.left_with_stub(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey")


@register(
    "lookup_priority",
    """
    SELECT doc_id, coalesce(a.n_name, b.r_name, 'none') AS name FROM documents d
    LEFT JOIN nation a ON d.doc_id = a.n_nationkey LEFT JOIN region b ON d.doc_id = b.r_regionkey
    """,
)
def lookup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return records.first_hit(docs, "doc_id", [(nations, "k"), (regions, "k")], "name").select("doc_id", F.coalesce("name", F.lit("none")).alias("name"))


@register(
    "keyword_anti",
    "SELECT p_partkey, p_brand FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)",
)
def keyword_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return records.without(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), used, ["p_partkey"])


@register(
    "keyword_filter",
    """
    WITH t AS (SELECT p_partkey, unnest(['license:mit', lower(p_brand), p_name || ' one two three four', p_type, 'dataset:x', ' ']) AS tag FROM part)
    SELECT DISTINCT p_partkey, trim(tag) AS keyword FROM t
    WHERE trim(tag) <> '' AND tag NOT LIKE 'license:%' AND tag NOT LIKE 'dataset:%' AND len(string_split(tag, ' ')) <= 4
    """,
)
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array(F.lit("license:mit"), F.lower("p_brand"), F.concat("p_name", F.lit(" one two three four")), F.col("p_type"), F.lit("dataset:x"), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(text.keyword_tags(tags)).alias("keyword"))


@register(
    "full_outer_maps",
    """
    WITH c AS (SELECT c_nationkey AS k, count(*)::BIGINT AS customers FROM customer GROUP BY 1),
    s AS (SELECT s_nationkey AS k, count(*)::BIGINT AS suppliers FROM supplier GROUP BY 1)
    SELECT coalesce(c.k, s.k) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM c FULL JOIN s ON c.k = s.k
    """,
)
def full_outer_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    return c.join(s, "nation", "full_outer").fillna(0, ["customers", "suppliers"])


@register(
    "full_outer_maps_all",
    """
    WITH c AS (SELECT c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS k, count(*)::BIGINT AS customers FROM customer GROUP BY 1),
    s AS (SELECT s_nationkey + CASE WHEN s_suppkey % 5 = 0 THEN 200 ELSE 0 END AS k, count(*)::BIGINT AS suppliers FROM supplier GROUP BY 1)
    SELECT coalesce(c.k, s.k) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM c FULL JOIN s ON c.k = s.k
    """,
)
def full_outer_maps_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers and suppliers; every fifth of them has a key that the other side lacks."""
    far = lambda key, own, by: (F.col(key) + F.when(F.col(own) % 5 == 0, by).otherwise(0)).alias("nation")
    c = table(spark, sf_dir, "customer").groupBy(far("c_nationkey", "c_custkey", 100)).agg(F.count(F.lit(1)).alias("customers"))
    s = table(spark, sf_dir, "supplier").groupBy(far("s_nationkey", "s_suppkey", 200)).agg(F.count(F.lit(1)).alias("suppliers"))
    return c.join(s, "nation", "full_outer").fillna(0, ["customers", "suppliers"])


@register(
    "validate_split",
    """
    WITH v AS (SELECT CASE WHEN NOT (l_discount BETWEEN 0 AND 0.08) THEN 'discount' END AS a, CASE WHEN NOT (l_quantity >= 5) THEN 'quantity' END AS b FROM lineitem)
    SELECT coalesce(nullif(concat_ws(',', a, b), ''), 'valid') AS outcome, count(*)::BIGINT AS n FROM v GROUP BY 1
    """,
)
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_discount", "l_quantity")
    valid, wrong = records.split_valid(lines, {"discount": F.col("l_discount").between(0, 0.08), "quantity": F.col("l_quantity") >= 5})
    good = valid.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("outcome"), "n").filter("n > 0")
    return good.unionByName(wrong.groupBy(F.array_join("errors", ",").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


@register("union_tables", "SELECT kind, count(*)::BIGINT AS n, count(name)::BIGINT AS named FROM (SELECT 'c' AS kind, c_name AS name FROM customer UNION ALL SELECT 's', s_name FROM supplier UNION ALL SELECT 'r', NULL FROM region) GROUP BY kind")
def union_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.lit("c").alias("kind"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_name").alias("name"))
    r = table(spark, sf_dir, "region").select(F.lit("r").alias("kind"))
    return readers.union_tables([c, s, r]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("name").alias("named"))


@register(
    "upsert_rows",
    "SELECT c_nationkey AS k, count(*)::BIGINT AS n, sum(CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END)::BIGINT AS renewed FROM customer GROUP BY 1",
)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.lit(0).alias("version"))
    new = old.filter("c_custkey % 10 = 0").withColumn("version", F.lit(1))
    merged = writers.upsert(old, new, ["c_custkey"])
    return merged.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("version").alias("renewed"))


@register(
    "llm_overlay",
    """
    SELECT doc_id, CASE WHEN q THEN upper(source) ELSE lang END AS description,
           CASE WHEN q AND upper(source) <> lang THEN lang END AS abstract FROM (SELECT *, doc_id % 2 = 0 AS q FROM documents)
    """,
)
def llm_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators import identify

    said = F.when(F.col("doc_id") % 2 == 0, F.upper("source")).otherwise(F.lit(" na "))
    out = identify.overlay_description(F.col("lang"), F.lit(None).cast("string"), said)
    return table(spark, sf_dir, "documents").select("doc_id", out["description"].alias("description"), out["abstract"].alias("abstract"))


@register(
    "lang_max_conf",
    "SELECT source, max(quality)::INTEGER AS best, bool_or(toxic = 1) AS any_toxic FROM labels JOIN documents USING (doc_id) GROUP BY source",
)
def lang_max_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return joined.groupBy("source").agg(F.max("quality").alias("best"), F.bool_or(F.col("toxic") == 1).alias("any_toxic"))


@register(
    "xsd_dates",
    """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00'
                                           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS xsd FROM orders
    """,
)
def xsd_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey") % 3
    said = F.when(key == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(key == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("invalid")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.xsd_datetime(said).alias("xsd"))


@register("epoch_dates", "SELECT event_id, strftime(make_timestamp(event_id * 86400 * 1000000), '%Y-%m-%d') AS day FROM events")
def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.epoch_date(F.col("event_id") * 86400).alias("day"))


@register(
    "front_matter_strip",
    "SELECT doc_id, sha256(trim(text)) AS body FROM documents",
)
def front_matter_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = F.concat(F.lit("---\nlicense: mit\n---\n"), F.trim("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.strip_front_matter(card), 256).alias("body"))


@register("html_links", "SELECT page_id, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))::INTEGER AS links FROM pages")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('href="([^"]*)"'), 1)
    return table(spark, sf_dir, "pages").select("page_id", F.size(links).alias("links"))


@register(
    "searchable_text",
    "SELECT p_partkey, 'Name: ' || p_name || '. Brand: ' || p_brand || '. Type: ' || p_type || '.' AS said FROM part",
)
def searchable_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("Name", F.col("p_name")), ("Missing", F.lit("NA")), ("Brand", F.col("p_brand")), ("Blank", F.lit(" ")), ("Type", F.col("p_type"))]
    return table(spark, sf_dir, "part").select("p_partkey", text.searchable_text(parts).alias("said"))


@register(
    "bibtex_parse",
    """
    SELECT c_custkey, 'On ' || c_name AS title, 'A. Smith|Example Institute' AS authors, 'Person|Organization' AS kinds, (1990 + c_custkey % 30)::VARCHAR || '-01-01' AS published FROM customer
    """,
)
def bibtex_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.concat(
        F.lit("@article{k,\n title = {{On "), F.col("c_name"), F.lit("}},\n author = {A. Smith and Example Institute},\n year = "),
        (1990 + F.col("c_custkey") % 30).cast("string"), F.lit("\n}"),
    )
    names = text.bibtex_authors(text.bibtex_field(entry, "author"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.bibtex_field(entry, "title").alias("title"), F.array_join(names, "|").alias("authors"),
        F.array_join(F.transform(names, text.author_kind), "|").alias("kinds"), text.year_date(text.bibtex_field(entry, "year")).alias("published"),
    )


@register("llm_json_extract", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def llm_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit('Sure!\n```json\n{"segment": "'), F.col("c_mktsegment"), F.lit('"}\n```\nDone.'))
    return table(spark, sf_dir, "customer").select("c_custkey", F.get_json_object(text.json_block(said), "$.segment").alias("segment"))


@register("task_tokens", "SELECT DISTINCT regexp_replace(translate(lower(trim(p_type)), ' _', '--'), '-{2,}', '-', 'g') AS token FROM part")
def task_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(text.task_token(F.col("p_type")).alias("token")).distinct()
