"""Queries over headed links, wildcard postings, Turtle files, tables filled in place and counts rounded by their bits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.functions import maths, text
from quarry.operators import facetmap, headings, triples, turtle, wildcards
from quarry.plans.record_queries import _order_counts
from quarry.plans.relevance_queries import _index
from quarry.session import scratch, table
from quarry.sources import backfill

# pages have links, but no second headings: every link whose name holds a t becomes a heading with a link below it
_LINK, _HEADED = '<li><a href="/([^"]*t[^"]*)">', '</ul><h2 class="c">In <i>{0}</i></h2><ul><li><a rel="x" href="/{0}/">'
_LINKS_SQL = rf"""
    WITH d AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g'), '{_LINK}', '{_HEADED.format(chr(92) + "1")}', 'g') AS html FROM pages),
    e AS (SELECT page_id, unnest(l) AS tag, generate_subscripts(l, 1) AS place FROM (SELECT page_id, regexp_extract_all(html, '(?s)<h2[^>]*>.*?</h2>|<a .*?</a>') AS l FROM d)),
    h AS (SELECT page_id, place, tag, last_value(CASE WHEN starts_with(tag, '<h2') THEN trim(regexp_replace(tag, '<[^>]*>', '', 'g')) END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY place) AS category FROM e),
    k AS (SELECT page_id, category, regexp_extract(tag, '([^/"]*)/?">', 1) AS slug, row_number() OVER (PARTITION BY page_id ORDER BY place) AS position FROM h
          WHERE starts_with(tag, '<a') AND category <> '' AND regexp_matches(tag, 'href="/[^"]*[^"/]/?">') AND trim(regexp_replace(tag, '<[^>]*>', '', 'g')) <> ''),
    f AS (SELECT page_id, slug, arg_min(category, position) AS category, min(position) AS position FROM k GROUP BY ALL)
"""


def _page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", _LINK, _HEADED.format("$1")))
    return headings.headed_links(pages, "page_id", "html", "h2", "/")


@register("headed_links", _LINKS_SQL + "SELECT page_id, category, slug, position::INTEGER AS position FROM f")
def headed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of every page with the heading above them, each once in a page, where it is first seen."""
    return _page_links(spark, sf_dir).withColumnRenamed("id", "page_id")


@register("task_catalogue", _LINKS_SQL + "SELECT replace(slug, '-', ' ') AS task, arg_min(category, (page_id, position)) AS category FROM f GROUP BY slug")
def task_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slug of all pages with the category where it is first seen."""
    return headings.first_seen(_page_links(spark, sf_dir))


_PATTERNS = ["*UTM_source=f*", "http://th*.example.net/??/*", "*blog.t*page=2*", "*%*", "*#?op", "?", "*no such part*"]
_HOLD = "lower({0}) LIKE '{1}' ESCAPE '\\'"
_WILD: dict[tuple[str, str, str], wildcards.Wildcards] = {}


def _wild(spark: SparkSession, sf_dir: str, name: str, id_col: str, column: str) -> wildcards.Wildcards:
    """The index of a column, written once in a session and read by all queries."""
    key = (spark.sparkContext.applicationId, sf_dir, f"{name}.{column}")
    if key not in _WILD:
        _WILD[key] = wildcards.build(table(spark, sf_dir, name), id_col, column, scratch(spark, f"wild-{name}"))
    return _WILD[key]


@register("wildcard_search", " UNION ALL ".join(f"SELECT '{p}' AS pattern, page_id FROM pages WHERE {_HOLD.format('url', wildcards.like_of(p))}" for p in _PATTERNS))
def wildcard_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages whose address matches patterns: by postings of trigrams, short patterns by the distinct values."""
    return wildcards.search(_wild(spark, sf_dir, "pages", "page_id", "url"), _PATTERNS).withColumnRenamed("id", "page_id")


_AUTHORS = ["RC1", "srx7", "org"]
_EDITS = "CASE WHEN length(a) <= 2 THEN 0 WHEN length(a) <= 5 THEN 1 ELSE 2 END"


@register(
    "author_filter",
    f"""WITH w AS (SELECT doc_id, lower(source) AS v, unnest(regexp_extract_all(lower(coalesce(source, '')), '[\\p{{L}}\\p{{N}}]+')) AS t FROM documents),
    q AS (SELECT unnest({[a.lower() for a in _AUTHORS]}) AS a)
    SELECT DISTINCT doc_id FROM w, q WHERE contains(v, a) OR levenshtein(a, t) <= {_EDITS}""",
)
def author_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by any of several authors: a part of the name, or a word within a few edits."""
    wild = _wild(spark, sf_dir, "documents", "doc_id", "source")
    return wildcards.any_author(wild, _index(spark, sf_dir, "documents"), "sharedBy", _AUTHORS).withColumnRenamed("id", "doc_id")


_D, _S = "https://doc.example/item#", "https://schema.org/"


@register(
    "turtle_round_trip",
    f"""WITH d AS (SELECT '{_D}d' || doc_id AS s, text, lang, '{_S}' || source AS author, 'https://pages.example/' || doc_id AS url FROM documents)
    SELECT DISTINCT s, p, o, o_is_iri FROM (SELECT s, '{_S}abstract' AS p, text AS o, false AS o_is_iri FROM d UNION ALL SELECT s, '{_S}inLanguage', lang, false FROM d
      UNION ALL SELECT s, '{_S}author', author, true FROM d UNION ALL SELECT s, '{_S}url', url, true FROM d
      UNION ALL SELECT s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', '{_S}CreativeWork', true FROM d) WHERE trim(o, ' ') <> ''""",
)
def turtle_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of all documents, whole texts included, written as Turtle and parsed back."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(_D + "d"), "doc_id").alias("s"), "text", "lang", F.concat(F.lit(_S), "source").alias("author"), F.concat(F.lit("https://pages.example/"), "doc_id").alias("url")
    )
    kept = triples.to_triples(docs, "s", {"text": _S + "abstract", "lang": _S + "inLanguage", "author": _S + "author", "url": _S + "url"}, kind=_S + "CreativeWork", repeats=True)
    path = scratch(spark, "turtle")
    turtle.write_turtle(kept, path)
    return turtle.read_turtle(spark, path)


def _filled(spark: SparkSession, sf_dir: str) -> tuple[str, backfill.Filled]:
    """All documents, those in English with a vector of their own, and the others filled from the embeddings."""
    own = F.when(F.col("lang") == "en", F.array(F.lit(0.0).cast("float")))
    path = scratch(spark, "filled")
    docs = table(spark, sf_dir, "documents").withColumn("vector", own)
    backfill.create(docs, path, "doc_id", 32, {"vector_from": "string"})
    known = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), F.concat(F.lit("label "), "label").alias("vector_from"))
    return path, backfill.backfill(spark, path, known)


@register(
    "vector_backfill",
    """SELECT doc_id, lang, md5(text) AS text_md5, CASE WHEN lang = 'en' THEN 1 ELSE len(embedding) END::INTEGER AS n, CASE WHEN lang = 'en' THEN 0.0 ELSE embedding[1]::DOUBLE END AS first,
       CASE WHEN lang IS DISTINCT FROM 'en' THEN 'label ' || label END AS vector_from FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
)
def vector_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a backfill in place: rows that had a vector keep it, all other columns stay."""
    path, _ = _filled(spark, sf_dir)
    return backfill.rows_of(spark, path).select("doc_id", "lang", F.md5("text").alias("text_md5"), F.nullif(F.size("vector"), F.lit(-1)).alias("n"), F.try_element_at("vector", F.lit(1)).cast("double").alias("first"), "vector_from")


@register(
    "vector_backfill_report",
    """WITH j AS (SELECT doc_id IS NOT NULL AS held, vec_id IS NOT NULL AS met, lang IS NOT DISTINCT FROM 'en' AS has FROM documents FULL JOIN embeddings ON doc_id = vec_id)
    SELECT 'success' AS status, count(*) FILTER (held AND met AND NOT has) AS processed, count(*) FILTER (held AND NOT (met AND NOT has)) AS skipped, count(*) FILTER (NOT held) AS unknown FROM j""",
)
def vector_backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the backfill counted."""
    done = _filled(spark, sf_dir)[1]
    return spark.createDataFrame([(done.status, done.processed, done.skipped, done.unknown)], "status string, processed long, skipped long, unknown long")


# prices of 1 and more have a fraction that is a multiple of 2^-52, so that times 2^52 it is a whole number
_HALVES = """
    v AS (SELECT k, x, floor(x)::HUGEINT AS whole, ((x - floor(x)) * 4503599627370496)::HUGEINT AS bits FROM x),
    h AS (SELECT k, x, whole * 100 + (bits * 100) // 4503599627370496 AS low, ((bits * 100) % 4503599627370496) * 2 - 4503599627370496 AS side FROM v),
    r AS (SELECT k, x, (low + CASE WHEN side > 0 OR (side = 0 AND low % 2 = 1) THEN 1 ELSE 0 END) AS hundredths FROM h)
"""


@register(
    "rounded_binary",
    f"WITH x AS (SELECT o_orderkey AS k, o_totalprice / CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 10 END + 1 AS x FROM orders), {_HALVES} SELECT k AS o_orderkey, hundredths / 100 AS rounded, -hundredths / 100 AS negative FROM r",
)
def rounded_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices over 1, 8 and 10 to cents by their exact value: those over 8 hold exact ties."""
    key = F.col("o_orderkey")
    x = F.col("o_totalprice") / F.when(key % 3 == 0, 1).when(key % 3 == 1, 8).otherwise(10) + 1
    return table(spark, sf_dir, "orders").select("o_orderkey", maths.round_binary(x, 2).alias("rounded"), maths.round_binary(-x, 2).alias("negative"))


@register(
    "parameter_count_labels",
    f"""WITH c AS (SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 100000000 END AS n FROM orders),
    u AS (SELECT k, n, CASE WHEN n >= 1000000000000 THEN 12 WHEN n >= 1000000000 THEN 9 WHEN n >= 1000000 THEN 6 WHEN n >= 1000 THEN 3 ELSE 0 END AS p FROM c),
    x AS (SELECT k, n / 10.0::DOUBLE ** p AS x FROM u), {_HALVES}
    SELECT k AS o_orderkey, CASE p WHEN 0 THEN n::VARCHAR ELSE rtrim(rtrim((hundredths // 100)::VARCHAR || '.' || lpad((hundredths % 100)::VARCHAR, 2, '0'), '0'), '.')
      || CASE p WHEN 3 THEN 'K' WHEN 6 THEN 'M' WHEN 9 THEN 'B' ELSE 'T' END END AS label FROM r JOIN u USING (k)""",
)
def parameter_count_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders' counts with labels rounded by the quotient's bits."""
    return _order_counts(spark, sf_dir).select("o_orderkey", text.count_label(F.col("v")).alias("label"))


_FACETS = {"mlTask": "p_type", "sharedBy": "p_brand", "keywords": "p_name"}


@register(
    "facet_mapper",
    r"""WITH v AS (SELECT lower(value) AS phrase, arg_min(facet, (place, value)) AS facet, arg_min(value, (place, value)) AS value FROM
      (SELECT 0 AS place, 'mlTask' AS facet, p_type AS value FROM part UNION SELECT 1, 'sharedBy', replace(p_brand, '#', ' ') FROM part UNION SELECT 2, 'keywords', p_name FROM part) GROUP BY 1),
    q AS (SELECT p_partkey AS k, lower(p_type) AS a, lower(p_name) AS b, lower(replace(p_brand, '#', ' ')) AS c FROM part),
    e AS (SELECT k, unnest([a, b, c]) AS phrase FROM q)
    SELECT k AS p_partkey, string_agg(DISTINCT facet || '=' || value, '|' ORDER BY facet || '=' || value) AS found, 'find,with,bolted-on,big,widgets' AS terms FROM e JOIN v USING (phrase) GROUP BY k""",
)
def facet_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question about every part, its type, name and brand found again among the values of all parts."""
    parts = table(spark, sf_dir, "part").withColumn("p_brand", F.replace("p_brand", F.lit("#"), F.lit(" ")))
    asked = F.concat(F.lit("Find "), "p_type", F.lit(" models with bolted-on "), F.upper("p_name"), F.lit(", big "), F.lower("p_brand"), F.lit(" widgets of mltask."))
    found = facetmap.map_queries(parts.select("p_partkey", asked.alias("asked")), "p_partkey", "asked", facetmap.facet_values(parts, _FACETS))
    pairs = F.array_sort(F.transform("facet_values", lambda v: F.concat(v["facet"], F.lit("="), v["value"])))
    return found.select(F.col("id").alias("p_partkey"), F.array_join(pairs, "|").alias("found"), F.array_join("terms", ",").alias("terms"))
