"""Queries over the relevance index, with the same formulas in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.operators import relevance
from quarry.session import scratch, table

_INDEXES: dict[tuple[str, str, str], relevance.Index] = {}
_FIELDS = {
    "part": ("p_partkey", {"name": "p_name", "keywords": "p_type", "sharedBy": "p_brand"}),
    "documents": ("doc_id", {"description": "text", "sharedBy": "source", "mlTask": "lang"}),
}


def _index(spark: SparkSession, sf_dir: str, name: str) -> relevance.Index:
    """The index of a table, written once in a session and read by all queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _INDEXES:
        id_col, fields = _FIELDS[name]
        own = {f: F.col(c).cast("string") for f, c in fields.items()}
        _INDEXES[key] = relevance.build(table(spark, sf_dir, name), id_col, own, scratch(spark, f"index-{name}"))
    return _INDEXES[key]


def _index_sql(name: str) -> str:
    """Tables p (term, field, doc, tf, len), n (field, n_docs, avg_len) and w (term, field, df) of a table's words."""
    id_col, fields = _FIELDS[name]
    each = " UNION ALL ".join(f"SELECT {id_col} AS doc, '{f}' AS field, regexp_extract_all(lower(coalesce({c}, '')), '[\\p{{L}}\\p{{N}}]+') AS words FROM {name}" for f, c in fields.items())
    return f"""t AS ({each}),
    p AS (SELECT term, field, doc, count(*) AS tf, any_value(len(words)) AS len FROM (SELECT doc, field, words, unnest(words) AS term FROM t) GROUP BY ALL),
    n AS (SELECT field, count(*) AS n_docs, avg(len(words)) AS avg_len FROM t WHERE len(words) > 0 GROUP BY field),
    w AS (SELECT term, field, count(*) AS df FROM p GROUP BY ALL)"""


_IDF = "ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"
_PART = "tf / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))"


def _scores_sql(name: str, phrases: list[str], cross: dict[str, float], best: dict[str, float], weight: float) -> str:
    """SQL for the scores of phrases: table s (doc, score)."""
    asked = ", ".join(f"({i}, {j}, '{t}')" for i, p in enumerate(phrases) for j, t in enumerate(relevance.query_words(p)))
    boosts = lambda own: ", ".join(f"('{f}', {b})" for f, b in own.items()) or "(NULL, 0.0)"
    return f"""WITH {_index_sql(name)},
    q(phrase, place, term) AS (VALUES {asked}), cross_b(field, boost) AS (VALUES {boosts(cross)}), best_b(field, boost) AS (VALUES {boosts(best)}),
    m AS (SELECT term, max(df) AS df_all, max(n_docs) AS n_all FROM w JOIN n USING (field) WHERE field IN ({", ".join(f"'{f}'" for f in {**cross, **best})}) GROUP BY term),
    v AS (SELECT phrase, place, doc, field, {_IDF.format(n="greatest(n_all, df_all)", df="df_all")} * {_PART} AS c, {_IDF.format(n="n_docs", df="df")} * {_PART} AS b
          FROM q JOIN p USING (term) JOIN w USING (term, field) JOIN n USING (field) JOIN m USING (term)),
    x AS (SELECT doc, sum(c) AS score FROM (SELECT doc, phrase, place, max(c * boost) AS c FROM v JOIN cross_b USING (field) GROUP BY ALL) GROUP BY doc),
    y AS (SELECT doc, {weight} * sum(b) AS score FROM (SELECT doc, phrase, max(b) AS b FROM (SELECT doc, phrase, field, sum(b * boost) AS b FROM v JOIN best_b USING (field) GROUP BY ALL) GROUP BY ALL) GROUP BY doc),
    s AS (SELECT * FROM x UNION ALL SELECT * FROM y)"""


_MODEL_QUERY = "red_Widget ECONOMY"
_CROSS, _BEST = {"name": 2.0, "keywords": 5.0, "sharedBy": 1.0}, {"name": 2.0, "keywords": 4.0, "sharedBy": 1.0}
_PHRASES = relevance.phrases_of(_MODEL_QUERY)
_PARTIAL = " + ".join(f"CASE WHEN contains(coalesce(p_type, ''), '{p}') THEN 1.0 ELSE 0.0 END" for p in _PHRASES if len(p) >= 2)


@register(
    "relevance_models",
    f"""{_scores_sql("part", _PHRASES, _CROSS, _BEST, 0.8)},
    z AS (SELECT * FROM s UNION ALL SELECT p_partkey, {_PARTIAL} FROM part WHERE ({_PARTIAL}) > 0)
    SELECT doc AS p_partkey, round(sum(score), 6) AS score FROM z GROUP BY doc""",
)
def relevance_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every matching row: blended fields, best fields and partial values."""
    scored = relevance.scores(_index(spark, sf_dir, "part"), _PHRASES, _CROSS, _BEST).unionByName(relevance.partial(table(spark, sf_dir, "part"), "p_partkey", ["p_type"], _PHRASES))
    return scored.groupBy(F.col("doc").alias("p_partkey")).agg(F.round(F.sum("score"), relevance.DIGITS).alias("score"))


_WORDS, _SIMPLE = "the license src1 with care", {"description": 1.0, "sharedBy": 1.0, "mlTask": 1.0}


@register("relevance_documents", f"""{_scores_sql("documents", [_WORDS], {}, _SIMPLE, 1.0)} SELECT doc AS doc_id, round(sum(score), 6) AS score FROM s GROUP BY doc""")
def relevance_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document with any of the words, in its best field."""
    scored = relevance.scores(_index(spark, sf_dir, "documents"), [_WORDS], {}, _SIMPLE, 1.0)
    return scored.select(F.col("doc").alias("doc_id"), F.round("score", relevance.DIGITS).alias("score"))


@register("relevance_page", f"""{_scores_sql("documents", [_WORDS], {}, _SIMPLE, 1.0)} SELECT doc, round(sum(score), 6) AS score FROM s GROUP BY doc ORDER BY score DESC, doc LIMIT 20 OFFSET 20""")
def relevance_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of the best documents."""
    return relevance.top([relevance.scores(_index(spark, sf_dir, "documents"), [_WORDS], {}, _SIMPLE, 1.0)], 20, 2)


@register("index_sizes", f"""WITH {_index_sql("documents")} SELECT field, n_docs, round(avg_len, 6) AS avg_len, n_terms, n_postings FROM n JOIN (SELECT field, count(*) AS n_terms, sum(df)::BIGINT AS n_postings FROM w GROUP BY field) USING (field)""")
def index_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index of the documents holds for each field."""
    index = _index(spark, sf_dir, "documents")
    held = index.terms.groupBy("field").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("df").alias("n_postings"))
    return index.fields.join(held, "field").select("field", "n_docs", F.round("avg_len", relevance.DIGITS).alias("avg_len"), "n_terms", "n_postings")


_FUZZY, _FUZZY_BOOSTS = "wigdet smal Brnd", {"name": 3.0, "keywords": 2.0, "sharedBy": 1.0}
_ALLOWED = "CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END"


@register(
    "fuzzy_relevance",
    f"""WITH {_index_sql("part")}, q AS (SELECT unnest({relevance.query_words(_FUZZY)}) AS word),
    boosts(field, boost) AS (VALUES {", ".join(f"('{f}', {b})" for f, b in _FUZZY_BOOSTS.items())}),
    near AS (SELECT word, term, levenshtein(word, term) AS d FROM q, (SELECT DISTINCT term FROM w) WHERE levenshtein(word, term) <= {_ALLOWED}),
    v AS (SELECT doc, field, word, max({_IDF.format(n="n_docs", df="df")} * {_PART} * (1 - d / least(length(word), length(term)))) AS b
          FROM near JOIN w USING (term) JOIN n USING (field) JOIN p USING (term, field) GROUP BY ALL)
    SELECT doc AS p_partkey, round(max(b), 6) AS score FROM (SELECT doc, field, sum(b * boost) AS b FROM v JOIN boosts USING (field) GROUP BY ALL) GROUP BY doc""",
)
def fuzzy_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every row with words within a few edits of the query's."""
    scored = relevance.fuzzy_scores(_index(spark, sf_dir, "part"), _FUZZY, _FUZZY_BOOSTS)
    return scored.select(F.col("doc").alias("p_partkey"), F.round("score", relevance.DIGITS).alias("score"))


#: DuckDB counts edits of bytes: in its copy each accented letter of the four languages is one unused capital.
_ONE_BYTE = "translate({}, 'àâäáçéèêëíìîïñóòôöúùûüß', 'ABCDEFGHIJKLMNOPQRSTUVWX')"
_DISTANCE = f"levenshtein({_ONE_BYTE.format('word')}, {_ONE_BYTE.format('term')})"


@register(
    "fuzzy_vocabulary",
    f"""WITH {_index_sql("documents")}, q AS (SELECT DISTINCT lower(word) AS word FROM (SELECT unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) AS word FROM benchmark WHERE item_id % 20 = 0)),
    u AS (SELECT DISTINCT term FROM w)
    SELECT word, term, {_DISTANCE}::INTEGER AS distance FROM q JOIN u ON abs(length(word) - length(term)) <= 2 AND {_DISTANCE} <= {_ALLOWED}""",
)
def fuzzy_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every twentieth benchmark item (the queries) with all terms of the documents within their edits."""
    asked = table(spark, sf_dir, "benchmark").filter("item_id % 20 = 0").select(F.explode(relevance.words_of(F.col("text"))).alias("word"))
    return relevance.fuzzy_terms(asked, _index(spark, sf_dir, "documents"))
