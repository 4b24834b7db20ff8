"""Language detection over the given tables, with the model in SQL too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.operators import languages
from quarry.session import cut_lineage, table

_COUNTS = r"""t AS (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents WHERE lang IS NOT NULL),
    u AS (SELECT lang, ' ' || word || ' ' AS word, count(*) AS n FROM t GROUP BY 1, 2),
    c AS (SELECT lang, substr(word, i::BIGINT, 3) AS gram, sum(n)::BIGINT AS n FROM (SELECT *, unnest(range(1, length(word) - 1)) AS i FROM u) GROUP BY 1, 2)"""
_MODEL = f"""{_COUNTS},
    v AS (SELECT count(DISTINCT gram) + 1 AS size FROM c),
    l AS (SELECT lang, sum(n) + 0.5 * any_value(size) AS below FROM c, v GROUP BY lang),
    m AS (SELECT lang, gram, ln((coalesce(n, 0) + 0.5) / below) AS p FROM (SELECT DISTINCT gram FROM c) CROSS JOIN l LEFT JOIN c USING (lang, gram))"""


def _shares(texts: str, key: str) -> str:
    """SQL for the confidences of the texts of a table (key, text): table s (key, code, confidence)."""
    return f"""WITH {_MODEL},
    w AS (SELECT {key}, ' ' || word || ' ' AS word FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM {texts})),
    g AS (SELECT {key}, substr(word, i::BIGINT, 3) AS gram, count(*) AS k FROM (SELECT *, unnest(range(1, length(word) - 1)) AS i FROM w) GROUP BY ALL),
    x AS (SELECT {key}, lang, sum(k * coalesce(p, ln(0.5 / below))) AS score FROM g CROSS JOIN l LEFT JOIN m USING (lang, gram) GROUP BY ALL),
    y AS (SELECT *, exp(score - max(score) OVER (PARTITION BY {key})) AS e FROM x),
    s AS (SELECT {key}, lang AS code, e / sum(e) OVER (PARTITION BY {key}) AS confidence FROM y)"""


def _model(spark: SparkSession, sf_dir: str):
    words = cut_lineage(languages.word_counts(table(spark, sf_dir, "documents"), F.col("text"), F.col("lang")))
    return languages.likelihoods(languages.gram_counts(words), words)


@register("language_ngrams", f"WITH {_COUNTS} SELECT lang, gram, n FROM c")
def language_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model is learned from: n-grams of all documents by language."""
    return languages.learn(table(spark, sf_dir, "documents"), F.col("text"), F.col("lang"))


@register(
    "language_predictions",
    f"""{_shares("documents", "doc_id")},
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, code) AS rank FROM s WHERE confidence >= 0.75)
    SELECT doc_id, rank::INTEGER AS rank, code, round(confidence, 6) AS confidence FROM r WHERE rank <= 5""",
)
def language_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sure languages of every document."""
    found = languages.predictions(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), _model(spark, sf_dir))
    return found.withColumn("confidence", F.round("confidence", 6))


@register(
    "conversation_languages",
    f"""{_shares("(SELECT conv_id || '-' || turn AS id, text FROM conversations)", "id")},
    r AS (SELECT split_part(id, '-', 1)::BIGINT AS conv_id, code, confidence FROM s WHERE confidence >= 0.75)
    SELECT conv_id, code, round(max(confidence), 6) AS confidence FROM r GROUP BY 1, 2""",
)
def conversation_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of every conversation: those of its turns, each with its greatest confidence."""
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.struct("conv_id", "turn"))
    found = languages.predictions(turns, "id", F.col("text"), _model(spark, sf_dir)).withColumn("conv_id", F.col("id.conv_id"))
    return languages.sure_languages(found, "conv_id").withColumn("confidence", F.round("confidence", 6))
