"""Text and vector search over documents, and related records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.maths import search_score


def terms_of(query: str) -> list[str]:
    """Words of a query, and neighbouring pairs, in lower case, each once."""
    import re

    words = [w for w in re.split(r"[ \-_.]", query.lower()) if w]
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]))


def text_score(query: str, fields: dict[str, float]) -> Column:
    """Sum over terms and fields of the field's boost where it contains the term.

    The set of matches is the boolean part of a multi-field query; the score ranks by boosted term hits, which
    approximates an index's relevance without its corpus statistics.
    """
    parts = [
        F.when(F.contains(F.lower(F.coalesce(F.col(f).cast("string"), F.lit(""))), F.lit(t)), F.lit(float(b))).otherwise(F.lit(0.0))
        for t in terms_of(query)
        for f, b in fields.items()
    ]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def text_search(df: DataFrame, query: str, fields: dict[str, float], id_col: str, number: int = 1, size: int = 20) -> DataFrame:
    """A page of the rows that match any term, best first, ties by id."""
    scored = df.withColumn("score", text_score(query, fields)).filter("score > 0")
    return scored.orderBy(F.desc("score"), id_col).offset((number - 1) * size).limit(size)


def fuzzy_distance(term: str) -> int:
    """Edits that a fuzzy match allows for a term of that length."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def fuzzy_match(words: Column, term: str) -> Column:
    """True if a word of the array is within the term's edits."""
    most = fuzzy_distance(term)
    return F.exists(words, lambda w: F.levenshtein(F.lower(w), F.lit(term.lower())) <= most)


def vector_top_k(vectors: DataFrame, query: Column, k: int, id_col: str, vector_col: str, drop: Column | None = None) -> DataFrame:
    """The k rows nearest to a query vector by cosine, from 0 to 1, ties by id; rows without a vector are left out.

    The query is a literal, so scoring is row-local and the top k need no full sort.
    """
    rows = vectors.filter(F.col(vector_col).isNotNull())
    if drop is not None:
        rows = rows.filter(~drop)
    scored = rows.withColumn("score", search_score(F.col(vector_col), query)).filter(F.col("score").isNotNull())
    return scored.orderBy(F.desc("score"), id_col).limit(k)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rk", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rk") <= k)
