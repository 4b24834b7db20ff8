"""Language detection with a character n-gram model that is learned from labelled texts.

Words (runs of letters, in lower case) are padded with a blank on both sides and cut into n-grams. The model is a table: for each
n-gram and language the logarithm of its smoothed share. A text's score for a language is the sum over its n-grams;
confidences are the scores' softmax, so they add up to one.

Learning counts distinct words per language first, so that n-grams are cut once for each distinct word. The most frequent
words, if they are given, are summed once and broadcast, so that only the rare ones are cut again in each text. Detection
joins these n-grams with the table, which Spark broadcasts if it is known to be small and shuffles otherwise, and
sums them by text: after a broadcast, a text's n-grams are summed in the task that has them, before the only shuffle.

Defined results: a text without letters, empty or null, has no predictions; n-grams that the model does not know count
as seen never; without labelled texts there are none either; rows that share an id are one text; very long texts count whole; equal confidences go by code.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

SIZE, ALPHA = 3, 0.5
#: Up to so many rows of the model are broadcast: below 20 MB with ten languages.
BROADCAST_ROWS = 100_000
MOST_LANGUAGES = 200
#: So many frequent words are summed once and broadcast, with so many values in all: some 30 MB.
FREQUENT_WORDS, FREQUENT_VALUES = 200_000, 800_000


def letters(text: Column) -> Column:
    """The words of a text: runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), 0)


def cut(rows: DataFrame, size: int = SIZE, where: Column | None = None) -> DataFrame:
    """The rows with gram in place of word, one for each of its n-grams; those that `where` is not true for stay one, without a gram.

    Only the places are exploded, so that all of it is compiled with what is around it.
    """
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    last = F.length(padded) - size + 1
    gram, others = F.substr(padded, F.col("__place"), F.lit(size)).alias("gram"), [c for c in rows.columns if c != "word"]
    if where is None:
        return rows.filter(last >= 1).select("*", F.explode(F.sequence(F.lit(1), last)).alias("__place")).select(*others, gram)
    placed = rows.filter(~where | (last >= 1)).select("*", F.explode_outer(F.when(where, F.sequence(F.lit(1), last))).alias("__place"))
    return placed.select(*others, gram)


def word_counts(texts: DataFrame, text: Column, lang: Column) -> DataFrame:
    """(lang, word, n): how often each word stands in the labelled texts; rows without a label are left out."""
    return texts.select(lang.alias("lang"), F.explode(letters(text)).alias("word")).filter("lang IS NOT NULL").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def gram_counts(words: DataFrame, size: int = SIZE) -> DataFrame:
    """(lang, gram, n): how often each n-gram stands in the counted words."""
    return cut(words.select("lang", "word", "n"), size).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(texts: DataFrame, text: Column, lang: Column, size: int = SIZE) -> DataFrame:
    """(lang, gram, n): how often each n-gram stands in the labelled texts; rows without a label are left out."""
    return gram_counts(word_counts(texts, text, lang), size)


class Model(NamedTuple):
    """The n-grams' values (gram, p0, p1, ...), each language with its value for n-grams it never had, and the frequent words'
    sums (word, w0, w1, ...) if there are any."""

    table: DataFrame
    known: list[tuple[str, float]]
    words: DataFrame | None = None
    small: bool = True  # the n-grams are broadcast


def likelihoods(counts: DataFrame, words: DataFrame | None = None, size: int = SIZE) -> Model:
    """The model as a table with a row for each n-gram and a column for each language. With counted words (as word_counts()
    gives them, of whatever texts), the most frequent ones are summed once for all texts."""
    counts = cut_lineage(counts)  # it is read for the totals, the number of n-grams and the table
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    grams = counts.select("gram").distinct().count()
    below = [r["n"] + ALPHA * (grams + 1) for r in totals]
    value = lambda i, r: F.log((F.coalesce(F.max(F.when(F.col("lang") == r["lang"], F.col("n"))), F.lit(0)) + ALPHA) / below[i])
    if not totals:
        return Model(counts.select("gram"), [])
    wide = counts.groupBy("gram").agg(*[value(i, r).alias(f"p{i}") for i, r in enumerate(totals)])
    small = grams <= BROADCAST_ROWS
    table = F.broadcast(wide) if small else wide
    known = [(r["lang"], math.log(ALPHA / below[i])) for i, r in enumerate(totals)]
    if words is None:
        return Model(table, known, None, small)
    often = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(min(FREQUENT_WORDS, FREQUENT_VALUES // len(known)))
    values = cut(often.select(F.col("word").alias("whole"), "word"), size).join(table, "gram", "left")
    sums = values.groupBy(F.col("whole").alias("word")).agg(*[F.sum(_or_never(f"p{i}", never)).alias(f"w{i}") for i, (_, never) in enumerate(known)])
    return Model(table, known, F.broadcast(sums), small)


def _or_never(column: str, never: float) -> Column:
    return F.coalesce(F.col(column), F.lit(never))


def _parts(texts: DataFrame, id_col: str, text: Column, model: Model, size: int) -> DataFrame:
    """(id_col, s0, s1, ...): rows whose sums by text are its scores; a frequent word gives one, others one for each n-gram."""
    table, known, often, small = model
    own = [_or_never(f"p{i}", never).alias(f"s{i}") for i, (_, never) in enumerate(known)]
    words = texts.select(id_col, F.explode(letters(text)).alias("word"))
    if often is None:
        return cut(words, size).join(table, "gram", "left").select(id_col, *own)
    if small:
        met = cut(words.join(often, "word", "left"), size, F.col("w0").isNull()).join(table, "gram", "left")
        return met.select(id_col, *[F.coalesce(F.col(f"w{i}"), F.col(f"p{i}"), F.lit(never)).alias(f"s{i}") for i, (_, never) in enumerate(known)])
    # two branches: after one, a shuffle by n-gram would bring all frequent words, which have none, to one task
    rare = cut(words.join(often, "word", "left_anti"), size).join(table, "gram", "left")
    return words.join(often, "word").select(id_col, *[F.col(f"w{i}").alias(f"s{i}") for i in range(len(known))]).unionAll(rare.select(id_col, *own))


def confidences(texts: DataFrame, id_col: str, text: Column, model: Model, size: int = SIZE) -> DataFrame:
    """(id_col, code, confidence): each language's share for every text with letters."""
    known = model.known
    if not known:
        return texts.select(id_col, F.lit("").alias("code"), F.lit(0.0).alias("confidence")).limit(0)
    summed = _parts(texts, id_col, text, model, size).groupBy(id_col).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(known))])
    most = F.greatest(*[F.col(f"s{i}") for i in range(len(known))]) if len(known) > 1 else F.col("s0")
    shares = [F.exp(F.col(f"s{i}") - F.col("most")) for i in range(len(known))]
    total = reduce(lambda a, b: a + b, shares)
    rows = F.array(*[F.struct(F.lit(code).alias("code"), (share / F.col("total")).alias("confidence")) for (code, _), share in zip(known, shares)])
    return summed.withColumn("most", most).withColumn("total", total).select(id_col, F.inline(rows))


def predictions(texts: DataFrame, id_col: str, text: Column, model: Model, least: float = 0.75, most: int = 5) -> DataFrame:
    """(id_col, rank, code, confidence): languages of at least that confidence, surest first."""
    sure = confidences(texts, id_col, text, model).filter(F.col("confidence") >= least)
    order = Window.partitionBy(id_col).orderBy(F.desc("confidence"), "code")  # MOST_LANGUAGES rows at most
    return sure.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select(id_col, "rank", "code", "confidence")


def sure_languages(found: DataFrame, whole: str) -> DataFrame:
    """(whole, code, confidence): over the texts of one whole, each language with its greatest confidence."""
    return found.groupBy(whole, "code").agg(F.max("confidence").alias("confidence"))
