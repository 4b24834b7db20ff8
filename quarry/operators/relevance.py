"""Corpus relevance: an index of whole words with frequencies, BM25 scores over several fields, and fuzzy look-up.

The index is three tables: postings (term, field, doc, tf, len), terms (term, field, df) and fields (field, n_docs,
avg_len). Postings are written in the order of their terms, so a query's filter on its terms prunes files and row
groups; a frequent term's postings are spread over several files by document. A fourth, `deletions` (part, term), lets terms
within two edits meet in an equi join: it holds what is left of a short term when up to two characters are deleted, and three
segments of a longer one, of which two edits leave one as it is. So a term has a bounded number of parts, however long it is.

Scoring groups a query's postings by document, once, and keeps the best of each partition before they are merged. The numbers
of terms and fields of one query are small constants of its plan.

Defined results: a null field has no words; words are runs of letters and digits, in lower case; rows that share an id are
one document; a document without any word in any field is in no posting; ties of score go by id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
DIGITS = 6
#: Up to so many characters a term is found by deletions (22 parts at most), above by its three segments.
SHORT = 6


def words_of(text: Column) -> Column:
    """The words of a text: runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def query_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def phrases_of(query: str) -> list[str]:
    """A query as the phrases that are searched one by one: neighbouring words, of the query as it is and in lower case, and itself."""
    words = [*re.split(r"[ \-_.]", query), *re.split(r"[ \-_.]", query.lower())]
    pairs = [f"{a} {b}".strip() for a, b in zip(words, words[1:])]
    return list(dict.fromkeys(p for p in [*pairs, query.strip()] if p))


@dataclass(frozen=True)
class Index:
    """The tables of an index."""

    postings: DataFrame
    terms: DataFrame
    fields: DataFrame
    deletions: DataFrame


def build(docs: DataFrame, id_col: str, fields: dict[str, Column], path: str) -> Index:
    """Write the index of the documents' fields under a path, and read it back."""
    spoken = [F.struct(F.lit(n).alias("field"), words_of(F.col(f"f{i}")).alias("words")) for i, n in enumerate(fields)]
    # the texts go to their ids once: what is counted of a document afterwards, many rows, stays in its task
    dealt = docs.select(F.col(id_col).alias("doc"), *[c.cast("string").alias(f"f{i}") for i, c in enumerate(fields.values())]).repartition("doc")
    long = dealt.select("doc", F.inline(F.array(*spoken))).filter(F.size("words") > 0)
    whole = long.withColumn("len", F.sum(F.size("words")).over(Window.partitionBy("doc", "field")))  # the rows of one id
    counted = whole.select("doc", "field", "len", F.explode("words").alias("term")).groupBy("doc", "field", "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    # written before they are put in order: a range shuffle runs what lies before it twice, once for its bounds
    counted.write.parquet(f"{path}/counts")
    spark = docs.sparkSession
    counts = spark.read.parquet(f"{path}/counts")
    ordered = counts.select("doc", "field", "term", "tf", "len").repartitionByRange("term", "field", "doc").sortWithinPartitions("term", "field", "doc")
    ordered.write.parquet(f"{path}/postings")
    postings = spark.read.parquet(f"{path}/postings")
    postings.groupBy("term", "field").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{path}/terms")
    lengths = counts.groupBy("doc", "field").agg(F.max("len").alias("len"))
    lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len")).write.parquet(f"{path}/fields")
    words = spark.read.parquet(f"{path}/terms").select("term").distinct()
    gone = words.select(F.explode(parts_of_term(F.col("term"))).alias("part"), "term")
    gone.repartitionByRange("part", "term").sortWithinPartitions("part").write.parquet(f"{path}/deletions")
    return read(spark, path)


def read(spark: SparkSession, path: str) -> Index:
    return Index(*[spark.read.parquet(f"{path}/{t}") for t in ("postings", "terms", "fields", "deletions")])


def _facts(index: Index, terms: list[str], fields: list[str]) -> DataFrame:
    """(term, field, idf, blended, avg_len): at most a row for each of the query's terms and fields.

    blended: a term's weight as if all fields were one, from its greatest document frequency in any.
    """
    weigh = lambda n, df: F.log(1 + (n - df + 0.5) / (df + 0.5))
    own = index.terms.filter(F.col("term").isin(terms) & F.col("field").isin(fields)).join(F.broadcast(index.fields), "field")
    most = own.groupBy("term").agg(F.max("df").alias("df_all"), F.max("n_docs").alias("n_all"))
    return own.join(most, "term").select("term", "field", weigh(F.col("n_docs"), F.col("df")).alias("idf"), weigh(F.greatest("n_all", "df_all"), F.col("df_all")).alias("blended"), "avg_len")


def _weighted(index: Index, terms: list[str], fields: list[str]) -> DataFrame:
    """The query's postings with their saturated frequency and weights."""
    facts = F.broadcast(_facts(index, terms, fields))  # a row for each term and field of the query
    found = index.postings.filter(F.col("term").isin(terms) & F.col("field").isin(fields)).join(facts, ["term", "field"])
    return found.withColumn("part", F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len"))))


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0.0))


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def scores(index: Index, phrases: list[str], cross: dict[str, float], best: dict[str, float], best_weight: float = 0.8) -> DataFrame:
    """(doc, score) of the documents with any of the phrases' words.

    For each phrase: over its words the best field's part as if the fields were one (cross), and `best_weight` times the
    best single field's sum over the words (best).
    """
    spoken = [query_words(p) for p in phrases]
    terms = sorted({t for p in spoken for t in p})
    fields = sorted({*cross, *best})
    if not terms:
        return index.postings.select("doc", F.lit(0.0).alias("score")).limit(0)
    name = lambda kind, t, f: f"{kind}_{terms.index(t)}_{fields.index(f)}"
    at = lambda t, f: (F.col("term") == t) & (F.col("field") == f)
    parts = [F.coalesce(F.max(F.when(at(t, f), F.col(w) * F.col("part"))), F.lit(0.0)).alias(name(w, t, f)) for t in terms for w, own in (("blended", cross), ("idf", best)) for f in own]
    by_doc = _weighted(index, terms, fields).groupBy("doc").agg(*parts)
    summed = []
    for words in spoken:
        if words and cross:
            summed += [_greatest([cross[f] * F.col(name("blended", t, f)) for f in cross]) for t in words]
        if words and best:
            summed.append(best_weight * _greatest([best[f] * _total([F.col(name("idf", t, f)) for t in words]) for f in best]))
    return by_doc.select("doc", _total(summed).alias("score"))


def partial(docs: DataFrame, id_col: str, columns: list[str], phrases: list[str]) -> DataFrame:
    """(doc, score): one for each phrase of two characters or more that a column's value contains, as it is written."""
    hits = [F.when(F.contains(F.coalesce(F.col(c), F.lit("")), F.lit(p)), 1.0).otherwise(0.0) for p in phrases if len(p) >= 2 for c in columns]
    return docs.select(F.col(id_col).alias("doc"), _total(hits).alias("score")).filter("score > 0")


def top(scored: list[DataFrame], size: int, number: int = 1) -> DataFrame:
    """A page of the documents by the sum of their scores, best first, ties by id."""
    every = reduce(lambda a, b: a.unionByName(b), scored)
    summed = every.groupBy("doc").agg(F.round(F.sum("score"), DIGITS).alias("score")) if len(scored) > 1 else every.select("doc", F.round("score", DIGITS).alias("score"))
    return summed.orderBy(F.desc("score"), "doc").offset((number - 1) * size).limit(size)


def edits_allowed(word: Column) -> Column:
    """How many edits a fuzzy match allows for a word: none up to 2 characters, one up to 5, else two."""
    size = F.length(word)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def deletions(word: Column, most: Column) -> Column:
    """What is left of a word when up to `most` (2 at most) characters are deleted, each once."""

    def one(w: Column) -> Column:
        places = F.when(F.length(w) > 0, F.sequence(F.lit(1), F.length(w))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))

    none = F.array().cast("array<string>")
    first = F.when(most >= 1, one(word)).otherwise(none)
    second = F.when(most >= 2, F.flatten(F.transform(one(word), one))).otherwise(none)
    return F.array_distinct(F.concat(F.array(word), first, second))


def _segment(i: int, size: Column) -> tuple[Column, Column]:
    """Where the i-th of three segments of a term of that length starts, from 1, and its length."""
    cut = lambda j: F.floor(size * j / 3).cast("int")
    return cut(i) + 1, cut(i + 1) - cut(i)


def _segment_key(i: int, size: Column, segment: Column) -> Column:
    """A part that no deletion of a term equals, as terms hold no blanks."""
    return F.concat_ws(" ", size.cast("string"), F.lit(str(i)), segment)


def parts_of_term(term: Column) -> Column:
    """The parts by which a term is found: its deletions, or three segments with their place and the term's length."""
    size = F.length(term)
    segments = F.array(*[_segment_key(i, size, F.substr(term, *_segment(i, size))) for i in range(3)])
    return F.when(size <= SHORT, deletions(term, F.lit(2))).otherwise(segments)


def parts_of_word(word: Column, most: Column) -> Column:
    """The parts of all terms within `most` (2 at most) edits of a word, for an equi join with parts_of_term().

    If a term's segment is untouched, the edits before it shift it by s, those behind it make up for the rest of the
    difference d of the lengths: |s| + |d - s| edits at least.
    """
    size, keys = F.length(word), []
    for d in range(-2, 3):
        other = size - d
        for i in range(3):
            start, width = _segment(i, other)
            for s in range(-2, 3):
                if abs(s) + abs(d - s) <= 2:
                    fits = (F.lit(max(abs(s) + abs(d - s), abs(d))) <= most) & (other > SHORT) & (start + s >= 1) & (start + s + width - 1 <= size)
                    keys.append(F.when(fits, _segment_key(i, other, F.substr(word, start + s, width))))
    none = F.array().cast("array<string>")
    return F.concat(F.when(size - most <= SHORT, deletions(word, most)).otherwise(none), F.array_distinct(F.array_compact(F.array(*keys))))


def fuzzy_terms(words: DataFrame, index: Index) -> DataFrame:
    """(word, term, distance): the index's terms within the edits that each word allows, by an equi join on their parts."""
    asked = words.select(F.lower("word").alias("word")).distinct().withColumn("most", edits_allowed(F.col("word")))
    sent = asked.select("word", "most", F.explode(parts_of_word(F.col("word"), F.col("most"))).alias("part"))
    # those that are too far are left out before the pairs are shuffled; -1 is more than two
    met = sent.join(index.deletions, "part").select("word", "most", "term", F.levenshtein("word", "term", 2).alias("distance"))
    return met.filter("distance BETWEEN 0 AND most").select("word", "term", "distance").distinct()


def fuzzy_scores(index: Index, query: str, boosts: dict[str, float]) -> DataFrame:
    """(doc, score): the best field's sum, over the query's words, of the best term within a word's edits.

    A term d edits away counts 1 - d / (the shorter length). The query's words are few; the terms near them, whatever
    their number, are joined with the postings.
    """
    words = list(dict.fromkeys(query_words(query)))
    spark = index.postings.sparkSession
    near = fuzzy_terms(spark.createDataFrame([(w,) for w in words], "word string"), index)
    near = near.withColumn("share", 1 - F.col("distance") / F.least(F.length("word"), F.length("term")))
    facts = index.terms.filter(F.col("field").isin(list(boosts))).join(F.broadcast(index.fields), "field")  # one row a field
    weighed = near.join(facts, "term").withColumn("idf", F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    found = index.postings.join(weighed, ["term", "field"])
    part = F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len"))) * F.col("idf") * F.col("share")
    name = lambda i, f: f"s_{i}_{list(boosts).index(f)}"
    parts = [F.coalesce(F.max(F.when((F.col("word") == w) & (F.col("field") == f), part)), F.lit(0.0)).alias(name(i, f)) for i, w in enumerate(words) for f in boosts]
    if not words:
        return index.postings.select("doc", F.lit(0.0).alias("score")).limit(0)
    by_doc = found.groupBy("doc").agg(*parts)
    return by_doc.select("doc", _greatest([b * _total([F.col(name(i, f)) for i in range(len(words))]) for f, b in boosts.items()]).alias("score"))
