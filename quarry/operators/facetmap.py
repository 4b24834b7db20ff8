"""Facets of free-text queries: the longest phrases of a query that are values of a facet, and the words that are left.

A query's runs of words, up to the longest value's number, meet the values in one equi join; which of them count is then
decided in the query's own row. Values of a few MB are broadcast, others are shuffled with the runs; the runs themselves, many
times the queries, are never broadcast, however small the queries' file looks. Without a tagger every left word counts as a term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that say nothing of what is sought.
TRIVIAL = ("model", "models", "task", "tasks", "dataset", "datasets", "example")
#: Values of up to so many bytes are broadcast.
BROADCAST_BYTES = 16 << 20
_WORD = r"[\p{L}\p{N}]+(?:[.+_-][\p{L}\p{N}]+)*"


def words_in_order(text: Column) -> Column:
    """The words of a query in lower case; points and dashes inside a word belong to it."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), 0)


def facet_values(rows: DataFrame, facets: dict[str, str]) -> DataFrame:
    """(phrase, facet, value): every value of the facets' columns as a phrase, each once.

    A phrase that several facets have belongs to the first of them; values with one phrase are one, the least.
    """
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(f).alias("facet"), F.col(c).cast("string").alias("value")) for i, (f, c) in enumerate(facets.items())]))
    said = rows.select(each).distinct().withColumn("phrase", F.array_join(words_in_order(F.col("value")), " ")).filter("phrase != ''")
    return said.groupBy("phrase").agg(F.min(F.struct("place", "value", "facet")).alias("least")).select("phrase", "least.facet", "least.value")


def map_queries(queries: DataFrame, id_col: str, text_col: str, values: DataFrame, trivial: tuple[str, ...] = TRIVIAL) -> DataFrame:
    """(id, facet_values, terms): each query's facet values (facet, value), by name, and its other words in order.

    From the left, the longest phrase that is a value counts and its words are used up. Words left over are terms if they have
    more than two characters and are neither trivial nor a facet's name, each once. Every row of the queries has one row;
    a null or empty text has neither values nor terms. ids must be unique. A query's words are in one row.
    """
    weight = F.sum(F.octet_length("phrase") + F.octet_length("value") + F.octet_length("facet") + 64)
    facts = values.agg(F.max(F.size(F.split("phrase", " "))).alias("longest"), F.collect_set("facet").alias("facets"), weight.alias("bytes")).first()
    longest, names = facts["longest"] or 0, sorted(facts["facets"])  # two numbers and the facets' names
    sought = F.broadcast(values) if (facts["bytes"] or 0) <= BROADCAST_BYTES else values.hint("merge")
    # dealt out by id first: a small file of queries is few tasks, and its runs are many rows
    own = queries.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartition("id").select("id", words_in_order(F.col("text")).alias("words"))
    at = F.sequence(F.lit(1), F.size("words"))
    runs = own.filter(F.size("words") > 0).select("id", "words", F.explode(at).alias("start"))
    runs = runs.select("id", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), F.size("words") - F.col("start") + 1))).alias("n"), "words")
    runs = runs.select("id", "start", "n", F.array_join(F.slice("words", F.col("start"), F.col("n")), " ").alias("phrase"))
    # of the matches at a word only the longest can count: the others do not go into the row
    best = runs.join(sought, "phrase").groupBy("id", "start").agg(F.max(F.struct("n", "facet", "value")).alias("best"))
    met = best.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "best.n", "best.facet", "best.value"))).alias("met"))
    none = F.array().cast("array<struct<start:int,n:int,facet:string,value:string>>")
    free = F.aggregate(
        "met",
        F.struct(F.lit(1).alias("next"), none.alias("kept")),
        lambda s, m: F.when(m["start"] >= s["next"], F.struct((m["start"] + m["n"]).alias("next"), F.concat(s["kept"], F.array(m)).alias("kept"))).otherwise(s),
        lambda s: s["kept"],
    )
    kept = met.select("id", free.alias("kept"))
    out = own.join(kept.hint("merge"), "id", "left").withColumn("kept", F.coalesce("kept", none))
    used = F.flatten(F.transform("kept", lambda k: F.sequence(k["start"], k["start"] + k["n"] - 1)))
    left = F.array_except(F.sequence(F.lit(1), F.size("words")), used)
    terms = F.array_distinct(F.transform(F.when(F.size("words") > 0, left).otherwise(F.array().cast("array<int>")), lambda i: F.get("words", i - 1)))
    dull = [w.lower() for w in (*trivial, *names)]
    found = F.array_sort(F.array_distinct(F.transform("kept", lambda k: F.struct(k["facet"].alias("facet"), k["value"].alias("value")))))
    return out.select("id", found.alias("facet_values"), F.filter(terms, lambda t: (F.length(t) > 2) & ~t.isin(dull)).alias("terms"))
