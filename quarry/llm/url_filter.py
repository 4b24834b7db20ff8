"""URL filters: rule lists, and gradient-boosted trees on lexical features for what no rule covers.

Everything is DataFrame expressions and Spark's own boosted trees; no Python runs on the executors.

Features of an url: its length, the path's depth and length, labels of the host, share of digits, hyphens, entropy of
its characters, number of query parameters, a fragment, and statistics of the host's suffixes (last label and last two labels):
how many labelled urls have the suffix and the smoothed share of them that is blocked. Labelled urls are those that a
rule decides, or a label column. A labelled url's own statistics are out of fold: hosts are dealt to five folds, and what
the url's fold holds does not count for it, so the trees are never shown a label through its own host. Training takes at
most `train_rows` labelled urls (20,000 by default), those with the least hash; suffix statistics count all labelled urls.

Pages are read once: what the rules and the features need is written to the shared folder, one row for each page
without its html, and counted, sampled and scored from there.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule; its verdict comes from
the trees like any other's. A very long url is measured whole. Of rules of one length that fit, the last in the order of
the alphabet wins. With no labelled urls, or labels of one kind only, the trees are left out and the verdict is allow, or
that kind; a tie of the trees is allow. Rows with a null id and repeated rows are judged like any other; urls with one
hash at the sample's edge are ordered by id and url; an empty table gives no rows; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._tables import drop_path, materialize, materialize_at

FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ("url_length", "path_length", "path_depth", "host_labels", "digit_share", "hyphens", "entropy", "n_params", "has_fragment")
SUFFIX = ("last_label_n", "last_label_share", "last_two_n", "last_two_share")


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does.

    A rule is a host and a path prefix ("example.com/de/"); it fits the host and all its subdomains.
    """
    out: Column = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(set(rules), key=lambda r: (len(r[0]), r[0])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """The LEXICAL columns."""
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    count = lambda text, kind: F.length(F.regexp_replace(text, f"[^{kind}]", ""))
    shares = F.transform(
        F.array_distinct(F.filter(F.split(url, ""), lambda c: c != "")),
        lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size,
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = (
        F.length(url),
        F.length(path),
        count(path, "/"),
        F.when(host == "", 0).otherwise(F.size(F.split(host, r"\."))),
        count(url, "0-9") / size,
        count(url, "\\-"),
        entropy,
        F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        F.contains(url, F.lit("#")).cast("int"),
    )
    return [v.cast("double").alias(name) for name, v in zip(LEXICAL, values)]


def parsed(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str, url_col: str, label: Column | None) -> DataFrame:
    """(page_id, host, path, rule, ruled, label, fold, url_hash, last_label, last_two, LEXICAL...)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), (F.lit(None) if label is None else label).cast("int").alias("given"))
    rows = rows.select("page_id", "url", "given", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    labels = F.split("host", r"\.")
    return rows.select(
        "page_id", "host", "path",
        F.col("match.rule").alias("rule"),
        F.col("match.verdict").alias("ruled"),
        F.coalesce("given", (F.col("match.verdict") == "block").cast("int")).cast("double").alias("label"),
        F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"),
        F.xxhash64("page_id", "url").alias("url_hash"),
        F.element_at(labels, -1).alias("last_label"),
        F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".").alias("last_two"),
        *lexical_features(F.col("url"), F.col("host"), F.col("path")),
    )


def suffix_counts(rows: DataFrame) -> DataFrame:
    """(last_label, last_two, fold, n, bad): labelled rows by suffix and fold, the only pass over them."""
    labelled = rows.filter(F.col("label").isNotNull())
    return labelled.groupBy("last_label", "last_two", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad"))


def with_suffix_statistics(rows: DataFrame, counts: DataFrame, prior: float, smoothing: float = 10.0) -> DataFrame:
    """Add the SUFFIX columns from suffix_counts(); a labelled row's own fold does not count for it.

    A suffix may hold most rows, so the join is left to Spark: it broadcasts the counts only below its own size limit,
    and splits a hot suffix otherwise.
    """
    for key in ("last_label", "last_two"):
        by_fold = counts.groupBy(key, "fold").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        stats = by_fold.groupBy(F.col(key).alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "bad")))).alias("folds"))
        own = F.when(F.col("label").isNotNull(), F.col("fold")).otherwise(F.lit(-1))
        others = F.filter(F.map_entries("folds"), lambda e: e["key"] != own)
        total = lambda f: F.coalesce(F.aggregate(others, F.lit(0.0), lambda acc, e: acc + e["value"][f].cast("double")), F.lit(0.0))  # noqa: E731, B023
        rows = rows.join(stats, rows[key] == stats["k"], "left").withColumns({"__n": total("n"), "__bad": total("bad")})
        rows = rows.withColumns({f"{key}_n": F.log1p("__n"), f"{key}_share": (F.col("__bad") + smoothing * prior) / (F.col("__n") + smoothing)}).drop("k", "folds", "__n", "__bad")
    return rows


def judge(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]],
    label: Column | None = None,
    train_rows: int = 20_000,
    trees: int = 12,
    depth: int = 4,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, by) for every page: the rule's verdict, else the trees'."""
    rows = materialize(parsed(pages, rules, id_col, url_col, label), "url-rows")
    counts = materialize(suffix_counts(rows), "url-suffixes")
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad")).first()
    columns = ["page_id", "host", "path", "rule", "ruled"]
    if not 0 < seen["bad"] < seen["n"]:
        judged = rows.select(*columns, F.lit("block" if seen["n"] and seen["bad"] else "allow").alias("guess"))
    else:
        names = [*LEXICAL, *SUFFIX]
        prior = seen["bad"] / seen["n"]
        first = rows.filter(F.col("label").isNotNull()).orderBy(F.xxhash64("url_hash"), "url_hash", "page_id", "host", "path").limit(train_rows)
        sample, sample_path = materialize_at(with_suffix_statistics(first, counts, prior).select("label", *names), "url-sample")
        assemble = VectorAssembler(inputCols=names, outputCol="features")
        grower = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=7, checkpointInterval=-1)
        if sample.select("label").distinct().count() < 2:
            judged = rows.select(*columns, F.lit("block" if prior > 0.5 else "allow").alias("guess"))
        else:
            model = grower.fit(assemble.transform(sample))
            scored = model.transform(assemble.transform(with_suffix_statistics(rows, counts, prior)))
            judged = scored.select(*columns, F.when(F.col("prediction") > 0.5, "block").otherwise("allow").alias("guess"))
        drop_path(pages.sparkSession, sample_path)
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "guess").alias("verdict"), F.when(F.col("rule").isNull(), "trees").otherwise("rule").alias("by")
    )
