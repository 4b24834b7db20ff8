"""Triples with version ranges, snapshot stores as exports, and their upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_triples(triples: DataFrame, ranges: DataFrame, subject: Column | None = None) -> DataFrame:
    """(subject, predicate, object) of the triples with a range that is not deprecated, each once.

    triples: id, subject, predicate, object; ranges: triplet_id, use_start, use_end, deprecated, extraction_info_id.
    """
    live = ranges.filter(~F.col("deprecated"))
    own = triples if subject is None else triples.filter(F.col("subject") == subject)
    return own.join(live, own["id"] == live["triplet_id"]).select("subject", "predicate", "object").distinct()


#: Up to so many kinds of extraction are broadcast.
BROADCAST_ROWS = 100_000


def triples_with_extraction(triples: DataFrame, ranges: DataFrame, info: DataFrame) -> DataFrame:
    """Every triple's ranges with how they were extracted; info (id, method_description, extraction_confidence).

    A few kinds of extraction may have all ranges: a small info is broadcast, so that no task gets all ranges of a kind.
    """
    how = info.select(F.col("id").alias("extraction_info_id"), "method_description", "extraction_confidence")
    how = F.broadcast(how) if how.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else how
    own = triples.select(F.col("id").alias("triplet_id"), "subject", "predicate", "object")
    return own.join(ranges, "triplet_id").join(how, "extraction_info_id").select(
        "subject", "predicate", "object", "use_start", "use_end", "deprecated", "method_description", "extraction_confidence"
    )


def export_rows(store: DataFrame) -> DataFrame:
    """(model_uri, snapshots): one JSON text a model with its snapshots, the newest first."""
    one = F.struct("valid_from", "predicate_iri", "snapshot_hash", F.to_json(F.struct(*[c for c in store.columns if c != "model_uri"])).alias("j"))
    rows = store.groupBy("model_uri").agg(F.sort_array(F.collect_list(one), asc=False).alias("all"))
    return rows.select("model_uri", F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["j"]), ","), F.lit("]")).alias("snapshots"))


def without_models(store: DataFrame, models: DataFrame) -> DataFrame:
    """The store without all that belongs to some models."""
    return store.join(models.select("model_uri").distinct(), "model_uri", "left_anti")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): keys that stand there more than once; empty if the table keeps its constraint."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def kept_runs(files: DataFrame, run: str, day: Column, before: str) -> DataFrame:
    """What retention leaves: files of runs that began on the date or later, or whose name holds no date."""
    return files.filter(F.coalesce(day >= F.lit(before).cast("date"), F.lit(True)) & F.col(run).isNotNull())


def triple_delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(s, added): how many triples a load adds to each subject; triples already there add nothing."""
    new = after.select(*keys).distinct().join(before.select(*keys).distinct(), keys, "left_anti")
    return new.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("added"))
