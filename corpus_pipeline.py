"""From raw documents to packed training sequences: quality classifier, quality rules, near-dedup, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of `documents`
and the rows that they keep; run() writes each stage's rows as Parquet to the shared folder, reads them back as the
next one's documents, and drops what the stage before had written.

Defined results: a null or empty text has no words, so the classifier rejects it; a tail probability equal to the
threshold stays; very long texts are judged, compared and packed whole; ids may be null or repeated: the first two
stages judge each row by itself, the third keeps one row of each group of near copies, by id, then by a hash of the row,
whatever the ids are, and of rows that are equal in all columns one, and the last packs what is left, row by row; an
empty table stays empty; other columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import ordinal_quality, packing, quality_rules, simhash
from quarry.llm._tables import drop_path, materialize_at, small_batches
from quarry.llm.chunks import vocabulary_path

#: Documents stay if P(grade >= 1), that is of not being poor, reaches this.
KEEP_PROBABILITY = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the ordinal classifier, trained on the labelled documents, takes for good."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = ordinal_quality.train(docs, labels, ordinal_quality.graded_by_labels(), 3)
    return ordinal_quality.keep_good(docs, model, at_least=1, threshold=KEEP_PROBABILITY)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what meets the word counts and the compression bands."""
    small_batches(spark)
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the least id, of each group of near copies: twelve fingerprints of 5-word shingles."""
    small_batches(spark)
    return simhash.keep_one_of_each(docs, shingle=5, radius=4, sets=12)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules_stage),
    ("simhash_near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier and the compression bands cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = materialize_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
