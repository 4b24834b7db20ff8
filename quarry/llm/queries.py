"""The registered queries of this package, one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (
    alignment,
    collocations,
    decontaminate,
    interpolated_lm,
    license_scan,
    media_store,
    ordinal_quality,
    packing,
    quality_rules,
    sentence_pieces,
    simhash,
    token_store,
    url_filter,
)
from quarry.llm._tables import small_batches
from quarry.llm.chunks import vocabulary_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


@_query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


@_query("op8_token_store")
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), vocabulary=49_408)


@_query("op1_sentence_pieces")
def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip_digests(_table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


@_query("op2_ordinal_quality")
def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, _table(spark, sf_dir, "labels"), ordinal_quality.graded_by_labels(), 3)
    return ordinal_quality.score(docs, model)


@_query("op9_license_scan", license_scan.scan_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


#: The rules of the query: (host and path prefix, verdict).
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@_query("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@_query("op4_media_columns")
def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_store.media_columns(_table(spark, sf_dir, "documents"))


@_query("op3_interpolated_lm")
def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_texts(_table(spark, sf_dir, "documents"))


@_query("op11_phrase_collocations", collocations.collocations_sql())
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


@_query("op12_benchmark_decontamination", decontaminate.report_sql())
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("longest")


@_query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
