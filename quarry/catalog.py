"""Registry of the engine's queries: name -> (spark, sf_dir) -> DataFrame, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that computes the same rows where there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


from quarry.plans import answer_queries, card_queries, catalogue_queries, detail_queries, field_queries, graph_queries, language_queries, record_queries, relevance_queries, search_queries, upkeep_queries, view_queries  # noqa: E402,F401
