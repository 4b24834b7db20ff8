"""Queries behind list views and housekeeping: summaries of facet values, page links, stale runs, preferred rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.session import table


def _facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(facet, value): the distinct values of two facets of the documents, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("lang", "source")])
    values = table(spark, sf_dir, "documents").select(F.inline(pairs)).filter("value IS NOT NULL")
    return values.distinct()


_VALUES = """
    v AS (SELECT 'lang' AS facet, lang AS value FROM documents WHERE lang IS NOT NULL
          UNION SELECT 'source', source FROM documents WHERE source IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY value) AS n FROM v)
"""


def _first_of_each(values: DataFrame, most: int) -> DataFrame:
    """The least values of every facet; Spark cuts each partition to `most` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("facet").orderBy("value"))
    return values.withColumn("n", rank).filter(F.col("n") <= most)


@register(
    "facet_summary",
    f"WITH {_VALUES}, t AS (SELECT facet, count(*)::BIGINT AS total FROM v GROUP BY facet) "
    "SELECT facet, total, string_agg(value, ', ' ORDER BY value) AS shown FROM r JOIN t USING (facet) WHERE n <= 8 GROUP BY facet, total",
)
def facet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every facet the number of values and the first eight of them."""
    values = _facet_values(spark, sf_dir)
    total = values.groupBy("facet").agg(F.count(F.lit(1)).alias("total"))
    shown = _first_of_each(values, 8).groupBy("facet").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("shown"))
    return total.join(shown, "facet")


@register("refinement_values", f"WITH {_VALUES} SELECT facet, lower(value) AS value FROM r WHERE n <= 15")
def refinement_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values offered when a query is refined: two facets, fifteen values each, in lower case."""
    return _first_of_each(_facet_values(spark, sf_dir), 15).select("facet", F.lower("value").alias("value"))


@register(
    "page_links",
    """WITH c AS (SELECT ceil(count(*) / 100.0)::BIGINT AS pages FROM documents),
       p AS (SELECT pages, unnest(range(1, pages + 1)) AS page FROM c)
       SELECT page, CASE WHEN page > 1 THEN '/list?page=' || (page - 1) || '&page_size=100' END AS prev_link,
              CASE WHEN page < pages THEN '/list?page=' || (page + 1) || '&page_size=100' END AS next_link FROM p""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links to the pages before and after each page of a list."""
    pages = table(spark, sf_dir, "documents").agg(F.ceil(F.count(F.lit(1)) / 100).alias("pages")).filter("pages > 0")
    link = lambda n: F.concat(F.lit("/list?page="), n.cast("string"), F.lit("&page_size=100"))
    page = F.col("page")
    return pages.select("pages", F.explode(F.sequence(F.lit(1).cast("long"), F.col("pages"))).alias("page")).select(
        "page", F.when(page > 1, link(page - 1)).alias("prev_link"), F.when(page < F.col("pages"), link(page + 1)).alias("next_link")
    )


@register(
    "stale_runs",
    """SELECT strftime(ts, '%Y-%m-%d') AS run, count(*)::BIGINT AS n_files, sum(length(props))::BIGINT AS n_bytes,
              strftime(min(ts), '%H:%M:%S') AS first_at, strftime(max(ts), '%H:%M:%S') AS last_at
       FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1""",
)
def stale_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a retention date would remove: files, bytes and the span of each daily run before it."""
    old = table(spark, sf_dir, "events").filter(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-11 00:00:00")))
    return old.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.length("props")).cast("long").alias("n_bytes"),
        F.date_format(F.min("ts"), "HH:mm:ss").alias("first_at"),
        F.date_format(F.max("ts"), "HH:mm:ss").alias("last_at"),
    )


@register(
    "preferred_first_turn",
    """SELECT conv_id, turn, role, text FROM (
         SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY role <> 'assistant', turn, text) AS n FROM conversations) WHERE n = 1""",
)
def preferred_first_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of a group, rows of a preferred kind before others; merged before the shuffle."""
    best = F.min(F.struct((F.col("role") != "assistant").alias("other"), "turn", "text", "role")).alias("best")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(best).select("conv_id", "best.turn", "best.role", "best.text")
