"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._tables import drop_path, materialize_at


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return out.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the least node of its component.

    Each round is a shuffle of the links, written to the shared folder; rounds grow with the logarithm of the
    longest chain. A node with very many links is split by Spark's skew join; its least neighbour is pre-aggregated.
    """
    now, path = materialize_at(edges.select("u", "v").filter("u <> v"), "components-0")
    seen = None
    for step in range(max_rounds):
        after, new = materialize_at(_small_star(_large_star(now)), f"components-{step + 1}")
        drop_path(edges.sparkSession, path)
        now, path = after, new
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
