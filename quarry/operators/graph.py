"""Graph reads over edge tables (src, rel, dst) and node tables (id, label, name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def neighbourhood(edges: DataFrame, ids: DataFrame, direction: str = "outgoing", depth: int = 1) -> DataFrame:
    """(root, hop, src, rel, dst): the edges around each id, hop by hop, each edge once for a root."""
    roots = ids.select(F.col("id").alias("root")).distinct()
    front, out = roots.withColumn("at", F.col("root")), None
    for hop in range(1, depth + 1):
        parts = []
        if direction in ("outgoing", "both"):
            parts.append(front.join(edges, F.col("at") == F.col("src")).select("root", F.lit(hop).alias("hop"), "src", "rel", "dst", F.col("dst").alias("next")))
        if direction in ("incoming", "both"):
            parts.append(front.join(edges, F.col("at") == F.col("dst")).select("root", F.lit(hop).alias("hop"), "src", "rel", "dst", F.col("src").alias("next")))
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        out = found.drop("next") if out is None else out.unionByName(found.drop("next"))
        if hop < depth:
            front = cut_lineage(found.select("root", F.col("next").alias("at")).distinct())
    return out.groupBy("root", "src", "rel", "dst").agg(F.min("hop").cast("int").alias("hop")).select("root", "hop", "src", "rel", "dst")


def touching(edges: DataFrame, entity: str) -> DataFrame:
    """(model, rel): what is linked to an entity in either direction, with its least relation."""
    both = edges.filter(F.col("dst") == entity).select(F.col("src").alias("model"), "rel").unionByName(edges.filter(F.col("src") == entity).select(F.col("dst").alias("model"), "rel"))
    return both.groupBy("model").agg(F.min("rel").alias("rel"))


def grouped_values(edges: DataFrame, nodes: DataFrame, rels: list[str] | None = None) -> DataFrame:
    """(rel, value, n): names of the targets of each relation and how many sources have them."""
    used = edges.filter(F.col("rel").isin(*rels)) if rels else edges
    named = used.join(nodes.select(F.col("id").alias("dst"), "name"), "dst", "left")
    return named.groupBy("rel", F.coalesce("name", F.col("dst").cast("string")).alias("value")).agg(F.countDistinct("src").alias("n"))


def ancestors(parents: DataFrame, seeds: DataFrame, rounds: int = 3) -> DataFrame:
    """(id, ancestor, depth): parents of parents up to `rounds` steps, with the least depth; cycles end by themselves.

    Each round joins what the round before found, and is checkpointed, so that plans do not grow with the rounds.
    """
    pairs = parents.select(F.col("id").alias("child"), F.col("parent"))
    front = seeds.select("id", F.col("id").alias("at")).distinct()
    out = None
    for depth in range(1, rounds + 1):
        step = front.join(pairs, F.col("at") == F.col("child")).select("id", F.col("parent").alias("ancestor"), F.lit(depth).alias("depth")).distinct()
        if out is not None:
            step = step.join(out.select("id", "ancestor"), ["id", "ancestor"], "left_anti")
        step = cut_lineage(step)
        out = step if out is None else out.unionByName(step)
        if depth > 1 and step.isEmpty():
            break
        front = step.select("id", F.col("ancestor").alias("at"))
    return out


def page(df: DataFrame, order: list, number: int, size: int, excluding: bool = False) -> DataFrame:
    """A page by number; with exclusions given, page 2 starts at the first row, as what page 1 had is already left out."""
    size = min(max(size, 1), 1000)
    shift = max(number - 2, 0) * size if excluding else (number - 1) * size
    return df.orderBy(*order).offset(shift).limit(size)


def page_after(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Keyset paging: rows behind a key, in its order, with whether more follow."""
    rows = (df if after is None else df.filter(F.col(key) > F.lit(after))).orderBy(key).limit(size + 1)
    numbered = rows.withColumn("__n", F.row_number().over(Window.orderBy(key)))  # size + 1 rows at most
    more = F.max("__n").over(Window.partitionBy()) > size
    return numbered.withColumn("has_more", more).filter(F.col("__n") <= size).drop("__n")
