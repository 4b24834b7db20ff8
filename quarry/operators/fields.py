"""Small operators on fields and ids: patterns over triples, requested columns, flat records, addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.idents import entity_iri


def match_patterns(triples: DataFrame, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """Bindings of the variables (?x) of triple patterns: each pattern is a filter, patterns are joined on shared variables.

    Patterns come in an order in which each shares a variable with those before it; otherwise it is an error. Every
    pattern's own bindings are made distinct: the natural join of sets is a set, so its rows, which may be the square of
    the triples, are neither shuffled nor held.
    """
    out: DataFrame | None = None
    for pattern in patterns:
        rows, names = triples, {}
        for column, part in zip("spo", pattern):
            if part.startswith("?"):
                if part[1:] in names:
                    rows = rows.filter(F.col(column) == F.col(names[part[1:]]))
                names.setdefault(part[1:], column)
            else:
                rows = rows.filter(F.col(column) == F.lit(part))
        bound = rows.select(*[F.col(c).alias(n) for n, c in names.items()]).distinct()
        if out is None:
            out = bound
            continue
        shared = [n for n in names if n in out.columns]
        if not shared:
            raise ValueError(f"{pattern} shares no variable with the patterns before it")
        out = out.join(bound, shared)
    return out


def ids_of(spark: SparkSession, given: str) -> DataFrame:
    """(id): ids in a text between commas, each once."""
    ids = dict.fromkeys(p.strip() for p in given.split(",") if p.strip())
    return spark.createDataFrame([(i,) for i in ids], "id string")


def requested(df: DataFrame, wanted: list[str], allowed: list[str], always: list[str]) -> DataFrame:
    """The columns that are wanted, allowed and there, behind those that always come."""
    return df.select(*always, *[c for c in dict.fromkeys(wanted) if c in allowed and c in df.columns and c not in always])


def seen_ids(pages: DataFrame, column: str) -> DataFrame:
    """(id): the ids of lists of ids, each once."""
    return pages.select(F.explode(column).alias("id")).distinct()


def flattened(df: DataFrame) -> DataFrame:
    """Fields of struct columns as columns of their own, named by their path with dots."""

    def leaves(kind: StructType, at: list[str]) -> list[Column]:
        out: list[Column] = []
        for field in kind:
            path = [*at, field.name]
            if isinstance(field.dataType, StructType):
                out += leaves(field.dataType, path)
            else:
                out.append(reduce(lambda c, n: c[n], path[1:], F.col(f"`{path[0]}`")).alias(".".join(path)))
        return out

    return df.select(*leaves(df.schema, []))


def by_either(wanted: DataFrame, key: str, known: DataFrame, ids: list[str], value: str) -> DataFrame:
    """Wanted keys with the least value of the records that have the key under any of several ids."""
    long = known.select(F.explode(F.array_distinct(F.array(*ids))).alias("__id"), value).groupBy("__id").agg(F.min(value).alias(value))
    return wanted.join(long, F.col(key) == F.col("__id"), "left").drop("__id")


#: Platform, name and address of the catalogues.
SITES = (("HF", "Hugging Face", "https://huggingface.co/"), ("AI4Life", "AI4Life", "https://ai4life.eurobioimaging.eu/"))


def site_rows(spark: SparkSession) -> DataFrame:
    """(platform, identifier, name, url) of the catalogues; the identifier is minted as for any entity."""
    rows = spark.createDataFrame(list(SITES), "platform string, name string, url string")
    return rows.select("platform", entity_iri(F.col("platform"), F.lit("WebSite"), F.col("url")).alias("identifier"), "name", "url")


def _bare(iri: Column) -> Column:
    return F.regexp_replace(iri, "^<+|>+$", "")


def crate_id(iri: Column) -> Column:
    return F.concat(_bare(iri), F.lit("/ro-crate-metadata.json"))


def metadata_id(iri: Column) -> Column:
    return F.concat(_bare(iri), F.lit("/metadata.json"))


def last_date(modified: Column, created: Column, otherwise: Column) -> Column:
    """The day of the first that is there."""
    return F.coalesce(*[F.substring(F.split_part(d, F.lit("T"), F.lit(1)), 1, 10) for d in (modified, created, otherwise)])


def slugs(html: Column) -> Column:
    """The one-part paths that a page links to, each once, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('href="/([^"/]+)"'), 1)))
