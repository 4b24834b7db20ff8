"""Entity identification: a registry of expressions, long entity tables, linking, merging and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.idents import entity_iri

Strings = "array<string>"


def _col(name: str) -> Column:
    return F.col(name)


def hub_identifiers(languages: list[str] | None = None, tasks: list[str] | None = None) -> dict[str, Column]:
    """Kind -> expression over a hub record (tags, pipeline_tag, library_name, author, modelId) that yields its entities."""
    tags = F.coalesce(_col("tags"), text.empty_strings())
    out = {
        "dataset": text.tag_values(tags, "dataset:"),
        "article": text.tag_values(tags, "arxiv:"),
        "base_model": text.base_model_tags(tags),
        "license": text.tag_values(tags, "license:"),
        "keyword": text.keyword_tags(tags),
        "shared_by": F.array_compact(F.array(F.nullif(F.trim("author"), F.lit("")))),
        "model_size": F.array_compact(F.array(text.size_label(_col("modelId")))),
    }
    if languages is not None:
        known = F.array(*[F.lit(c) for c in languages])
        out["language"] = F.array_distinct(F.filter(tags, lambda t: F.array_contains(known, t)))
    if tasks is not None:
        catalogue = F.array(*[F.lit(t) for t in tasks])
        spelled = F.transform(F.concat(F.array(F.coalesce(_col("pipeline_tag"), F.lit(""))), tags), text.task_token)
        out["task"] = F.array_sort(F.array_distinct(F.filter(spelled, lambda t: F.array_contains(catalogue, t))))
    return out


def image_identifiers() -> dict[str, Column]:
    """The same for bio-image records, whose cells are text or JSON text."""
    blank = F.lit("")
    lic = F.coalesce(F.nullif(F.trim("licence"), blank), F.nullif(F.trim("license"), blank))
    shared = F.nullif(F.trim("sharedBy"), blank)
    return {
        "dataset": F.array_compact(F.array(F.nullif(F.trim("trainedOn"), blank))),
        "keyword": text.keyword_cell(_col("keywords")),
        "license": F.array_compact(F.array(lic)),
        "shared_by": F.array_compact(F.array(F.when(F.lower(shared) != "none", shared))),
        "task": text.tasks_of(text.keyword_cell(_col("keywords")), F.coalesce("description", "intendedUse"), _col("documentation")),
    }


def identify(df: DataFrame, id_col: str, kinds: dict[str, Column]) -> DataFrame:
    """(id, kind, value): every entity of every record, all kinds in one scan and one explode."""

    def tagged(kind: str):
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))

    every = F.flatten(F.array(*[F.transform(F.coalesce(e.cast(Strings), text.empty_strings()), tagged(k)) for k, e in kinds.items()]))
    rows = df.select(F.col(id_col), F.explode(every).alias("e")).select(id_col, "e.kind", "e.value")
    return rows.filter(F.col("value").isNotNull() & (F.trim("value") != ""))


def entities(long: DataFrame) -> DataFrame:
    """(kind, value): each entity of the corpus once."""
    return long.select("kind", "value").distinct()


def linked(long: DataFrame, id_col: str, platform: str) -> DataFrame:
    """One row a record with an array of entity IRIs for each kind, sorted."""
    iri = entity_iri(F.lit(platform), F.col("kind"), F.col("value"))
    rows = long.withColumn("iri", iri).groupBy(id_col, "kind").agg(F.array_sort(F.collect_set("iri")).alias("iris"))
    return rows.groupBy(id_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "iris")))).alias("links"))


def keywords_without(tags: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """(id, tag): tags that are no entity of their record, neither as a whole nor behind their last colon."""
    out = tags.withColumn("__tail", F.trim(F.substring_index("tag", ":", -1)))
    whole = known.select(id_col, F.col("value").alias("tag")).distinct()
    tail = known.select(id_col, F.col("value").alias("__tail")).distinct()
    return out.join(whole, [id_col, "tag"], "left_anti").join(tail, [id_col, "__tail"], "left_anti").select(id_col, "tag")


def merge_partials(base: DataFrame, partials: list[DataFrame], key: str) -> DataFrame:
    """A record with what partial records add: later partials win where they have a value."""
    out = base
    for part in partials:
        shared = [c for c in part.columns if c != key and c in out.columns]
        renamed = part.select(key, *[F.col(c).alias(f"__{c}") if c in shared else F.col(c) for c in part.columns if c != key])
        out = out.join(renamed, key, "left")
        for c in shared:
            out = out.withColumn(c, F.coalesce(f"__{c}", c)).drop(f"__{c}")
    return out


def merge_metadata(older: Column, newer: Column) -> Column:
    """Two metadata maps as one; entries of the newer win."""
    kept = F.map_filter(older, lambda k, _: ~F.map_contains_key(newer, k))
    return F.when(older.isNull(), newer).when(newer.isNull(), older).otherwise(F.map_concat(kept, newer))


def overlay_description(description: Column, abstract: Column, said: Column) -> Column:
    """struct(description, abstract): an extracted description wins, and the old one becomes the abstract if there is none."""
    use = text.is_meaningful(said)
    moved = use & text.is_meaningful(description) & F.coalesce(abstract == "", F.lit(True)) & (F.trim(description) != F.trim(said))
    return F.struct(
        F.when(use, said).otherwise(description).alias("description"), F.when(moved, F.trim(description)).otherwise(abstract).alias("abstract")
    )


def overlay_task(tasks: Column, said: Column) -> Column:
    """An extracted task counts only where there is none."""
    none = F.size(F.coalesce(tasks, text.empty_strings())) == 0
    return F.when(none & text.is_meaningful(said), F.array(said)).otherwise(tasks)


def wrapped_id(cell: Column) -> Column:
    """A numeric id written as it is, or wrapped as [{"data": id}]; null for anything else."""
    return F.coalesce(cell.try_cast("long"), F.get(F.from_json(cell, "array<struct<data: string>>"), 0)["data"].try_cast("long"))
