"""The catalogue's transforms: raw records to normalised models and side entities, and the composed reads over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import dates, idents, text
from quarry.operators import identify, records, temporal

#: Fixed value: the hub's address.
HUB = "https://huggingface.co/"


def metadata(method: str, source: str, notes: str | None = None, confidence: float = 1.0) -> Column:
    """One entry of extraction metadata."""
    return F.struct(
        F.lit(method).alias("extraction_method"), F.lit(confidence).alias("confidence"), F.lit(source).alias("source_field"), F.lit(notes).cast("string").alias("notes")
    )


def _metadata_map(entries: dict[str, Column]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in entries]), F.array(*entries.values()))


def extract_page(snapshot: DataFrame, recent: DataFrame, keep: Column, limit: int, offset: int = 0) -> DataFrame:
    """A page of model records: snapshot and recent ones together, the last record of an id, newest first, filtered.

    Recent records count as later than the snapshot's; among equal ones the newer modification wins.
    """
    both = snapshot.withColumn("__rank", F.lit(0)).unionByName(recent.withColumn("__rank", F.lit(1)), allowMissingColumns=True)
    last = records.keep_last(both, ["modelId"], [F.desc("__rank"), F.desc_nulls_last("last_modified")]).drop("__rank")
    return last.filter(keep).orderBy(F.desc_nulls_last("last_modified"), "modelId").offset(max(offset, 0)).limit(max(limit, 0))


def hub_models(raw: DataFrame, ui: str = "https://example.org/models/") -> DataFrame:
    """Basic fields of hub records, with extraction metadata for each."""
    model = F.col("modelId")
    iri = idents.entity_iri(F.lit("HF"), F.lit("Model"), model)
    page = F.concat(F.lit(HUB), model)
    doi = text.doi_uri(F.col("doi")) if "doi" in raw.columns else F.lit(None).cast("string")
    blank = F.lit("")
    method, made = "Parsed_from_HF_dataset", "Generated_from_HF_modelId"  # fixed values: names of the methods
    sources = {
        "identifier": (method, "doi, modelId"), "name": (method, "modelId"), "url": (method, "modelId"), "author": (method, "author"),
        "sharedBy": (method, "author"), "dateCreated": (method, "createdAt"), "dateModified": (method, "last_modified"),
        "datePublished": (method, "createdAt"), "description": (method, "card"), "discussionUrl": (made, "modelId"),
        "archivedAt": (made, "modelId"), "readme": (made, "modelId"), "issueTracker": (made, "modelId"),
    }
    return raw.select(
        model.alias("model_id"),
        F.array_compact(F.array(doi, iri)).alias("identifier"),
        text.short_name(model).alias("name"),
        F.array(page, text.ui_url(iri, idents.GRAPH, ui)).alias("url"),
        F.col("author"),
        F.col("author").alias("sharedBy"),
        F.col("createdAt").alias("dateCreated"),
        F.col("last_modified").alias("dateModified"),
        F.col("createdAt").alias("datePublished"),
        F.nullif(text.strip_front_matter(F.col("card")), blank).alias("description"),
        F.concat(page, F.lit("/discussions")).alias("discussionUrl"),
        page.alias("archivedAt"),
        F.concat(page, F.lit("/blob/main/README.md")).alias("readme"),
        F.concat(page, F.lit("/discussions")).alias("issueTracker"),
        text.size_token(model).alias("parameterCount"),
        _metadata_map({k: metadata(*v) for k, v in sources.items()}).alias("extraction_metadata"),
    )


def first_author(cell: Column) -> Column:
    """The first name in a JSON list of authors, or the cell itself if it is plain text."""
    named = F.get(F.from_json(cell, "array<struct<name: string>>"), 0)["name"]
    plain = F.when(~F.trim(cell).rlike(r"^[\[{]"), F.nullif(F.trim(cell), F.lit("")))
    return F.coalesce(F.nullif(F.trim(named), F.lit("")), plain)


def image_models(raw: DataFrame) -> DataFrame:
    """Basic fields of bio-image records, whose cells are all text."""
    blank = F.lit("")
    cell = lambda c: F.nullif(F.trim(F.col(c)), blank)
    iri = idents.entity_iri(F.lit("AI4Life"), F.lit("Model"), F.col("modelId"))
    archived = F.coalesce(F.get_json_object("archivedAt", "$[0]"), F.when(~F.trim("archivedAt").rlike(r"^[\[{]"), cell("archivedAt")), cell("url"))
    return raw.select(
        F.col("modelId").alias("model_id"),
        F.array_compact(F.array(text.doi_uri(F.col("referencePublication")), iri)).alias("identifier"),
        F.coalesce(cell("name"), F.col("modelId")).alias("name"),
        F.array_compact(F.array(cell("url"))).alias("url"),
        F.coalesce(first_author(F.col("author")), cell("sharedBy")).alias("author"),
        cell("sharedBy").alias("sharedBy"),
        dates.parse_iso(cell("dateCreated")).alias("dateCreated"),
        dates.parse_iso(cell("dateModified")).alias("dateModified"),
        dates.parse_iso(F.coalesce(cell("datePublished"), cell("dateCreated"))).alias("datePublished"),
        cell("intendedUse").alias("description"),
        cell("documentation").alias("abstract"),
        cell("intendedUse").alias("intendedUse"),
        archived.alias("archivedAt"),
        cell("discussionUrl").alias("discussionUrl"),
        cell("issueTracker").alias("issueTracker"),
        F.when(idents.is_http_url(F.col("readme_file")), F.trim("readme_file")).alias("readme"),
    )


def citations(cell: Column, publication: Column) -> Column:
    """array<struct(id, name)>: cited works with an identifier, from a publication address and a JSON or text cell; each once."""
    work = lambda i, n: F.struct(i.alias("id"), n.cast("string").alias("name"))
    none = F.lit(None).cast("string")
    head = F.array(work(text.doi_uri(publication), none))
    listed = F.coalesce(F.from_json(cell, "array<struct<doi: string, text: string>>"), F.array().cast("array<struct<doi: string, text: string>>"))
    given = F.transform(listed, lambda x: work(F.coalesce(text.doi_uri(x["doi"]), text.doi_uri(F.get(text.dois(x["text"]), 0))), F.nullif(F.trim(x["text"]), F.lit(""))))
    plain = F.when(~F.trim(cell).rlike(r"^[\[{]"), F.transform(text.dois(cell), lambda d: work(text.doi_uri(d), none)))
    every = F.filter(F.concat(head, given, F.coalesce(plain, F.array().cast("array<struct<id: string, name: string>>"))), lambda w: w["id"].isNotNull())
    ids = F.transform(every, lambda w: w["id"])
    return F.filter(every, lambda w, i: F.array_position(ids, w["id"]) == i + 1)


#: Kind -> (platform type, name column) of the side entities; one generic normaliser serves them all.
ENTITY_KINDS = {
    "article": "ScholarlyArticle", "license": "CreativeWork", "dataset": "Dataset", "task": "DefinedTerm",
    "keyword": "DefinedTerm", "shared_by": "DefinedTerm", "language": "Language", "source": "WebSite",
}


def side_entities(long: DataFrame, platform: str, details: DataFrame | None = None) -> DataFrame:
    """(kind, value, iri, type, name, description, url, enriched) of every entity once.

    details (kind, value, name, description, url) fills in what is known; what is not is named by its value.
    """
    known = F.create_map(*[F.lit(x) for kv in ENTITY_KINDS.items() for x in kv])
    every = identify.entities(long).withColumn("iri", idents.entity_iri(F.lit(platform), F.col("kind"), F.col("value")))
    every = every.withColumn("type", F.coalesce(F.try_element_at(known, F.col("kind")), F.lit("Thing")))
    if details is None:
        return every.select("kind", "value", "iri", "type", F.col("value").alias("name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("url"), F.lit(False).alias("enriched"))
    more = details.select("kind", "value", "name", "description", "url").dropDuplicates(["kind", "value"]).withColumn("__hit", F.lit(True))
    out = every.join(more, ["kind", "value"], "left")
    return out.select("kind", "value", "iri", "type", F.coalesce("name", "value").alias("name"), "description", "url", F.coalesce("__hit", F.lit(False)).alias("enriched"))


def translation(entities: list[DataFrame]) -> DataFrame:
    """(iri, name): names of all entities; of several records for an IRI the one of the later table counts."""
    parts = [e.select("iri", "name", F.lit(i).alias("__order")) for i, e in enumerate(entities)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.filter(F.col("iri").isNotNull() & F.col("name").isNotNull()).groupBy("iri").agg(F.max_by("name", F.struct("__order", "name")).alias("name"))


#: Link kind -> field of the model that holds its IRIs.
LINK_FIELDS = {"keyword": "keywords", "task": "mlTask", "language": "inLanguage", "dataset": "trainedOn", "base_model": "baseModel"}


def linked_models(models: DataFrame, long: DataFrame, platform: str) -> DataFrame:
    """Models with the IRIs of their entities; of several licences the least IRI counts, so the result is fixed."""
    id_col = long.columns[0]
    links = identify.linked(long, id_col, platform).withColumnRenamed(id_col, "model_id")
    out = models.join(links, "model_id", "left")
    for kind, field in LINK_FIELDS.items():
        out = out.withColumn(field, F.coalesce(F.try_element_at("links", F.lit(kind)), text.empty_strings()))
    return out.withColumn("license", F.array_min(F.try_element_at("links", F.lit("license")))).drop("links")


def search_documents(models: DataFrame, names: DataFrame) -> DataFrame:
    """The index rows: names for IRIs, defaults for what is missing, and the text that is searched."""
    out = records.lookup_arrays(models, "model_id", ["keywords", "mlTask", "inLanguage", "trainedOn"], names, "iri", "name")
    out = records.lookup(out, "license", names, "iri", "name", "license")
    own = idents.first_with_prefix(F.col("identifier"), idents.GRAPH)
    unknown = lambda c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("Unknown"))
    parts = [("Name", F.col("name")), ("Description", F.col("description")), ("Tasks", F.array_join("mlTask", ", ")), ("Keywords", F.array_join("keywords", ", ")), ("Datasets", F.array_join("trainedOn", ", ")), ("License", F.col("license"))]
    return out.select(
        "model_id", F.coalesce(own, F.get("identifier", 0)).alias("iri"), F.col("identifier").alias("db_identifier"), F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("description", F.lit("")).alias("description"), unknown("sharedBy").alias("shared_by"), unknown("license").alias("license"),
        F.col("mlTask").alias("ml_tasks"), "keywords", F.col("trainedOn").alias("datasets"), "inLanguage", "dateCreated", "dateModified",
        text.searchable_text(parts).alias("searchable_text"),
    )


def validate_models(models: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Models that fit the schema, and the others with what is wrong."""
    rules = {
        "identifier": F.size("identifier") > 0,
        "name": F.trim("name") != "",
        "dates": F.coalesce(F.col("dateCreated") <= F.col("dateModified"), F.lit(True)),
    }
    return records.split_valid(models, rules)


def model_detail(docs: DataFrame, edges: DataFrame, iri: str) -> DataFrame:
    """One model's row with its related entities, as a map from relation to the sorted targets."""
    related = edges.filter(F.col("src") == iri).groupBy("rel").agg(F.array_sort(F.collect_set("dst")).alias("targets"))
    as_map = related.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rel", "targets")))).alias("related"))
    return docs.filter(F.col("iri") == iri).orderBy("model_id").limit(1).join(F.broadcast(as_map))  # one row each


def named_states(own: DataFrame, names: DataFrame) -> DataFrame:
    """One model's snapshots at each of its changes, with `moment` and `v_name`, the value by name."""
    states = temporal.history(own, "model_uri").withColumn("v", F.coalesce("value", "value_uri"))
    return records.lookup(states, "v", names, "iri", "name", "v_name")


def history_with_entities(store: DataFrame, names: DataFrame, model: str) -> DataFrame:
    """(moment, predicate_iri, values): a model's states at each of its changes, newest first, values by name."""
    named = named_states(store.filter(F.col("model_uri") == model), names)
    out = named.groupBy("moment", "predicate_iri").agg(F.array_sort(F.collect_set("v_name")).alias("values"))
    return out.orderBy(F.desc("moment"), "predicate_iri")


def usable_runs(runs: DataFrame, run: str, dataset: str, first: int = 1) -> DataFrame:
    """Runs that name a dataset, without the platform's example run."""
    return runs.filter((F.col(run) != first) & F.col(dataset).isNotNull())


def language_names(rows: DataFrame, code: str, known: DataFrame) -> DataFrame:
    """Adds the name of a language code: by two letters, else by three, else by what stands before the hyphen."""
    low = F.lower(code)
    by = lambda key, i: known.select(F.col(key).alias(f"__k{i}"), F.col("name").alias(f"__n{i}")).dropDuplicates([f"__k{i}"])
    out = rows.join(by("alpha_2", 0), low == F.col("__k0"), "left").join(by("alpha_3", 1), low == F.col("__k1"), "left")
    before = F.when(F.contains(low, F.lit("-")), F.substring_index(low, "-", 1))
    out = out.join(by("alpha_2", 2), before == F.col("__k2"), "left")
    return out.withColumn("name", F.coalesce("__n0", "__n1", "__n2")).drop(*[f"__{c}{i}" for i in range(3) for c in "kn"])


def defined_terms(links: DataFrame, column: str, nodes: DataFrame) -> DataFrame:
    """Links whose target is a defined term, with its name in lower case; nodes (id, types, name)."""
    terms = nodes.filter(F.exists("types", lambda t: F.contains(t, F.lit("DefinedTerm")))).select(F.col("id").alias(column), F.lower("name").alias("name"))
    return links.join(terms, column)
