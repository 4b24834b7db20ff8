"""From raw records to normalised, linked, named and validated models, on literal rows."""

from datetime import datetime

from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import idents
from quarry.operators import catalogue as cat
from quarry.operators import identify, temporal

D = datetime


def hub_rows(spark):
    card = "---\nlicense: mit\n---\n# A model\n" + "text " * 60
    rows = [
        ("org/a-7B", "org", D(2024, 2, 1), 5, 1, "torch", None, ["dataset:squad", "license:mit", "nlp", "en"], "text-generation", D(2024, 1, 1), card),
        ("org/b", "org", D(2024, 3, 1), 5, 1, None, None, ["license:apache-2.0", "license:mit"], "fill-mask", D(2024, 1, 2), card),
        ("org/c", "org", None, 5, 1, None, None, [], "fill-mask", D(2024, 1, 2), card),
    ]
    return spark.createDataFrame(rows, schemas.RAW_HUB)


def test_extract_page(spark):
    raw = hub_rows(spark)
    newer = raw.filter("modelId = 'org/a-7B'").withColumn("last_modified", F.lit("2024-04-01").cast("timestamp")).withColumn("likes", F.lit(9).cast("long"))
    keep = F.size("tags") > 0
    got = cat.extract_page(raw, newer, keep, limit=5).collect()
    assert [(r.modelId, r.likes) for r in got] == [("org/a-7B", 9), ("org/b", 1)]
    assert [r.modelId for r in cat.extract_page(raw, newer, keep, limit=1, offset=1).collect()] == ["org/b"]
    assert cat.extract_page(raw, newer, keep, limit=0).count() == 0


def test_hub_transform_link_and_index(spark):
    raw = hub_rows(spark)
    models = cat.hub_models(raw)
    long = identify.identify(raw, "modelId", identify.hub_identifiers(languages=["en"], tasks=["text-generation", "fill-mask"]))
    linked = cat.linked_models(models, long, "HF")
    row = linked.filter("model_id = 'org/a-7B'").first()
    assert row.name == "a-7B" and row.parameterCount == "7B" and row.description.startswith("# A model") and row.identifier[0].startswith(idents.GRAPH)
    assert row.archivedAt == "https://huggingface.co/org/a-7B" and row.extraction_metadata["name"].extraction_method == "Parsed_from_HF_dataset"
    assert len(row.trainedOn) == 1 and len(row.mlTask) == 1 and row.baseModel == []
    entities = cat.side_entities(long, "HF", spark.createDataFrame([("license", "mit", "MIT License", "text", "u")], "kind string, value string, name string, description string, url string"))
    by = {(r.kind, r.value): r for r in entities.collect()}
    assert by["license", "mit"].enriched and by["license", "mit"].name == "MIT License" and by["dataset", "squad"].name == "squad"
    assert by["license", "mit"].type == "CreativeWork" and by["language", "en"].type == "Language"
    docs = {r.model_id: r for r in cat.search_documents(linked, cat.translation([entities])).collect()}
    assert docs["org/a-7B"].license == "MIT License" and docs["org/a-7B"].datasets == ["squad"] and docs["org/c"].license == "Unknown"
    assert "Tasks: text-generation." in docs["org/a-7B"].searchable_text
    valid, wrong = cat.validate_models(linked.withColumn("name", F.when(F.col("name") != "b", F.col("name")).otherwise("")))
    assert {r.model_id for r in valid.collect()} == {"org/a-7B", "org/c"} and wrong.first().errors == ["name"]


def test_image_transform(spark):
    fields = [f.name for f in spark.createDataFrame([], schemas.RAW_IMAGE).schema]
    values = dict.fromkeys(fields)
    values |= {
        "modelId": "affable-shark", "author": '[{"name": "Jane Doe"}]', "sharedBy": "Team", "url": "https://bio.org/m", "dateCreated": "2024-01-01T00:00:00Z",
        "intendedUse": "Segmentation of nuclei", "documentation": "# Doc", "readme_file": "no url", "referencePublication": "https://doi.org/10.5281/ZENODO.1", "license": "MIT",
        "keywords": '["nuclei", "unet"]', "citation": '[{"doi": "10.1000/x1", "text": "One"}, {"text": "see 10.1000/x2"}, {"doi": "10.5281/zenodo.1"}, {"text": "none"}]',
    }
    raw = spark.createDataFrame([tuple(values[f] for f in fields)], schemas.RAW_IMAGE)
    r = cat.image_models(raw).first()
    assert (r.name, r.author, r.sharedBy, r.description, r.abstract, r.readme) == ("affable-shark", "Jane Doe", "Team", "Segmentation of nuclei", "# Doc", None)
    assert r.identifier[0] == "https://doi.org/10.5281/zenodo.1" and r.datePublished == D(2024, 1, 1) and r.archivedAt == "https://bio.org/m"
    cited = raw.select(cat.citations(F.col("citation"), F.col("referencePublication")).alias("c")).first().c
    assert [(c.id, c.name) for c in cited] == [
        ("https://doi.org/10.5281/zenodo.1", None), ("https://doi.org/10.1000/x1", "One"), ("https://doi.org/10.1000/x2", "see 10.1000/x2"),
    ]
    found = {(x.kind, x.value) for x in identify.identify(raw, "modelId", identify.image_identifiers()).collect()}
    assert {("keyword", "nuclei"), ("license", "MIT"), ("task", "image-segmentation"), ("shared_by", "Team")} <= found


def test_detail_history_and_schema_table(spark):
    docs = spark.createDataFrame([("a", "i:a")], "model_id string, iri string")
    edges = spark.createDataFrame([("i:a", "task", "t2"), ("i:a", "task", "t1"), ("i:b", "task", "t3")], "src string, rel string, dst string")
    assert cat.model_detail(docs, edges, "i:a").first().related == {"task": ["t1", "t2"]}
    models = spark.createDataFrame([("i:a", "https://x.org/t1")], "uri string, task string")
    empty = "model_uri string, predicate_iri string, value string, value_uri string, extraction_method string, confidence double, notes string, snapshot_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    store, _ = temporal.write_batch(spark.createDataFrame([], empty), temporal.extract_snapshots(models, "uri", {"task": "http://p/task"}), F.lit("2024-01-01").cast("timestamp_ntz"))
    names = spark.createDataFrame([("https://x.org/t1", "Task one")], "iri string, name string")
    assert [r["values"] for r in cat.history_with_entities(store, names, "i:a").collect()] == [["Task one"]]
    fields = {r.property: r for r in schemas.field_table(spark).collect()}
    assert fields["mlTask"].iri == "https://w3id.org/fair4ml/mlTask" and fields["mlTask"].type == "array<string>"
