"""Column functions against Python's own hashing, JSON and text handling, and against the literal cases of the fixtures."""

import hashlib
import json

from pyspark.sql import functions as F

from quarry.functions import dates, idents, maths, text
from quarry.operators import identify, records


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(v for v, _ in values.values())], ", ".join(f"{k} {t}" for k, (_, t) in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_entity_iri_equals_python_json(spark):
    ids = ["bert-base", "org/näme", 'q"uote', "back\\slash", "tab\there", "nl\n", "🙂 emoji", "\u0001ctl", "\x7f", "漢字", "", "a/b c"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r.id: r.iri for r in df.select("id", idents.entity_iri(F.lit("HF"), F.lit("Model"), F.col("id")).alias("iri")).collect()}
    for i in ids:
        said = json.dumps({"platform": "HF", "type": "Model", "id": i}, sort_keys=True)
        assert got[i] == idents.GRAPH + hashlib.sha256(said.encode()).hexdigest(), i


def test_snapshot_hash_equals_python_json(spark):
    cases = [("p", "v", None, "m", c, n) for c in (0.0, 1.0, 0.9, 0.95, 0.001, 0.0005, 0.00012, 0.00001, 1.5e-7, 0.1 + 0.2) for n in (None, "é")]
    df = spark.createDataFrame(cases, "p string, v string, u string, m string, c double, n string")
    hashed = idents.snapshot_hash(*[F.col(x) for x in "pvumcn"])
    for r in df.select("*", hashed.alias("h")).collect():
        said = json.dumps({"predicate_iri": r.p, "value": r.v, "value_uri": r.u, "extraction_method": r.m, "confidence": r.c, "notes": r.n}, sort_keys=True)
        assert r.h == hashlib.sha256(said.encode()).hexdigest(), (r.c, r.n)


def test_iri_cases(spark):
    cases = {
        "https://example.com/resource": True, "http://example.com/resource": True, "ftp://example.com/file": True, "urn:isbn:0451450523": False,
        "not a url": False, "": False, None: False, "123": False, "https://x.org": False, "https://x.org/": True,
    }
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert {r.v: r.x for r in df.select("v", idents.is_iri(F.col("v")).alias("x")).collect()} == cases


def test_xsd_cases(spark):
    cases = {
        "2020-01-01T00:00:00": "2020-01-01T00:00:00", "2020-01-01T00:00:00Z": "2020-01-01T00:00:00+00:00", "2020-01-01": "2020-01-01T00:00:00",
        "2020-01-01 12:30:45": "2020-01-01T12:30:45", "invalid": None, "": None, None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert {r.v: r.x for r in df.select("v", dates.xsd_datetime(F.col("v")).alias("x")).collect()} == cases


def test_subjects(spark):
    df = spark.createDataFrame(
        [(["https://doi.org/10.1/x", idents.GRAPH + "abc"], "u"), (["x", "https://doi.org/10.1/x"], "u"), (["x"], "https://example.com/test-model"), (None, None)],
        "ids array<string>, url string",
    )
    got = [r.s for r in df.select(idents.mint_subject(F.col("ids"), F.col("url"), F.lit("{}")).alias("s")).collect()]
    sha = lambda s: idents.GRAPH + hashlib.sha256(s.encode()).hexdigest()
    assert got == [idents.GRAPH + "abc", "https://doi.org/10.1/x", sha("https://example.com/test-model"), sha("{}")]


def test_tags_and_labels(spark):
    tags = F.array(*[F.lit(t) for t in ("dataset:squad", "dataset: dataset:x", "arxiv:2505.20506", "base_model:finetune:org/m", "license:apache-2.0", "en", "a b c d e f", "dataset:squad", " ")])
    assert one(spark, text.tag_values(tags, "dataset:")) == ["squad", "x"]
    assert one(spark, text.base_model_tags(tags)) == ["org/m"]
    assert one(spark, text.keyword_tags(tags)) == ["en"]
    assert one(spark, text.arxiv_ids(F.lit("see 2505.20506v2, 2505.20506 and 1234.567"))) == ["2505.20506"]
    assert one(spark, text.size_label(F.lit("org7b/llama-1.5b-chat"))) == "1.5B"
    assert one(spark, text.size_token(F.lit("org/x7B"))) is None and one(spark, text.size_token(F.lit("org/x-7b"))) == "7b"
    for n, said in {999: "999", 1000: "1K", 1500: "1.5K", 109_482_240: "109.48M", 7_000_000_000: "7B", 1_230_000_000_000: "1.23T"}.items():
        assert one(spark, text.format_count(F.lit(n).cast("long"))) == said
    assert [one(spark, text.scaled_number(F.lit(s))) for s in ("12.3K likes", "4", "1,234", "2M", "none")] == [12300, 4, 1234, 2_000_000, None]


def test_cards_and_citations(spark):
    card = "---\nlicense: mit\n---\n# Title"
    assert one(spark, text.strip_front_matter(F.lit(card))) == "# Title" == one(spark, text.strip_front_matter_loose(F.lit(card)))
    assert one(spark, text.strip_front_matter(F.lit("---x---\nbody"))) == "---x---\nbody"
    assert one(spark, text.dois(F.lit("doi:10.1000/XYZ.123. and 10.1000/xyz.123; 10.5/no"))) == ["10.1000/xyz.123"]
    assert one(spark, text.doi_uri(F.lit("https://dx.doi.org/10.1000/AbC"))) == "https://doi.org/10.1000/abc"
    entry = '@misc{a, title = "On {x} things", author={Doe, Jane and Example University}, year = 2021}'
    assert one(spark, text.bibtex_field(F.lit(entry), "year")) == "2021"
    assert one(spark, text.bibtex_authors(text.bibtex_field(F.lit(entry), "author"))) == ["Doe", "Jane", "Example University"]
    assert one(spark, text.keyword_cell(F.lit('["a", " b "]'))) == ["a", "b"] and one(spark, text.keyword_cell(F.lit("a, b ,,a"))) == ["a", "b"]
    assert one(spark, text.tasks_of(F.array(F.lit("x")), F.lit("Nuclei segmentation"), F.lit("denoise"))) == ["image-segmentation"]
    assert one(spark, text.clean_query(F.lit('Show me "BERT" models for the medical domain!'))) == "medical domain"
    assert one(spark, text.quoted_phrases(F.lit('Show me "BERT" models for the medical domain!'))) == ["bert"]
    assert one(spark, text.json_block(F.lit('```json\n{"a": {"b": 1}}\n```'))) == '{"a": {"b": 1}}'


def test_overlay_rules(spark):
    def overlay(description, abstract, said):
        r = one(spark, identify.overlay_description(F.lit(description), F.lit(abstract).cast("string"), F.lit(said)))
        return r.description, r.abstract

    assert overlay("old", None, "new") == ("new", "old")
    assert overlay("same", None, "same ") == ("same ", None)
    assert overlay("old", "kept", "new") == ("new", "kept")
    assert overlay("old", None, "NA") == ("old", None)
    none = F.array().cast("array<string>")
    assert one(spark, identify.overlay_task(none, F.lit("t"))) == ["t"] and one(spark, identify.overlay_task(F.array(F.lit("a")), F.lit("t"))) == ["a"]
    older, newer = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(1)), F.create_map(F.lit("b"), F.lit(2))
    assert one(spark, identify.merge_metadata(older, newer)) == {"a": 1, "b": 2}


def test_identify_hub_records(spark):
    rows = [("org/m-7B", ["dataset:squad", "arxiv:1234.56789", "license:mit", "en", "Text Generation", "nlp"], "text-classification", "torch", "acme")]
    df = spark.createDataFrame(rows, "modelId string, tags array<string>, pipeline_tag string, library_name string, author string")
    kinds = identify.hub_identifiers(languages=["en", "fr"], tasks=["text-generation", "text-classification"])
    got = {(r.kind, r.value) for r in identify.identify(df, "modelId", kinds).collect()}
    assert {("dataset", "squad"), ("license", "mit"), ("language", "en"), ("task", "text-generation"), ("task", "text-classification"), ("shared_by", "acme"), ("model_size", "7B")} <= got
    long = identify.identify(df, "modelId", kinds)
    tags = df.select("modelId", F.explode("tags").alias("tag"))
    left = {r.tag for r in identify.keywords_without(tags, long.filter("kind <> 'keyword'"), "modelId").collect()}
    assert left == {"Text Generation", "nlp"}
    assert identify.linked(long, "modelId", "HF").first().links["dataset"][0].startswith(idents.GRAPH)


def test_quality_filter_template(spark):
    full = "# Model\n" + "word " * 60
    unfilled = "\n".join(records.TEMPLATE_MARKS) + "[More Information Needed]" * 40
    rows = [("t", ["a"], full), ("", ["a"], full), ("t", [], full), ("t", ["a"], "short"), ("t", ["a"], unfilled), (None, None, None)]
    df = spark.createDataFrame(rows, "tag string, tags array<string>, card string")
    keep = records.enough_information(F.col("tag"), F.col("tags"), F.col("card"))
    assert [r.k for r in df.select(keep.alias("k")).collect()] == [True, False, False, False, False, False]


def test_relevance(spark):
    a = lambda *x: F.array(*[F.lit(v) for v in x])
    got = one(spark, maths.relevance(a("t", "u"), a("t"), a("k"), a("k"), F.lit("BERT"), F.lit("bert-base"), F.lit("MIT"), F.lit("Apache-2.0")))
    assert abs(got - (0.2 + 0.25 + 0.1 + 0.05)) < 1e-12
    assert one(spark, maths.cosine(a(1.0, 0.0), a(0.0, 0.0))) is None


def test_epoch_days_beyond_four_digits_have_no_sign(spark):
    seconds = [0, -86400, 253402300799, 253402300800, 518400000000]
    got = [r.d for r in spark.createDataFrame([(s,) for s in seconds], "s long").select(dates.epoch_date(F.col("s")).alias("d")).collect()]
    assert got == ["1970-01-01", "1969-12-31", "9999-12-31", "10000-01-01", "18397-06-11"]
