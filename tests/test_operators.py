"""Temporal store, graph, cards, sources and streams on literal rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarry.operators import cards, fields, graph, records, temporal, triples, versions
from quarry.sources import readers, writers
from quarry.streaming import incremental

STORE = "model_uri string, predicate_iri string, value string, value_uri string, extraction_method string, confidence double, notes string, snapshot_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz"
P = {"name": "http://x.org/name", "trained": "http://x.org/trainedOn"}
META = "map<string, struct<extraction_method: string, confidence: double, notes: string>>"


def models(spark, rows):
    return spark.createDataFrame(rows, f"uri string, name string, trained array<string>, meta {META}")


def run(spark, batches):
    store, counts = spark.createDataFrame([], STORE), []
    for day, rows in batches:
        snap = temporal.extract_snapshots(models(spark, rows), "uri", P, "meta")
        store, fresh = temporal.write_batch(store, snap, F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz"))
        counts.append(fresh.count())
    return store, counts


def state(store, moment):
    t = F.lit(moment).cast("timestamp_ntz")
    return {(r.model_uri, r.predicate_iri.rsplit("/", 1)[1]): r["values"] for r in temporal.reconstruct(store, t).collect()}


V1 = ("m", "V1", ["https://d.org/1"], {"name": ("readme", 0.9, None)})
V2 = ("m", "V2", ["https://d.org/1", "https://d.org/2"], {"name": ("readme", 0.95, None)})


def test_versions_over_time(spark):
    store, counts = run(spark, [(1, [V1]), (2, [V1]), (3, [V2]), (4, [("m", "V2", None, V2[3])]), (5, [V1])])
    assert counts == [2, 0, 2, 0, 2]
    assert state(store, "2023-12-31 00:00:00") == {}
    assert state(store, "2024-01-02 12:00:00") == {("m", "name"): ["V1"], ("m", "trainedOn"): ["https://d.org/1"]}
    assert state(store, "2024-01-03 00:00:00")[("m", "name")] == ["V2"]  # the end is exclusive
    assert state(store, "2024-01-03 00:00:00")[("m", "trainedOn")] == ["https://d.org/1", "https://d.org/2"]
    assert ("m", "trainedOn") not in state(store, "2024-01-04 00:00:00")
    assert state(store, "2024-01-09 00:00:00")[("m", "name")] == ["V1"]  # it came back, with a new interval
    rows = store.collect()
    assert all(r.valid_to is None or r.valid_from < r.valid_to for r in rows)
    open_keys = [(r.model_uri, r.snapshot_hash) for r in rows if r.valid_to is None]
    assert len(open_keys) == len(set(open_keys))


def test_metadata_change_and_other_models(spark):
    changed = ("m", "V1", ["https://d.org/1"], {"name": ("readme", 0.5, "checked")})
    other = ("n", "N", None, None)
    store, counts = run(spark, [(1, [V1, other]), (2, [changed])])
    assert counts == [3, 1]
    assert state(store, "2024-01-02 00:00:00")[("n", "name")] == ["N"]
    meta = {r.predicate_iri: r for r in temporal.current_metadata(store).filter("model_uri = 'm'").collect()}
    assert meta[P["name"]].confidence == 0.5 and meta[P["trained"]].extraction_method == "unknown"
    both = temporal.at_time(store, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), inclusive_end=True)
    assert both.filter(F.col("predicate_iri") == P["name"]).filter("model_uri = 'm'").count() == 2


def test_triples(spark):
    df = spark.createDataFrame([("s1", "n", ["https://a.org/x", "text", None, ""], None), ("s2", "", [], "u")], "s string, name string, many array<string>, one string")
    got = {tuple(r) for r in triples.to_triples(df, "s", {"name": "p:n", "many": "p:m", "one": "p:o"}).collect()}
    assert got == {("s1", "p:n", "n", False), ("s1", "p:m", "https://a.org/x", True), ("s1", "p:m", "text", False), ("s2", "p:o", "u", False)}
    lines = {r.value for r in triples.n_triples(spark.createDataFrame([("a", "b", 'x "y"\n', False)], "s string, p string, o string, o_is_iri boolean")).collect()}
    assert lines == {'<a> <b> "x \\"y\\"\\n" .'}


def test_graph_cycles_and_paging(spark):
    edges = spark.createDataFrame([("a", "r", "b"), ("b", "r", "c"), ("c", "r", "a")], "src string, rel string, dst string")
    ids = spark.createDataFrame([("a",)], "id string")
    assert graph.neighbourhood(edges, ids, depth=3).count() == 3
    assert graph.neighbourhood(edges, ids, direction="both").count() == 2
    parents = edges.select(F.col("src").alias("id"), F.col("dst").alias("parent"))
    got = {(r.ancestor, r.depth) for r in graph.ancestors(parents, ids, rounds=9).collect()}
    assert got == {("b", 1), ("c", 2), ("a", 3)}
    rows = spark.range(7).select(F.col("id").alias("k"))
    last = graph.page_after(rows, "k", 3, 3).collect()
    assert [r.k for r in last] == [4, 5, 6] and not any(r.has_more for r in last)
    assert all(r.has_more for r in graph.page_after(rows, "k", None, 3).collect())


def test_markdown_chunks(spark):
    long = "many words " * 15
    card = f"before\n\n# One\n\nshort a\n\nshort b\n\n{long}\n\n```py\nx = 1\n```\n\n## Two\n\n| a | b |\n| 1 | 2 |\n\ntail\n\n# Three\nend"
    rows = cards.chunks(spark.createDataFrame([(1, card), (2, None), (3, "")], "id long, card string"), "id", "card").collect()
    by = {}
    for r in rows:
        by.setdefault(r.type, []).append(r)
    ids = {r.htext: r.chunk_id for r in by["section"]}
    assert set(ids) == {"One", "Two", "Three"} and len(rows) == len({r.chunk_id for r in rows})
    two = next(r for r in by["section"] if r.htext == "Two")
    assert two.parent == ids["One"] and two.phtext == "One" and "tail" in two.text
    one = next(r for r in by["section"] if r.htext == "One")
    assert "tail" in one.text and "end" not in one.text and one.parent is None
    assert [r.text for r in by["orphan"]] == ["before"]
    assert [r.text for r in by["code"]] == ["x = 1"] and by["table"][0].text.startswith("| a | b |")
    texts = {r.phtext: r.text for r in by["granular"]}
    assert texts["One"] == f"short a short b {long.strip()}" and texts["Two"] == "tail" and texts["Three"] == "end"


def test_sources_and_sinks(spark, tmp_path):
    schema = "modelId string, likes long"
    (tmp_path / "a.json").write_text(json.dumps([{"modelId": "x", "likes": 1}, {"modelId": "y"}], indent=1))
    (tmp_path / "b.json").write_text('{"modelId": "x", "likes": 1}\n{"modelId": "y"}\n')
    for name in ("a", "b"):
        assert {tuple(r) for r in readers.read_records(spark, f"{tmp_path}/{name}.json", schema).collect()} == {("x", 1), ("y", None)}
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError):
        readers.read_records(spark, f"{tmp_path}/empty.json", schema)
    assert readers.read_entities(spark, f"{tmp_path}/none.json", schema).count() == 0 == readers.read_entities(spark, None, schema).count()
    (tmp_path / "ids.txt").write_text("a\n\n  b \n# c\n")
    assert [r.id for r in readers.read_lines(spark, f"{tmp_path}/ids.txt").collect()] == ["a", "b"]
    (tmp_path / "k.csv").write_text('keyword,definition,aliases\nnlp,language,"[""x"", ""y""]"\nbad,,oops\n')
    assert {r.keyword: r.aliases for r in readers.read_keywords(spark, f"{tmp_path}/k.csv").collect()} == {"nlp": ["x", "y"], "bad": []}
    df = spark.createDataFrame([("a", 1), ("b", -1)], "k string, v long")
    valid, wrong = records.split_valid(df, {"positive": F.col("v") > 0})
    writers.write_split(valid, wrong, f"{tmp_path}/out")
    assert [r.k for r in spark.read.json(f"{tmp_path}/out/records").collect()] == ["a"]
    assert [r.errors for r in spark.read.json(f"{tmp_path}/out/errors").collect()] == [["positive"]]
    merged = writers.upsert(df, spark.createDataFrame([("b", 5), ("c", 6)], "k string, v long"), ["k"])
    assert {tuple(r) for r in merged.collect()} == {("a", 1), ("b", 5), ("c", 6)}
    ids = spark.createDataFrame([("a",), ("z",)], "k string")
    assert {(r.k, r.enriched) for r in records.left_with_stub(ids, df, "k").collect()} == {("a", True), ("z", False)}


def test_streams(spark, tmp_path):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    schema = "k string, v string, at timestamp"
    for i, rows in enumerate([[("a", "x", t(1)), ("a", "x", t(2)), ("b", "y", t(1))], [("a", "z", t(3)), ("b", "y", t(4)), ("a", "old", t(2))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    once = incremental.recent_records(stream, "k", "at")
    q = once.writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.k for r in spark.sql("select * from once").collect()) == ["a", "b"]


def test_bindings_are_distinct_without_a_distinct_of_the_join(spark):
    rows = [("a", "p", "x", True), ("a", "p", "x", False), ("b", "p", "x", True), ("b", "q", "x", True), ("c", "p", "y", True), ("a", "p", "a", True)]
    store = spark.createDataFrame(rows, "s string, p string, o string, o_is_iri boolean")
    found = fields.match_patterns(store, [("?a", "p", "?n"), ("?b", "p", "?n")])
    assert sorted((r.a, r.b, r.n) for r in found.collect()) == [("a", "a", "a"), ("a", "a", "x"), ("a", "b", "x"), ("b", "a", "x"), ("b", "b", "x"), ("c", "c", "y")]
    assert [tuple(r) for r in fields.match_patterns(store, [("?a", "p", "?a")]).collect()] == [("a",)]
    top = found._jdf.queryExecution().optimizedPlan()
    while top.nodeName() == "Project":
        top = top.children().head()
    assert top.nodeName() == "Join"


def test_few_kinds_of_extraction_are_broadcast(spark, tmp_path):
    own = spark.range(20).selectExpr("id", "'s' || id AS subject", "'p' AS predicate", "'o' AS object")
    ranges = spark.range(20).selectExpr("id AS triplet_id", "0 AS use_start", "1 AS use_end", "false AS deprecated", "id % 2 AS extraction_info_id")
    info = spark.createDataFrame([(0, "parsed", 1.0), (1, "inferred", 0.5)], "id long, method_description string, extraction_confidence double")
    found = versions.triples_with_extraction(own, ranges, info)
    assert "hashpartitioning(extraction_info_id" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter("method_description = 'inferred'").count() == 10
