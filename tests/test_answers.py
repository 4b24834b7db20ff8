"""Composed answers on literal cases, exact medians of uneven values."""

import random
import statistics

from pyspark.sql import functions as F

from quarry.operators import answers, facets

EDGES = [("m1", "license", "mit"), ("m2", "license", "mit"), ("m3", "license", "mit"), ("mit", "used_by", "m2"), ("x", "license", "mit"), ("m1", "task", "t2"), ("m1", "task", "t1"), ("m1", "other", "o"), ("m3", "task", "t1"), ("m3", "task", "t1")]
NODES = [("m1", "Model", "zeta"), ("m2", "Model", None), ("m3", "Model", "alpha"), ("x", "Dataset", "x"), ("mit", "License", "MIT"), ("b", "License", "mit")]


def graph_of(spark):
    return spark.createDataFrame(EDGES, "src string, rel string, dst string"), spark.createDataFrame(NODES, "id string, label string, name string")


def test_models_of_an_entity(spark):
    edges, nodes = graph_of(spark)
    mit = nodes.filter("id = 'mit'")
    every = answers.models_of(edges, nodes, mit, "Model", ["license", "task"], -1, -1).collect()
    assert [(r.model, r.rel, r.total) for r in every] == [("m3", "license", 3), ("m2", "license", 3), ("m1", "license", 3)]
    assert [r.relations for r in every] == [{"license": ["mit"], "task": ["t1"]}, {"license": ["mit"]}, {"license": ["mit"], "task": ["t1", "t2"]}]
    part = answers.models_of(edges, nodes, mit, "Model", ["task"], 1, 1).collect()
    assert [(r.model, r.name, r.total, r.relations) for r in part] == [("m2", None, 3, {})]  # without cards, it stays
    assert answers.models_of(edges, nodes, mit, "Model", ["task"], 0, 0).count() == 0
    assert answers.models_of(edges.limit(0), nodes, mit, "Model", ["task"]).count() == 0


def test_entities_by_name(spark):
    _, nodes = graph_of(spark)
    assert [r.id for r in answers.entity_named(nodes, "Mit").collect()] == ["b"]  # the least id of two
    assert answers.entity_named(nodes, "none").count() == 0


def test_related_answer_filters_the_best_of_each_category(spark):
    docs = spark.createDataFrame(
        [(1, "a", ["x", "y"], "mit"), (2, "a", ["x", "y"], "mit"), (3, "b", ["y", "y"], "gpl"), (4, "b", ["y"], "mit"), (5, "a", None, None), (6, None, [], "mit")],
        "id long, author string, tags array<string>, license string",
    )
    rules = {"author": lambda ref: (F.col("author") == ref["author"]).cast("int"), "tags": lambda ref: F.size(F.array_intersect("tags", ref["tags"]))}
    found = answers.related_answer(docs, docs.filter("id = 1"), "id", rules, {"license": ["mit"]}, ["tags"], most=2)
    got = {tuple(r) for r in found.collect()}
    # category tags has 2 and 3 before the filter, so 4 is not in it; 5 has no license
    assert got == {("model", "author", None, "2", 1), ("model", "tags", None, "2", 1), ("total", None, None, None, 2)} | {("facet", c, "tags", v, 1) for c in ("author", "tags") for v in "xy"}
    assert answers.related_answer(docs, docs.limit(0), "id", rules).count() == 0
    window = answers.related_answer(docs, docs.filter("id = 1"), "id", rules)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in window  # each task keeps the best before the shuffle


def test_exact_medians_whatever_the_values(spark):
    rng = random.Random(5)
    groups = {
        "outlier": [rng.gauss(0, 1) for _ in range(3000)] + [1e300, -1e300],
        "ties": [7.0] * 900 + [rng.random() for _ in range(901)],
        "same": [3.0] * 500,
        "two": [1.0, 2.0],
        "one": [4.5],
        "skewed": [rng.random() ** 9 for _ in range(2001)],
        None: [1.0, 5.0, 9.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("outlier", None), ("empty", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = {k: statistics.median(v) for k, v in groups.items()}
    assert {r.k: r.median for r in facets.exact_medians(df, "k", "v").collect()} == want
    assert {r.k: r.median for r in facets.exact_medians(df, "k", "v", cuts=(0.999,)).collect()} == want  # cuts only choose ranges
    assert facets.exact_medians(df.limit(0), "k", "v").count() == 0
