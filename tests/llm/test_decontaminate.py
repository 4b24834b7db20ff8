"""Decontamination against a brute-force version and against the SQL twin."""

import hashlib
import re

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.llm import decontaminate as own

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
ITEMS, DOCS = "item_id string, text string, doc_id int", "doc_id long, text string, spans int, item int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """(doc_id, n_words, hit places, item ids) for each document."""
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item or "")
    sizes = {len(k) for k in windows}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if got := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= got
        yield doc_id, len(w), hit, sorted(found)


def digests(docs, items, window=10):
    return sorted(((i, n, len(h), len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), bool(h)) for i, n, h, f in brute(docs, items, window)), key=str)


def run(spark, docs, items, **options):
    got = own.report(spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS), spark.createDataFrame([(*i, 3) for i in items], ITEMS), **options)
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return docs, items


@pytest.mark.parametrize("part_words", [200_000, 500])
def test_documents(spark, tables, part_words):
    got = run(spark, *tables, part_words=part_words)
    assert got == digests(*tables) and any(r[2] for r in got)


def test_sql(spark, tables):
    documents, benchmark = (duckdb.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))  # noqa: F841
    sql = duckdb.sql(own.report_sql())
    assert sql.columns == COLUMNS and sorted(sql.fetchall(), key=str) == digests(*tables)


ODD_DOCS = [(1, "One two, THREE four five"), (1, "x one two three y"), (None, "two"), (None, "two"), (2, None), (3, ""), (4, "a b a b a b a b c"), (5, "ähm one-two é"), (6, "\x00...")]
ODD_ITEMS = [("i", "one two three"), ("j", "ONE two"), (None, "two"), ("k", None), ("l", ""), ("j", "b a b a b a"), ("m", "b a b a b a"), ("10", "é"), ("9", "é")]


@pytest.mark.parametrize("options", [{}, {"window": 4}, {"window": 1}, {"window": 3, "part_words": 2}])
def test_odd_rows(spark, options):
    assert run(spark, ODD_DOCS, ODD_ITEMS, **options) == digests(ODD_DOCS, ODD_ITEMS, options.get("window", 10))


def test_empty_tables(spark):
    assert run(spark, [], ODD_ITEMS) == [] and run(spark, ODD_DOCS, []) == digests(ODD_DOCS, [])


def test_long_texts(spark):
    item = " ".join(f"w{i % 700}" for i in range(30_000))
    docs = [(1, item + " end"), (2, "w0 " * 5_000), (3, " ".join(f"w{i % 699}" for i in range(20_000)))]
    assert run(spark, docs, [("a", item), ("b", "w0 w0")], part_words=9_000) == digests(docs, [("a", item), ("b", "w0 w0")])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aBc .ß", max_size=40), max_size=8), st.lists(st.text(alphabet="aBc -ß", max_size=20), min_size=1, max_size=6))
def test_any_texts(spark, docs, items):
    docs, items = list(enumerate(docs)), [(str(i), t) for i, t in enumerate(items)]
    assert run(spark, docs, items, window=3) == digests(docs, items, 3)


@pytest.mark.parametrize("part_words", [200_000, 4])
def test_clean(spark, part_words):
    docs = spark.createDataFrame([(1, "Keep this. One, two three! And this", 7, 8), (2, "one two three", 7, 8), (3, None, 7, 8), (4, "é one two é three", 7, 8), (4, "é one two é three", 7, 8)], DOCS)
    items = spark.createDataFrame([("a", "one two three", 1), ("b", "other things here", 1), ("c", "é", 1)], ITEMS)
    got = own.clean(docs, items, part_words=part_words)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "Keep this. ! And this", 7, 8), (3, None, 7, 8), (4, " one two  three", 7, 8), (4, " one two  three", 7, 8)]
    kept = own.clean(docs, items, longest=1, coverage=1.0, part_words=part_words).filter("doc_id IN (2, 4)").collect()
    assert sorted(r.text for r in kept) == ["", "é one two é three", "é one two é three"]
