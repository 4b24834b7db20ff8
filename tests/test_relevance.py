"""The relevance index against plain Python, its plans, and fuzzy look-up against row-wise distances."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import relevance
from quarry.session import scratch

DOCS = [(1, "Red widget, other", "A-b"), (2, "the red RED widget", None), (3, None, "red"), (4, "", ""), (5, "naïve widgets in the other", "x"), (5, "more red", "x")]


@pytest.fixture(scope="module")
def index(spark):
    return relevance.build(spark.createDataFrame(DOCS, "id long, name string, tags string"), "id", {"name": F.col("name"), "keywords": F.col("tags")}, scratch(spark, "test-index"))


def brute(query, cross, best, weight):
    found = {f: {} for f in ("name", "keywords")}
    for i, *texts in DOCS:
        for f, text in zip(found, texts):
            if words := re.findall(r"[^\W_]+", (text or "").lower()):
                found[f].setdefault(i, Counter()).update(words)
    n = {f: len(d) for f, d in found.items()}
    average = {f: sum(sum(c.values()) for c in d.values()) / n[f] for f, d in found.items()}
    df = lambda t, f: sum(t in c for c in found[f].values())
    idf = lambda n, d: math.log(1 + (n - d + 0.5) / (d + 0.5))

    def part(t, f, i):
        c = found[f].get(i, Counter())
        return c[t] / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / average[f])) if c[t] else 0.0

    out = {}
    for i in {d[0] for d in DOCS}:
        score = 0.0
        for phrase in relevance.phrases_of(query):
            words = relevance.query_words(phrase)
            for t in words:
                own = [f for f in found if df(t, f)]
                if own:
                    most = max(df(t, f) for f in own)
                    score += max(cross[f] * idf(max(max(n[f] for f in own), most), most) * part(t, f, i) for f in cross)
            score += weight * max(best[f] * sum(idf(n[f], df(t, f)) * part(t, f, i) for t in words if df(t, f)) for f in best)
        if score:
            out[i] = round(score, 6)
    return out


@pytest.mark.parametrize("query", ["red widget", "The_other red.x", "nothing", "naïve"])
def test_scores(index, query):
    cross, best = {"name": 2.0, "keywords": 5.0}, {"name": 2.0, "keywords": 4.0}
    got = {r.doc: round(r.score, 6) for r in relevance.scores(index, relevance.phrases_of(query), cross, best).collect()}
    assert got == pytest.approx(brute(query, cross, best, 0.8), abs=2e-6)


def test_whole_words_only(index):
    """`the` is not found inside `other`."""
    assert {r.doc for r in relevance.scores(index, ["the"], {}, {"name": 1.0}).collect()} == {2, 5}
    assert relevance.scores(index, ["..."], {}, {"name": 1.0}).count() == 0


def test_top_breaks_ties_by_id(spark):
    scored = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 2.0), (1, 0.0)], "doc long, score double")
    assert [r.doc for r in relevance.top([scored.filter("score > 0")], 2).collect()] == [2, 1]
    assert [r.doc for r in relevance.top([scored, scored], 2, 2).collect()] == [3]


def test_plan_reads_postings_by_term(index):
    plan = relevance.scores(index, ["red"], {}, {"name": 1.0})._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(term", plan) and "NestedLoop" not in plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_terms(spark, index):
    words = ["wigdet", "rde", "te", "thhe", "othre", "naive", "widgetss", "", "zzzzzzz"]
    terms = {t for d in DOCS for f in d[1:] for t in re.findall(r"[^\W_]+", (f or "").lower())}
    allowed = lambda w: 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2
    want = {(w, t, distance(w, t)) for w in words for t in terms if distance(w, t) <= allowed(w)}
    found = relevance.fuzzy_terms(spark.createDataFrame([(w,) for w in words], "word string"), index)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 4
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()


def test_fuzzy_scores(index):
    got = {r.doc: r.score for r in relevance.fuzzy_scores(index, "Wigdet", {"name": 3.0}).collect()}
    assert set(got) == {1, 2, 5} - ({5} if distance("wigdet", "widgets") > 2 else set())
    assert relevance.fuzzy_scores(index, " .", {"name": 3.0}).count() == 0


def test_phrases():
    assert relevance.phrases_of("Big_red fox") == ["Big red", "red fox", "fox big", "big red", "Big_red fox"]
    assert relevance.phrases_of("one") == ["one one", "one"] and relevance.phrases_of("") == []


def test_fuzzy_parts_are_few_and_lose_no_pair(spark, tmp_path):
    """Terms of all lengths around where segments begin; a long term has three parts, not the square of its length."""
    rng = random.Random(7)
    base = ["".join(rng.choices("abé", k=n)) for n in (1, 2, 3, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 10, 13, 40)]

    def edited(w):
        for _ in range(rng.randint(0, 3)):
            at, kind = rng.randint(0, len(w)), rng.randrange(3)
            w = w[:at] + rng.choice("abé") * (kind < 2) + w[at + (kind > 0) :]
        return w

    terms = sorted({t for w in base for t in (w, *(edited(w) for _ in range(25))) if t} | {"x" * 300})
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "id long, name string")
    index = relevance.build(docs, "id", {"name": F.col("name")}, str(tmp_path / "i"))
    assert index.deletions.filter("length(term) > 6").groupBy("term").count().filter("count > 3").count() == 0

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    most = lambda w: 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2
    want = {(a, b, distance(a, b)) for a in terms for b in terms if abs(len(a) - len(b)) <= 2 and distance(a, b) <= most(a)}
    got = relevance.fuzzy_terms(spark.createDataFrame([(t,) for t in terms], "word string"), index).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_repeated_ids_are_one_document(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a"), (2, "a"), (None, "b"), (None, "c")], "id long, name string")
    index = relevance.build(docs, "id", {"name": F.col("name")}, str(tmp_path / "i"))
    assert {(r.doc, r.term, r.tf, r.len) for r in index.postings.collect()} == {(1, "a", 2, 3), (1, "b", 1, 3), (2, "a", 1, 1)} | {(None, "b", 1, 2), (None, "c", 1, 2)}
