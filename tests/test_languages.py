"""Language detection against a brute-force version, and on documents that it has not learned from."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import languages

TEXTS = [(1, "the and the", "en"), (2, "le et la", "fr"), (3, "Thé, LE 12", "fr"), (4, None, "en"), (5, "x", None), (6, "die", "de"), (6, "und", "de")]


def brute(learned, texts):
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda t: [p[i : i + 3] for w in words(t) for p in [f" {w} "] for i in range(len(p) - 2)]
    counts = {}
    for _, text, lang in learned:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    counts = {g: c for g, c in counts.items() if c}
    known = len({g for c in counts.values() for g in c}) + 1
    out, by_id = {}, {}
    for i, text, _ in texts:
        by_id.setdefault(i, []).extend(grams(text))
    for i, own in by_id.items():
        if own:
            scores = {g: sum(math.log((c[x] + 0.5) / (sum(c.values()) + 0.5 * known)) for x in own) for g, c in counts.items()}
            total = sum(math.exp(s - max(scores.values())) for s in scores.values())
            out |= {(i, g): math.exp(s - max(scores.values())) / total for g, s in scores.items()}
    return out


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_confidences(spark, monkeypatch, broadcast):
    monkeypatch.setattr(languages, "BROADCAST_ROWS", broadcast)
    rows = spark.createDataFrame(TEXTS, "id long, text string, lang string")
    model = languages.likelihoods(languages.learn(rows, F.col("text"), F.col("lang")))
    asked = [*TEXTS, (7, "quite unknown", None), (8, "", None), (9, "123 ...", None), (10, "le " * 50_000, None)]
    got = languages.confidences(spark.createDataFrame(asked, "id long, text string, lang string"), "id", F.col("text"), model)
    assert {(r.id, r.code): r.confidence for r in got.collect()} == pytest.approx(brute(TEXTS, asked), abs=1e-9)


def test_predictions_are_sure_and_few(spark):
    rows = spark.createDataFrame(TEXTS, "id long, text string, lang string")
    model = languages.likelihoods(languages.learn(rows, F.col("text"), F.col("lang")))
    want = brute(TEXTS, TEXTS)
    for least, most in ((0.75, 5), (0.0, 2)):
        got = [tuple(r) for r in languages.predictions(rows, "id", F.col("text"), model, least, most).select("id", "rank", "code").collect()]
        ranked = []
        for i in {i for i, _ in want}:
            own = sorted((-round(c, 12), g) for (j, g), c in want.items() if j == i and c >= least)
            ranked += [(i, k, g) for k, (_, g) in enumerate(own[:most], 1)]
        assert sorted(got) == sorted(ranked)


def test_without_labels(spark):
    none = spark.createDataFrame([], "id long, text string, lang string")
    model = languages.likelihoods(languages.learn(none, F.col("text"), F.col("lang")))
    assert languages.predictions(none, "id", F.col("text"), model).count() == 0


def test_held_out_documents(spark):
    """Learned from four fifths of the documents, it is right on the others; these have 20 words or more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = languages.likelihoods(languages.learn(docs.filter(fold != 1), F.col("text"), F.col("lang")))
    others = docs.filter((fold == 1) & (F.size(languages.letters(F.col("text"))) >= 20))
    found = languages.predictions(others, "doc_id", F.col("text"), model).filter("rank = 1")
    right = others.join(found, "doc_id", "left").agg(F.avg((F.col("code").eqNullSafe(F.col("lang"))).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).first()
    print(f"held out: {right['n']} documents, {right['right']:.4f} right")
    assert right["n"] > 100 and right["right"] > 0.97


@pytest.mark.parametrize("broadcast", [0, 100_000])
@pytest.mark.parametrize("most", [1, 3, 100])
def test_frequent_words_change_nothing(spark, monkeypatch, broadcast, most):
    """Whichever words are summed once, and whether the n-grams are broadcast or not."""
    monkeypatch.setattr(languages, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(languages, "FREQUENT_WORDS", most)
    rows = spark.createDataFrame(TEXTS, "id long, text string, lang string")
    words = languages.word_counts(rows, F.col("text"), F.col("lang"))
    model = languages.likelihoods(languages.gram_counts(words), words)
    assert model.words.count() == min(most, 8)
    asked = [*TEXTS, (7, "quite unknown", None), (8, "", None), (9, "123 ...", None), (10, "le la und " * 5_000, None)]
    got = languages.confidences(spark.createDataFrame(asked, "id long, text string, lang string"), "id", F.col("text"), model)
    assert {(r.id, r.code): r.confidence for r in got.collect()} == pytest.approx(brute(TEXTS, asked), abs=1e-9)


def test_texts_are_cut_once_to_learn(spark):
    """The model's totals, size and table read the counts, not the texts again."""
    rows = spark.createDataFrame(TEXTS, "id long, text string, lang string")
    model = languages.likelihoods(languages.learn(rows, F.col("text"), F.col("lang")))
    assert "regexp_extract_all" not in model[0]._jdf.queryExecution().optimizedPlan().toString()
