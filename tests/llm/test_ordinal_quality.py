"""The ordinal classifier: gradients, held-out accuracy, edge cases."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import ordinal_quality as oq
from quarry.session import table

SF = "/root/testdata/sf0.01"


def test_shapes():
    assert [oq.shape(w) for w in ("Hello!!", "ERTION!!", "12,345.", "|", "of%%%", "Çéa")] == ["Aa!!", "A!!", "0,0.", "|", "a%%", "Aa"]


def test_fit_orders_three_grades():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 3, 900)
    slots = [rng.integers(100 + 40 * g, 220 + 40 * g, 60).astype(np.int32) for g in grades]
    model = oq.fit(slots[:600], grades[:600], 3)
    assert (np.diff(model.thresholds) > 0).all()
    score = np.array([model.weights[s].sum() / np.sqrt(10) for s in slots[600:]])
    tails = 1 / (1 + np.exp(-(score[:, None] - model.thresholds)))
    assert ((tails > 0.5).sum(axis=1) == grades[600:]).mean() > 0.95
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    seen = labels.filter("doc_id % 3 <> 0")
    model = oq.train(docs, seen, oq.graded_by_labels(), 3)
    got = oq.score(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").toPandas()
    assert (got.kept == (got.quality == 1)).mean() > 0.95
    assert got[got.quality == 1].kept.mean() > 0.97
    clean, toxic = got[(got.quality == 1) & (got.toxic == 0)], got[(got.quality == 1) & (got.toxic == 1)]
    assert clean.expected_grade.mean() > toxic.expected_grade.mean() > got[got.quality == 0].expected_grade.mean()


def test_edge_cases(spark):
    rows = [(1, "good plain words here", "a"), (2, None, "a"), (3, " \n ", "a"), (None, "good words", "a"), (4, "bad! " * 40_000, "a"), (1, "good plain words here", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(1, 2), (4, 0), (4, 0), (None, 1), (3, None), (99, 1)], "doc_id long, grade int")
    model = oq.train(docs, labels, F.col("grade"), 3)
    got = oq.score(docs, model).collect()
    assert len(got) == 6 and all(r.tail_probability == 0 and not r.kept for r in got if r.doc_id in (2, 3))
    kept = oq.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    none = oq.train(docs, labels.limit(0), F.col("grade"), 3)
    assert {(r.doc_id, r.kept) for r in oq.score(docs, none).collect()} >= {(1, True), (2, False), (4, True)}
    assert oq.score(docs.limit(0), model).count() == 0
    assert oq.features(pa.array(["", ""], pa.large_string()))[1].tolist() == [0, 0]


def brute_slots(text):
    """Feature slots by name, one word at a time, in plain Python integers."""
    import re

    import xxhash

    hash64 = lambda kind, value: xxhash.xxh3_64_intdigest(kind + value.encode())
    wrap = (1 << 64) - 1

    def shape(word):
        kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        out = ""
        for c in kinds:
            if not (out.endswith(c) and (c in "Aa0" or out.endswith(c * 2))):
                out += c
        return out

    def pair(a, b, salt):
        mixed = (a * 0x9E3779B97F4A7C15 & wrap) ^ (b + salt & wrap)
        return (mixed * 0xD6E8FEB86659FD93 & wrap) >> 46

    out, before = [], None
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        w, s = hash64(b"w", word), hash64(b"s", shape(word))
        w0, s0 = (hash64(b"w", before), hash64(b"s", shape(before))) if before is not None else (1, 1)
        out += [w >> 46, s >> 46, hash64(b"e", word[-3:].lower()) >> 46, pair(w0, w, 3), pair(s0, s, 5), int(before == word)]
        before = word
    return out


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["", None, " \n", "one", "Hello!! Hello!! 12,345. naïve Çéa", "x" * 70_000 + "A1", "the cat the cat " * 3000, "a\x1cb\x85c d"]
    model = oq.OrdinalModel(rng.normal(0, 1, 1 << 18).astype(np.float32), np.array([-0.5, 0.75]))
    got = {r.doc_id: r for r in oq.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        slots = brute_slots(text)
        assert oq.features(pa.array([text or ""], pa.large_string()))[0].tolist() == slots
        score = sum(float(model.weights[s]) for s in slots) / max(len(slots) / 6, 1) ** 0.5
        tails = [1 / (1 + np.exp(-(score - t))) if slots else 0.0 for t in model.thresholds]
        assert abs(got[i].tail_probability - tails[0]) < 1e-6 and abs(got[i].expected_grade - sum(tails)) < 1e-6
        assert got[i].kept == (tails[0] >= 0.5)


def test_training_rows_are_bounded(spark):
    rows = [(i, f"word{i} " * 50) for i in range(40)] + [(7, f"copy{k} " * 50) for k in range(200)] + [(8, "again " * 50)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1)], "doc_id long, grade int")
    whole = oq.train(docs, labels, F.col("grade"), 2)
    once = oq.train(docs.dropDuplicates(["doc_id", "text"]), labels, F.col("grade"), 2)
    assert (whole.weights == once.weights).all() and (whole.thresholds == once.thresholds).all()
    few = oq.train(docs, labels, F.col("grade"), 2, train_words=500)
    assert 0 < np.count_nonzero(few.weights) < np.count_nonzero(whole.weights) / 3
    assert not oq.train(docs, labels, F.col("grade"), 2, train_words=10).weights.any()


def test_a_text_over_the_budget_takes_nothing_from_others(spark):
    rows = [(i, f"word{i} good{i % 7} " * 20) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, grade int")
    weights = lambda some, **options: oq.train(spark.createDataFrame(some, "doc_id long, text string"), labels, F.col("grade"), 2, **options).weights
    for long in range(2):  # wherever it comes in the hash order
        others = [r for r in rows if r[0] != long]
        got = weights([(long, "much " * 3000), *others], train_words=2000)
        assert np.count_nonzero(got) > 100 and (got == weights(others, train_words=2000)).all()
        assert (weights([(long, "much " * 300), *others], text_words=100) == weights(others, text_words=100)).all()
