"""The interpolated model against a plain dictionary version, and against the base scores on held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import interpolated_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, orders, rounds):
    docs = []
    for i, t in rows:
        fold = zlib.crc32(("" if i is None else str(i)).encode()) % 5
        docs.append((i, fold, [*WORD.findall(lower(t or "")), None]))

    def count(use):
        grams = [Counter() for _ in range(orders + 1)]
        for _, fold, toks in docs:
            if use(fold):
                for k in range(len(toks)):
                    for n in range(1, orders + 1):
                        padded = ["<b>"] * (orders - 1) + toks
                        grams[n][tuple(padded[k + orders - n : k + orders])] += 1
        return grams, sum(len(t) for _, f, t in docs if use(f)), sum(use(f) for _, f, _ in docs)

    train, kept = count(lambda f: f != 1), count(lambda f: f not in (0, 1))
    vocab = len(train[0][1])
    floor = 1 / (vocab + 1)

    def parts(model, toks, k):
        grams, n_tokens, n_docs = model
        padded = ["<b>"] * (orders - 1) + toks
        out, bucket = [floor, grams[1][(toks[k],)] / max(n_tokens, 1)], 0
        for n in range(2, orders + 1):
            context = grams[n - 1][tuple(padded[k + orders - n : k + orders - 1])] if k else n_docs
            out.append(grams[n][tuple(padded[k + orders - n : k + orders])] / context if context else 0.0)
            bucket = bucket * 16 + min(context.bit_length(), 15)
        return out, bucket

    weights = lm.first_weights(orders)
    for _ in range(rounds):
        gained = lm.first_weights(orders)
        for _, fold, toks in docs:
            if fold == 0:
                for k in range(len(toks)):
                    p, b = parts(kept, toks, k)
                    s = [x * w for x, w in zip(p, weights[b])]
                    gained[b] += [x / max(sum(s), 1e-300) for x in s]
        weights = gained / gained.sum(axis=1, keepdims=True)
    out = []
    for i, fold, toks in docs:
        base = sum(math.log10((train[0][1][(t,)] + 0.5) / (train[1] + 0.5 * (vocab + 1))) for t in toks)
        score = sum(math.log10(sum(x * w for x, w in zip(p, weights[b]))) for p, b in (parts(train, toks, k) for k in range(len(toks))))
        out.append((i, fold == 1, len(toks), sum(train[0][1][(t,)] > 0 for t in toks), train[1], base, score))
    return out


@pytest.mark.parametrize("orders,block", [(2, 1 << 20), (3, 700)])
def test_scores_equal_brute_force(spark, orders, block):
    rng = random.Random(orders)
    text = lambda: " ".join(rng.choice(["The", "the", "cat", "dog", "sat", "on", "a", "mat.", "É", "x" * rng.randint(1, 9)]) for _ in range(rng.randint(0, 40)))
    rows = [(i, text()) for i in range(60)] + [(60, None), (61, " \n"), (None, "the cat"), (3, "the dog sat"), (62, "the cat " * 3000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    got = lm.score_texts(docs, orders=orders, rounds=3, block_bytes=block, tokens_per_bucket=400).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    want = sorted(brute(rows, orders, 3), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_a_distribution_and_edge_tables(spark):
    weights = lm.first_weights(3)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0].tolist() == [0.5, 0.5, 0, 0]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_texts(docs).count() == 0
    lone = spark.createDataFrame([(i, "only held out") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    for r in lm.score_texts(lone, rounds=1).collect():
        assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == pytest.approx(0) and math.isfinite(r.score)


def test_better_than_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lm.score_texts(docs).filter("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()
