"""The pipeline against a row-by-row version of its stages, on a small table."""

import random
import re

import corpus_pipeline as cp
import pyarrow as pa
import xxhash
from tokenizers import Tokenizer

from quarry.llm import ordinal_quality as oq
from quarry.llm import quality_rules as qr
from quarry.llm.chunks import vocabulary_path


def brute_fingerprints(text, shingle=5, sets=12):
    """Majority bits of the shingles' hashes and of eleven mixtures of them, in plain integers."""
    wrap = (1 << 64) - 1
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    out = []
    for k in range(sets):
        hashes = []
        for g in grams:
            h = xxhash.xxh64_intdigest(g.encode(), 42)
            if k:
                h = h + k * 0x9E3779B97F4A7C15 & wrap
                h = (h ^ h >> 31) * 0x9E3779B97F4A7C15 & wrap
                h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & wrap
            hashes.append(h)
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


def one_of_each(texts):
    """The least id of every group that links of at most four differing bits in any set connect."""
    fps, root = {i: brute_fingerprints(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and any(bin(x ^ y).count("1") <= 4 for x, y in zip(fps[a], fps[b])):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: t for i, t in texts.items() if find(i) == i}


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(rng.randint(60, 1500))) + "." for _ in range(60)]
    poor = [" ".join(word().upper() + "!!" for _ in range(rng.randint(60, 300))) for _ in range(20)]
    texts = good + poor + good[:5] + [g[:-2] for g in good[5:9]] + ["", None, "too short", "same words here " * 80] + poor[:2]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 60), 0) for i in range(0, 80, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    got = cp.run(spark, str(tmp_path)).collect()

    kept = {i: t or "" for i, t in enumerate(texts)}
    model = oq.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), oq.graded_by_labels(), 3)
    kept = {i: t for i, t in kept.items() if model.tails(pa.array([t], pa.large_string()))[0][0, 0] >= cp.KEEP_PROBABILITY}
    assert {i for i in range(60)} <= set(kept) and not set(range(60, 80)) & set(kept)
    kept = {i: t for i, t in kept.items() if qr.measures(pa.array([t], pa.large_string()), qr.Bands())["kept"][0]}
    kept = one_of_each(kept)
    assert len(kept) < 69
    tokenizer = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    have, fill = {}, {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.length
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert have == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    assert max(fill.values()) <= 1024 and len(fill) <= -(-sum(fill.values()) // 1024) + 1


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.count() == 0
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_stages_take_repeated_and_null_ids(spark):
    rng = random.Random(3)
    a, b = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)) for _ in range(2))
    rows = [(3, a, "en", "s", 1, "x"), (7, a, "en", "s", 1, "x"), (7, b, "en", "s", 1, "x"), (None, b, "en", "s", 1, "x"), (7, b, "en", "s", 1, "x"), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __stays string")
    stages = dict(cp.STAGES)
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 5
    kept = stages["simhash_near_dedup"](spark, kept, "")
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(3, a), (7, b)])
    packed = stages["best_fit_packing"](spark, kept, "").collect()
    assert sorted(r.doc_id for r in packed) == [3, 7]
