"""The registered queries over whole tables against direct uses of the libraries. QUARRY_SF picks the tables."""

import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from test_interpolated_lm import WORD, lower
from test_packing import check_patterns
from test_quality_rules import brute as brute_rules
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from quarry.llm.chunks import vocabulary_path
from quarry.llm.queries import QUERIES

SF = f"/root/testdata/{os.environ.get('QUARRY_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def tokens(name, texts):
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.encode_special_tokens = True
    return {i: np.array(e.ids + [2], "<u4") for i, e in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False))}


def test_op1(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    got = rows(spark, "op1_sentence_pieces")
    assert len(got) == len(texts)
    for r in got:
        ids = model.encode(texts[r.doc_id], add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids)))


def test_op2(spark, texts):
    got = {r.doc_id: r for r in rows(spark, "op2_ordinal_quality")}
    assert set(got) == set(texts)
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert np.mean([got[r.doc_id].kept == (r.quality == 1) for r in labels]) > 0.95


def test_op3_base(spark, texts):
    docs = {i: [*WORD.findall(lower(t)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    counts = Counter(w for i, d in docs.items() if not held[i] for w in d)
    n, v = sum(counts.values()), len(counts)
    got = rows(spark, "op3_interpolated_lm")
    assert len(got) == len(texts)
    for r in got:
        d = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(d), sum(counts[w] > 0 for w in d), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in d), rel=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_op4(spark, texts):
    got = rows(spark, "op4_media_columns")
    assert len(got) == len(texts)
    for r in got:
        b = texts[r.doc_id].encode()
        payload = b + b"\xff" * ((-len(b)) % 576 if b else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))


def test_op6(spark, texts):
    ids = tokens("byte_bpe_50k.json", texts)
    got = rows(spark, "op6_best_fit_packing")
    seen, fill = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in seen.items():
        end = 0
        for k, (piece, start, length) in enumerate(sorted(parts)):
            assert piece == k and start == end and (length == 1024 or k == 0)
            end += length
        assert end == len(ids[i])
    assert set(seen) == set(texts)
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(fill) == check_patterns([r.length for r in got], 1024)


def test_op7(spark, texts):
    got = rows(spark, "op7_quality_rules")
    assert len(got) == len(texts)
    short = {i for i, t in texts.items() if len(t) < 20_000}
    for r in got:
        if r.doc_id in short:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(texts[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert all(r.kept for r in clean)


def test_op8(spark, texts):
    ids = tokens("word_bpe_49k.json", texts)
    start = 0
    for r in sorted(rows(spark, "op8_token_store"), key=lambda r: r.doc_id):
        own = ids.pop(r.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert not ids


def test_op10(spark, texts):
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(list(fps), list(fps.values()))
    got = rows(spark, "op10_simhash_near_dedup")
    assert len(got) == len(texts)
    for r in got:
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", want[r.doc_id])
