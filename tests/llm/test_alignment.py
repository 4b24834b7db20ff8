"""Alignment against a brute-force version with the libraries themselves."""

import hashlib
from bisect import bisect_right
from collections import Counter

import pytest
import sentencepiece
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import alignment as own
from quarry.llm.chunks import vocabulary_path

SF = "/root/testdata/sf0.001"
A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = bytes_to_letters()
    entries = {i: bytes(letters[c] for c in s) for s, i in a.get_vocab().items() if s != "<|endoftext|>"}
    pieces = [bytes.fromhex(b.id_to_piece(i)[3:5]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids, entries), (lambda t: b.encode(t), pieces)


def bytes_to_letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def groups(text, sides):
    """[(A ids, B ids)] of a text."""
    if not text:
        return []
    runs = []
    for encode, entries in sides:
        ids = encode(text)
        if b"".join(entries[i] for i in ids) != (" " + text).encode():
            return []
        ends, at = [], 0
        for i in ids:
            at += len(entries[i])
            ends.append(at)
        runs.append((ends, ids))
    cuts = sorted(set(runs[0][0]) & set(runs[1][0]))
    split = [[bisect_right(ends, c) for c in cuts] for ends, _ in runs]
    return [tuple(ids[at[k - 1] if k else 0 : at[k]] for (_, ids), at in zip(runs, split)) for k in range(len(cuts))]


def brute(docs, sides):
    found = [(i, groups(t, sides)) for i, t in docs]
    links = [Counter((a, b) for g in own for a in g[0] for b in g[1]) for _, own in found]
    count = Counter(pair for x in links for pair in x)
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    for (i, own), x in zip(found, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        yield (
            i, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(x.values()),
            sum(n for p, n in x.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in x.items()), hashlib.sha256(spelled.encode()).hexdigest() if own else "",
        )


def run(spark, docs, **options):
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, pair int, block string")
    return sorted((tuple(r[c] for c in COLUMNS) for r in own.align(rows, A, B, **options).collect()), key=str)


def test_documents(spark, sides):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:80]
    assert run(spark, docs, block_links=20_000, blocks_per_group=3) == sorted(brute(docs, sides), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<unk></s><|endoftext|> <0x41>"), (None, "the end"), (None, "the end"), (7, "  a\tb\n\n c  "),
    (8, "\x00\x01​"), (9, "naïve \U0001f600\U0001f600 日本語テキスト"), (10, "supercalifragilistic 1234567 !!!???"), (11, "\n"), (12, "a b"),
]


def test_odd_rows(spark, sides):
    want = sorted(brute(ODD, sides), key=str)
    assert run(spark, ODD) == want
    assert run(spark, ODD, block_links=1, blocks_per_group=1) == want
    assert run(spark, []) == []


def test_crowded_groups(spark, sides, monkeypatch):
    """Groups whose ids are paired by distinct ids give the same."""
    aligner = own.Aligner(A, B)
    import numpy as np
    import pyarrow as pa

    text = "日本語テキスト" * 40 + " " + "xqzjv" * 60 + " of the same"
    aligned = own.Aligned(aligner, pa.array([text, "of the same"], pa.large_string()))
    totals = []
    for limit in (4096, 1, 0):
        monkeypatch.setattr(own, "_CROWDED", limit)
        got = Counter()
        for keys, counts in aligned.links(0):
            for k, c in zip(keys.tolist(), counts.tolist()):
                got[k] += c
        totals.append(got)
    assert totals[0] == totals[1] == totals[2] and sum(totals[0].values()) == int(np.sum(aligned.n_links))


def test_a_long_text(spark, sides):
    docs = [(1, "the long and winding road, naïvely " * 8_000), (2, "the road")]
    assert run(spark, docs, block_links=10_000) == sorted(brute(docs, sides), key=str)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=1, max_size=12))
def test_any_texts(spark, sides, texts):
    docs = [(i, t.encode("utf-8", "ignore").decode()) for i, t in enumerate(texts)]
    assert run(spark, docs) == sorted(brute(docs, sides), key=str)
