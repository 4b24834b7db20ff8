"""The splitter against a version written another way, and the prompt against plain Python."""

import math
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import splitting


def brute(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """Chunks by slices of the list of parts: the longest run of parts that fits, then back as far as the overlap allows."""
    while separators[0] and separators[0] not in text:
        separators = separators[1:]
    parts = [p for p in (re.split(f"(?={re.escape(separators[0])})", text) if separators[0] else text) if p]
    if separators[0]:
        glued, out = "", []
        for piece in text.split(separators[0]):  # re.split would find overlapping separators
            out.append((separators[0] if glued else "") + piece)
            glued = "x"
        parts = [p for p in out if p]
    chunks, low = [], 0

    def flush(run):
        a = 0
        while a < len(run):
            b = a + 1
            while b < len(run) and sum(map(len, run[a : b + 1])) <= size:
                b += 1
            chunks.append("".join(run[a:b]))
            if b == len(run):
                return
            n = b
            while n > a + 1 and sum(map(len, run[n - 1 : b])) <= overlap and sum(map(len, run[n - 1 : b + 1])) <= size:
                n -= 1
            a = n

    for i, part in enumerate(parts):
        if len(part) >= size:
            flush(parts[low:i])
            chunks += brute(part, size, overlap, separators[1:]) if len(separators) > 1 else [part]
            low = i + 1
    flush(parts[low:])
    return [c.strip() for c in chunks if c.strip()]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n", max_size=120), st.integers(2, 30), st.integers(0, 12))
def test_any_text(text, size, overlap):
    if text and overlap < size:
        got = list(splitting.split(text, size, overlap))
        assert got == brute(text, size, overlap) and all(len(c) <= size for c in got)


def test_examples():
    assert list(splitting.split("aa bb cc dd", 6, 3)) == ["aa bb", "bb cc", "cc dd"]
    assert list(splitting.split("one\n\ntwo three\n\nfour", 9, 0)) == ["one", "two", "three", "four"]
    assert list(splitting.split("abcdefghij", 4, 1)) == ["abcd", "defg", "ghij"]


def test_sections():
    text = "before Model Name: a\n== Model Properties ==\n" + "word " * 30
    got = list(splitting.split_sections(text, 40, 10))
    assert got[:2] == ["before", "Model Name: a"] and all(len(c) <= 60 for c in got) and len(got) > 4
    assert list(splitting.split_sections("no sections here", 40, 10)) == ["no sections here"]


@pytest.mark.parametrize("name", ["sf0.001"])
def test_documents(spark, name):
    docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet").select("doc_id", "text")
    got = {}
    for r in splitting.chunks(docs, F.col("text")).collect():
        got.setdefault(r.doc_id, {})[r.n] = r.chunk
    for r in docs.collect():
        assert [got.get(r.doc_id, {})[i] for i in range(len(got.get(r.doc_id, {})))] == brute(r.text or " ", 1000, 200)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, " \n ", 5), (4, "a b", 5), (4, "a b", 5)], "doc_id long, text string, other long")
    assert sorted(tuple(r) for r in splitting.chunks(rows, F.col("text")).collect()) == [(4, "a b", 5, 0, "a b")] * 2
    with pytest.raises(ValueError):
        splitting.chunks(rows, F.col("text"), 5, 5)


def test_prompt(spark):
    docs = [(1, "red fox jumps"), (2, "blue whale swims"), (3, "a red whale"), (4, "..."), (5, "red red fox")]
    rows = splitting.chunks(spark.createDataFrame(docs, "doc_id long, text string"), F.col("text"))

    def vector(text):
        out = [0.0] * 64
        for w in re.findall(r"[^\W_]+", text.lower()):
            out[zlib.crc32(w.encode()) % 64] += 1
        return out

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))

    asked = "Red fox?"
    best = sorted((-cosine(vector(t), vector(asked)), i, t) for i, t in docs if t != "...")[:3]
    found = splitting.nearest_chunks(rows, asked, ["doc_id"])
    assert [r.key.doc_id for r in found.collect()] == [i for _, i, _ in best]
    prompt = splitting.answer_prompt(found, asked).first().prompt
    assert prompt == "Context:\n" + "\n\n".join(t for _, _, t in best) + "\n\nQuestion: Red fox?\nAnswer:"


def test_vectors_are_made_once(spark):
    """A chunk's words are hashed at one place of the plan, whatever filters on vector and score stand above it."""
    rows = spark.createDataFrame([(1, "red fox", 0, "red fox")], "doc_id long, text string, n int, chunk string")
    plan = splitting.nearest_chunks(rows, "Red fox?", ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("crc32(") == 1


def test_vectors_count_words_by_slot(spark):
    texts = [None, "", "...", "a", "Ab ab AB 7", " ".join(f"w{i % 97}" for i in range(5000))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for dims in (1, 64):
        got = {r.i: list(r.v) for r in rows.select("i", splitting.hashed_vector(F.col("text"), dims).alias("v")).collect()}
        for i, t in enumerate(texts):
            want = [0.0] * dims
            for w in re.findall(r"[^\W_]+", (t or "").lower()):
                want[zlib.crc32(w.encode()) % dims] += 1
            assert got[i] == want


def test_ties_and_questions_without_words(spark):
    rows = spark.createDataFrame([(1, 0, "fox red"), (1, 0, "Red fox"), (1, 0, "red fox"), (2, 0, "whale")], "doc_id long, n int, chunk string")
    assert [r.chunk for r in splitting.nearest_chunks(rows, "red fox", ["doc_id"], 2).collect()] == ["Red fox", "fox red"]
    assert splitting.nearest_chunks(rows, "?!", ["doc_id"]).count() == 0
