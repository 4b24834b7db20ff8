"""Collocations against a brute-force version and against the SQL twin."""

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.llm import collocations as own

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least=10, inside=50, top=2000):
    """docs: (text, lang) pairs."""
    count, n = Counter(), Counter()
    for text, lang in docs:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                count.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in count.items() if len(p) > 2 and a >= least}
    dropped = {
        s for p, a in candidates.items() if len(p) == 4 for s in ((p[0], p[1], p[2]), (p[0], p[2], p[3])) if s in candidates and 100 * a >= inside * candidates[s]
    }
    rows = []
    for (lang, *words), a in candidates.items():
        if (lang, *words) in dropped:
            continue
        cuts = [(count[lang, *words[:k]], count[lang, *words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


def run(spark, docs, **options):
    rows = spark.createDataFrame([(t, g, i) for i, (t, g) in enumerate(docs)], "text string, lang string, n long")
    return sorted(tuple(r[c] for c in COLUMNS) for r in own.collocations(rows, **options).collect())


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").collect()
    want = sorted(brute([(r.text, r.lang) for r in rows]))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in own.collocations(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect())
    assert got == want and len(got) > 100


def test_sql(spark):
    documents = duckdb.read_parquet("/root/testdata/sf0.001/documents.parquet")  # noqa: F841
    sql = duckdb.sql(own.collocations_sql())
    assert sql.columns == COLUMNS
    assert sorted(sql.fetchall()) == sorted(tuple(r[c] for c in COLUMNS) for r in own.collocations(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect())


def test_odd_rows(spark):
    """Nulls, empty texts, ties, repeats, overlaps, other white space, several blocks and ranges."""
    docs = [("a b c a b c", None), ("a  b\tc", "und"), ("A B. C a b", "x"), (None, "x"), ("", None), ("a a a a a", "y"), ("é É\x00 é z", "x"), ("...", "x"), ("b", "")] * 4
    for options in ({}, {"block_bytes": 1, "words_per_range": 5}, {"block_bytes": 40}):
        assert run(spark, docs, least=4, **options) == sorted(brute(docs, least=4))
        assert run(spark, docs, least=4, inside=100, top=2, **options) == sorted(brute(docs, 4, 100, 2))


def test_a_long_text_and_none(spark):
    docs = [("of the " * 60_000, "en"), ("of the end", "en")]
    assert run(spark, docs) == sorted(brute(docs))
    assert run(spark, []) == [] and run(spark, [(None, None)]) == []


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(alphabet="aB .,\n\tß", max_size=40), st.sampled_from(["en", None])), max_size=12))
def test_any_texts(spark, docs):
    assert run(spark, docs, least=2) == sorted(brute(docs, least=2))


@pytest.mark.parametrize("value", [0, 1, 2**63, 2**64 - 1])
def test_mix_is_reversible(value):
    import numpy as np

    from quarry.llm._bytes import mix, pack_sorted, unmix, unpack_sorted

    keys = np.array([value, 7, 1 << 40], np.uint64)
    assert (unmix(mix(keys)) == keys).all() and (unpack_sorted(pack_sorted(np.sort(keys))) == np.sort(keys)).all()
