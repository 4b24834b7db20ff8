"""Quality rules against a plain re-count."""

import random
import re

import zstandard

from quarry.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hot = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hot) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hot), failed


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, " \n\t", "a b c", "a b c a b c", "a a a a", "é ß\x85x\x1cy #*$%&|<>", "x\ny\nx\n\n\nx \n", "🙂 🙂 🙂 🙂"]
    texts += [prose(rng, n) for n in (49, 50, 51, 800)]
    texts += [" ".join(rng.choice("abcd") for _ in range(n)) for n in (60, 90, 130)]
    texts += ["line one here\n" * 30 + prose(rng, 60), prose(rng, 60) + "\r\n" + prose(rng, 70) + "\x0b\x0cz", "a " * 20000]
    rows = [(i, t, True, "k") for i, t in enumerate(texts)] + [(None, texts[9], True, "k"), (3, "a b c", True, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, n_words string")
    got = q.judge(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        if len(texts[r.doc_id] or "") < 20000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in got if r.kept)
    assert q.judge(docs.limit(0)).count() == 0 and q.keep_good(docs.limit(0)).count() == 0


def test_bands_reject_repetition_and_noise_but_keep_prose():
    rng, press = random.Random(1), zstandard.ZstdCompressor(level=3)
    verdict = lambda t: q.compression_verdict(t.encode("latin-1"), q.Bands(), press)[3]
    assert all(verdict(prose(rng, n)) for n in (60, 300, 3000, 30000))
    assert not verdict("buy this now and save " * 400)
    assert not verdict("".join(chr(rng.randrange(33, 255)) for _ in range(9000)))
    # a third of the chunks is noise while the whole is still within its band
    mixed = "".join(prose(rng, 800)[:4096] + prose(rng, 800)[:4096] + "".join(chr(rng.randrange(33, 255)) for _ in range(4096)) for _ in range(4))
    whole, chunks, bad, good = q.compression_verdict(mixed.encode("latin-1"), q.Bands(), press)
    assert chunks == 12 and bad == 4 and not good


def test_long_text_is_not_cut():
    import pyarrow as pa

    rng = random.Random(2)
    text = prose(rng, 200_000)
    got = q.measures(pa.array([text, "b"], pa.large_string()), q.Bands())
    assert got["n_words"].tolist() == [200_000, 1] and got["n_chunks"][0] == -(-len(text) // 4096)
