"""Packing: lengths against the tokenizer, packings against exhaustive search and their rules."""

import itertools
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from quarry.llm import packing
from quarry.llm.chunks import vocabulary_path

PATH = vocabulary_path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                go(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


def check_patterns(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    patterns = packing.complete_bins(counts, capacity)
    held = np.zeros_like(counts)
    for items, times in patterns:
        assert sum(items) <= capacity and times > 0
        for x in items:
            held[x] += times
    assert (held == counts).all()
    bins = sum(t for _, t in patterns)
    assert packing.lower_bound(counts, capacity) <= bins <= sum(t for _, t in packing.best_fit(counts, capacity))
    return bins


def test_small_cases_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.randint(8, 30)
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        assert check_patterns(lengths, capacity) == fewest(lengths, capacity)


def test_without_a_budget_the_search_is_exact():
    rng = random.Random(14)
    for _ in range(40):
        capacity = rng.randint(10, 40)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        found = packing.complete_bins(np.bincount(lengths, minlength=capacity + 1), capacity, steps=None)
        assert sum(t for _, t in found) == fewest(sorted(lengths, reverse=True), capacity)


def test_fillings_are_the_undominated_ones():
    counts = np.bincount([600, 560, 212, 157, 157, 150, 106, 106], minlength=1025)
    assert check_patterns([600, 560, 212, 157, 157, 150, 106, 106], 1024) == 2
    found = set(packing.fillings(counts, 600, 1024, 424, lambda: True))
    assert found == {(212, 106, 106), (157, 157, 106), (212, 157)}


def test_search_improves_on_best_fit():
    # best fit takes 6+4 first and is left with pieces that no longer pair up
    rng = np.random.default_rng(1)
    lengths = rng.integers(200, 420, 3000)
    counts = np.bincount(lengths, minlength=1025)
    assert check_patterns(lengths, 1024) < sum(t for _, t in packing.best_fit(counts, 1024))


def test_huge_counts_cost_no_more():
    counts = np.zeros(1025, np.int64)
    counts[[1024, 700, 324, 512, 300, 212]] = [10**9, 10**10, 10**10, 10**9, 7, 3]
    patterns = packing.complete_bins(counts, 1024)
    assert sum(t for _, t in patterns) == packing.lower_bound(counts, 1024) and len(patterns) < 20


def test_whole_query(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(1, 8)))
    texts = ["", None, "hello", "hello", " ".join(word() for _ in range(3000)), "a" * 5000, "x  y\n\n z <|endoftext|>"]
    texts += [" ".join(word() for _ in range(rng.randint(1, 600))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(2, "hello", 1), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack(docs, PATH, rows_per_group=7).collect()
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = {}
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        head = len(ids) if len(ids) <= 1024 else (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        pieces = [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(itertools.pairwise(cuts))]
        want.setdefault(i, []).extend(pieces)
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    lengths = [r.length for r in got]
    assert len(sequences) == check_patterns(lengths, 1024)
    same = packing.pack(spark.createDataFrame([(None, "")] * 5000, "doc_id long, text string"), PATH, rows_per_group=50).collect()
    assert {(r.sequence_id, r.offset) for r in same} == {(n // 1024, n % 1024) for n in range(5000)}
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_many_short_pieces_end_soon():
    """A step's work does not grow with the pieces that a filling holds."""
    import time

    for histogram in ({5: 100_000, 7: 99_999}, {3: 1024}, {350: 3000, 340: 10}, {1: 5000, 1000: 3, 600: 7}):
        counts = np.zeros(1025, np.int64)
        for length, n in histogram.items():
            counts[length] = n
        start = time.process_time()
        patterns = packing.complete_bins(counts, 1024)
        assert time.process_time() - start < 20
        held = np.zeros_like(counts)
        for items, times in patterns:
            assert sum(items) <= 1024
            np.add.at(held, list(items), times)
        assert (held == counts).all()
        assert packing.lower_bound(counts, 1024) <= sum(t for _, t in patterns) <= sum(t for _, t in packing.best_fit(counts, 1024))


def test_the_bound_holds():
    rng = random.Random(8)
    for _ in range(80):
        capacity = rng.randint(6, 30)
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        assert packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity) <= fewest(lengths, capacity)
