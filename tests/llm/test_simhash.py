"""SimHash groups against a brute-force pass over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from quarry.llm import simhash
from quarry.llm.components import connected_components


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in zip(ids, fps):
        for b, y in zip(ids, fps):
            if a < b and bin(x ^ y).count("1") <= 4:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def test_fingerprint_matches_brute_force_and_spark_hash(spark):
    texts = ["", " \t\n", "One", "one two three", "A b C d É ſ  e f g\x0bh", "x " * 300]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprint(b"One") == spark.sql("select xxhash64('one') h").first().h & (1 << 64) - 1


@pytest.mark.parametrize("radius", [2, 4])
def test_links_connect_exactly_what_lies_within_the_radius(spark, radius):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for x in list(fps)[:60]:  # chains of neighbours at one to six bits
        for _ in range(3):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, 3, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    for size in (2_000_000, 2_000):  # few and many prefixes, and crowded ones in the second
        links = simhash.link_fingerprints(nodes, radius, variants_per_task=size).collect()
        assert all(bin((r.u ^ r.v) & (1 << 64) - 1).count("1") <= radius for r in links)
        root = {x: x for x in fps}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for r in links:
            root[find(r.u & (1 << 64) - 1)] = find(r.v & (1 << 64) - 1)
        for i, x in enumerate(fps):
            for y in fps[:i]:
                if bin(x ^ y).count("1") <= radius:
                    assert find(x) == find(y)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(1, 30))
    assert got[201] == got[202] == 200
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_whole_query(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(200)) for _ in range(8)]
    texts = base + [base[0], base[1] + " tail", base[2].upper(), "", None, " \n", "one", "ONE", base[3][:-3]]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, base[3], "x", "y"), (None, "nothing like it " * 9, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id string")
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    got = got.collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t or "") for t in texts]
    want = brute_components(list(range(len(texts))), fps)
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", want[r.doc_id])
        else:
            assert r.component_id is None
    kept = simhash.keep_one_of_each(docs, shingle=4, sets=1)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


def copies_of(spark, rows, names="doc_id long, text string"):
    docs = spark.createDataFrame(rows, names)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    return sorted((tuple(r) for r in kept.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_one_row_of_each_group_whatever_the_ids(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)) for _ in range(4))
    assert copies_of(spark, [(3, a), (7, a), (7, b)]) == [(3, a), (7, b)]
    assert copies_of(spark, [(None, a), (9, a), (None, c), (None, c), (None, d), (5, b), (5, b)]) == [(5, b), (9, a), *sorted([(None, c), (None, d)], key=lambda r: r[1])]
    assert copies_of(spark, [(1, a), (1, b), (1, a)]) == sorted([(1, a), (1, b)], key=lambda r: r[1])
    assert copies_of(spark, [(None, None), (2, ""), (4, " ")]) == [(2, "")]  # no words: all alike
    assert copies_of(spark, [(2, a, 1, "x"), (1, a, 2, "y")], "doc_id long, text string, __digest int, __Gone_id string") == [(1, a, 2, "y")]
    docs = spark.createDataFrame([(1, a, {"k": 1}), (2, a, {"k": 2})], "doc_id long, text string, m map<string, int>")
    assert [r.doc_id for r in simhash.keep_one_of_each(docs).collect()] == [1]
    joined = simhash.keep_one_of_each(spark.createDataFrame([(3, a), (7, a), (7, b), (7, b)], "doc_id long, text string"), broadcast_rows=0)
    assert sorted(map(tuple, joined.collect())) == [(3, a), (7, b)]


def test_several_fingerprints_find_more_near_copies(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(6))
    rows, changed = [], {}
    for i in range(120):  # every pair differs in one to eight words of 400: similarity 0.82 to 0.97
        words = [word() for _ in range(400)]
        other = list(words)
        for at in rng.sample(range(400), 1 + i % 8):
            other[at] = word()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        changed[2 * i + 1] = 1 + i % 8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {sets: {r.doc_id for r in simhash.keep_one_of_each(docs, sets=sets).collect()} for sets in (1, 4)}
    assert all(2 * i in left[4] for i in range(120)) and left[4] < left[1]
    close = [i for i, n in changed.items() if n <= 2]
    assert len([i for i in close if i not in left[4]]) > 0.8 * len(close)


def test_recall_by_similarity(spark):
    """Pairs of texts of 300 words, some words replaced, by the 5-word similarity of the pair: with the pipeline's twelve sets."""
    import random

    rng, pairs = random.Random(12), []
    vocabulary = [f"w{i}" for i in range(4000)]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    wanted = {0.8: 0.15, 0.85: 0.35, 0.9: 0.8, 0.95: 0.95}
    for level in wanted:
        n = 0
        while n < 60:
            words = [rng.choice(vocabulary) for _ in range(300)]
            other, places = list(words), list(range(300))
            rng.shuffle(places)
            for at in places:
                other[at] = rng.choice(vocabulary)
                a, b = shingles(words), shingles(other)
                if len(a & b) / len(a | b) < level + 0.01:
                    break
            if abs(len(a & b) / len(a | b) - level) <= 0.02:
                pairs.append((level, " ".join(words), " ".join(other)))
                n += 1
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p[1:])], "doc_id long, text string")
    left = {r.doc_id for r in simhash.keep_one_of_each(docs, sets=12).collect()}
    assert {2 * i for i in range(len(pairs))} <= left
    found = {level: [2 * i + 1 not in left for i, p in enumerate(pairs) if p[0] == level] for level in wanted}
    shares = {level: sum(f) / len(f) for level, f in found.items()}
    print("recall", shares)
    assert all(shares[level] >= least for level, least in wanted.items())


def test_spanning_links_connect_the_same_without_loops():
    rng = np.random.default_rng(5)
    for n, m in ((1, 0), (2, 1), (30, 20), (40, 200), (200, 190)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        kept = simhash._spanning(a, b, n)

        def parts(places):
            root = list(range(n))
            for i in places:
                x, y = root[a[i]], root[b[i]]
                root = [min(x, y) if r in (x, y) else r for r in root]
            return root

        assert parts(range(m)) == parts(kept) and len(kept) == n - len(set(parts(range(m))))
