"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints within radius r share a variant that lies within r // 2 of both of them: the point halfway between.
So every distinct fingerprint emits all its variants within r // 2 bits, and fingerprints that meet on a variant are
linked. 64 bits and r = 4 give 2,081 variants each. Shuffling those one by one would move 16 bytes for each; here the
shuffle is on the variants' leading bits instead. A fingerprint is sent once to each prefix that one of its variants
can have (37 for 8 bits), and the task that owns a prefix writes out the variants below it, sorts them and links the
fingerprints that meet. The variants are the same ones; the bytes moved are a hundredth. A prefix with too many
variants for one task (near copies share their leading bits) is split by further bits of the variants: a fingerprint
then goes only to the longer prefixes that it reaches. At full length a prefix is one variant, and no more than 2,081
distinct fingerprints reach it, so the work of a task has a bound.

One fingerprint finds few of the pairs whose shingle sets are alike to 0.8 only (an expected ten of 64 bits differ).
keep_one_of_each() therefore takes several fingerprints of a text, from the same shingles by independent hashes, and
two texts are linked if any of them are within the radius.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other; texts
with fewer words than a shingle are one shingle of all their words; a bit that exactly half of the hashes have is 0;
very long texts are fingerprinted whole; equal texts have equal fingerprints and so one component; rows with a null id
get a fingerprint and, if nothing in their component has an id, a null component; repeated rows come out as often as
they came in; an empty table gives no rows; other columns, whatever their names, are ignored by near_duplicates() and
passed through by keep_one_of_each(), which says below which row of a group it keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._tables import drop_path, free_name, materialize, materialize_at
from quarry.llm._text import byte_texts, sliced
from quarry.llm.chunks import release_tables
from quarry.llm.components import connected_components

SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of one text: the majority bits of its word shingles' hashes."""
    return int(fingerprint_set(text, shingle, 1)[0])


def fingerprint_set(text: bytes, shingle: int, sets: int) -> np.ndarray:
    """`sets` fingerprints of one text: the first of its shingles' hashes, the others of these hashes mixed anew."""
    words = text.lower().split()
    if not words:
        return np.zeros(sets, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    starts, ends = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros((sets, BITS), np.int64)
    for lo in range(0, len(starts), 1 << 14):  # a very long text is summed in parts
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo : lo + (1 << 14)], ends[lo : lo + (1 << 14)])], "<u8")
        for k in range(sets):
            own = hashes if k == 0 else _spread(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
            counts[k] += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(starts), axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, sets: int = 1, keep: list[Column] | None = None) -> DataFrame:
    """(doc_id, fps, and the kept long columns): fps holds each fingerprint's 64 bits as a signed long."""
    keep = keep or []
    names = ["doc_id", *(f"keep_{i}" for i in range(len(keep)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, "text", 2 << 20):
            fps = np.concatenate([fingerprint_set(t, shingle, sets) for t in byte_texts(batch.column("text"))]).astype(np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(fps) + 1, sets, dtype=np.int32)), pa.array(fps.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists], [*names, "fps"])

    own = [F.col(id_col).cast("long").alias("doc_id"), *(c.cast("long").alias(n) for c, n in zip(keep, names[1:]))]
    rows = docs.select(*own, F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "".join(f"{n} long, " for n in names) + "fps array<long>")


def _masks(bits: int, weight: int) -> list[int]:
    """All masks of up to `weight` set bits out of `bits`."""
    return [sum(1 << b for b in c) for w in range(weight + 1) for c in combinations(range(bits), w)]


def _spread(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers, so that their leading bits depend on all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _ball(bits: int, weight: int) -> int:
    """How many masks _masks() gives."""
    return sum(comb(bits, w) for w in range(weight + 1))


def _meet(fps: np.ndarray, prefix: int, prefix_bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints whose variants under one prefix coincide.

    All fingerprints on one variant are within the radius of each other, so a star around the least of them loses
    no connection. Of the stars' links as many are kept as connect what they connect, so there are fewer links than
    fingerprints, however many variants these share.
    """
    fps = np.sort(fps)
    low = BITS - prefix_bits
    spent = np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(prefix)) if prefix_bits else np.zeros(len(fps), np.uint8)
    tails = fps & np.uint64((1 << low) - 1)
    variants, emitters = [], []
    for used in range(half + 1):
        own = np.flatnonzero(spent == used)
        masks = np.array(_masks(low, half - used), np.uint64)
        variants.append((tails[own, None] ^ masks[None, :]).ravel())
        emitters.append(np.repeat(own, len(masks)).astype(np.uint32))
    variant, emitter = np.concatenate(variants), np.concatenate(emitters)
    del variants, emitters
    # Sort one 64-bit key: leading bits of the mixed variant, then the place; candidates are compared in full below.
    place_bits = max(1, int(len(variant)).bit_length())
    keys = (_spread(variant) >> np.uint64(place_bits)) << np.uint64(place_bits) | np.arange(len(variant), dtype=np.uint64)
    keys.sort()
    heads = keys >> np.uint64(place_bits)
    same = heads[1:] == heads[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    at = (keys[shared] & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    v, f = variant[at], emitter[at].astype(np.int64)
    order = np.lexsort((f, v))
    v, f = v[order], f[order]
    if not len(v):
        return fps[:0], fps[:0]
    first = np.concatenate([[True], v[1:] != v[:-1]])
    pairs = np.unique(f[np.flatnonzero(first)][np.cumsum(first) - 1] * len(fps) + f)
    centre, other = np.divmod(pairs, len(fps))
    kept = _spanning(centre, other, len(fps))
    return fps[centre[kept]], fps[other[kept]]


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The places of links a - b, among n nodes, that connect all that the links connect, without a loop."""
    root, kept, none = np.arange(n), [], np.iinfo(np.int64).max
    while True:
        high, low = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
        at = np.flatnonzero(high != low)
        if not len(at):
            return np.concatenate(kept) if kept else at
        # every root that a link leads down from takes one such link, the one to the least root
        down = np.full(n, none)
        np.minimum.at(down, high[at], low[at] * len(a) + at)
        moved = np.flatnonzero(down < none)
        root[moved] = down[moved] // len(a)
        kept.append(down[moved] % len(a))
        while not np.array_equal(further := root[root], root):
            root = further


def link_fingerprints(nodes: DataFrame, radius: int = 4, variants_per_task: int = 2_000_000) -> DataFrame:
    """(k, u, v): links between distinct fingerprints (column fp) of each set (column k, if there is one).

    They are enough to connect all that lie within the radius. variants_per_task sets how many leading bits the shuffle
    uses, from the count of fingerprints (20 at most, which 5 * 10^8 distinct fingerprints reach). A prefix with more
    than three times that is split by as many further bits as bring it below, even if all its fingerprints lie close.
    """
    half = radius // 2
    if half * 2 != radius:
        raise ValueError("the radius must be even, so that its half meets in the middle")
    spark = nodes.sparkSession
    if "k" not in nodes.columns:
        nodes = nodes.withColumn("k", F.lit(0))
    bits = min(20, max(6, (nodes.count() * _ball(BITS, half) // variants_per_task).bit_length()))
    low, limit = BITS - bits, 3 * variants_per_task
    sent = nodes.select("k", "fp", F.explode(F.array(*[F.lit(m) for m in _masks(bits, half)])).alias("mask")).select(
        "k", "fp", F.bit_count("mask").alias("spent"), F.shiftrightunsigned("fp", low).bitwiseXOR(F.col("mask")).cast("long").alias("prefix")
    )
    load = F.get(F.array(*[F.lit(_ball(low, half - s)) for s in range(half + 1)]), F.col("spent"))
    steps = [*range(4, low, 4), low]
    more = F.lit(low)
    for step in reversed(steps[:-1]):
        more = F.when(F.col("load") * _ball(low - step, half) <= limit * _ball(low, half), step).otherwise(more)
    # all prefixes together hold at most 2^bits * variants_per_task variants, so a third of them can be crowded: 350,000 rows
    crowded = sent.groupBy("k", "prefix").agg(F.sum(load).alias("load")).filter(F.col("load") > limit).select("k", "prefix", more.alias("more"))
    # the masks over 4, 8, ... further bits, by what a fingerprint has spent: fixed, some thousand numbers
    ways = spark.createDataFrame([(e, s, _masks(e, half - s)) for e in steps for s in range(half + 1)], "more int, spent int, ways array<long>")
    dealt = sent.join(F.broadcast(crowded), ["k", "prefix"], "left").join(F.broadcast(ways), ["more", "spent"], "left")
    dealt = dealt.select("k", "fp", "prefix", F.coalesce("more", F.lit(0)).alias("more"), F.explode(F.coalesce("ways", F.array(F.lit(0).cast("long")))).alias("way"))
    tail = F.expr(f"shiftrightunsigned(fp, {low} - more) & (shiftleft(1L, more) - 1L)")
    dealt = dealt.select("k", "fp", "more", F.expr("shiftleft(prefix, more)").bitwiseOR(tail.bitwiseXOR(F.col("way"))).alias("prefix"))

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        one = lambda c: table.column(c)[0].as_py()
        u, v = _meet(fps, one("prefix") % (1 << BITS), bits + one("more"), half)
        return pa.table({"k": pa.array(np.full(len(u), one("k"), np.int32)), "u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    met = dealt.groupBy("k", "more", "prefix").applyInArrow(run, "k int, u long, v long")
    return met.distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: hex fingerprint, and the least id that links reach."""
    spark = docs.sparkSession
    rows = materialize(fingerprints(docs, id_col, text_col, shingle).select("doc_id", F.get("fps", 0).alias("fp")), "simhash-fp")
    nodes, nodes_path = materialize_at(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    links, links_path = materialize_at(link_fingerprints(nodes, radius).select("u", "v"), "simhash-links")
    roots = connected_components(links)
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = materialize(placed.join(named, "root").select("fp", "component_id"), "simhash-components")
    for path in (nodes_path, links_path):
        drop_path(spark, path)
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _linked_texts(texts: DataFrame, radius: int, sets: int, at_once: int = 2) -> DataFrame:
    """(node, root) of the distinct texts (tid, fps) that are linked to others: root is the least tid of the component.

    The sets go through the shuffle at_once at a time, so that the disk they take does not grow with their number.
    """
    found, paths = None, []
    for lo in range(0, sets, at_once):
        held = texts.select("tid", F.posexplode(F.slice("fps", lo + 1, at_once)).alias("k", "fp"))
        nodes, nodes_path = materialize_at(held.groupBy("k", "fp").agg(F.min("tid").alias("lead"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
        links = link_fingerprints(nodes.select("k", "fp"), radius)
        lead = lambda c: nodes.select("k", F.col("fp").alias(c), F.col("lead").alias(f"lead_{c}"))  # noqa: B023, E731
        apart = links.join(lead("u"), ["k", "u"]).join(lead("v"), ["k", "v"]).select(F.col("lead_u").alias("u"), F.col("lead_v").alias("v"))
        shared = held.join(nodes.filter("n > 1").select("k", "fp", "lead"), ["k", "fp"]).select(F.col("tid").alias("u"), F.col("lead").alias("v"))
        edges, path = materialize_at(apart.union(shared).filter("u <> v").distinct(), "simhash-links")
        drop_path(texts.sparkSession, nodes_path)
        found, paths = edges if found is None else found.union(edges), [*paths, path]
    roots = connected_components(found.distinct())
    for path in paths:
        drop_path(texts.sparkSession, path)
    return roots


def keep_one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    radius: int = 4,
    sets: int = 4,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """One row of each group of near copies, all columns as they were.

    Of a group the row with the least id stays, rows without an id after all others; of rows with one id the one with
    the least hash of all its columns; of rows that are equal in all columns one. So ids may be null or repeated.

    The choice is made on ids and hashes; no text is shuffled for it. Rows that go are left out by an anti join on
    (id, hash), with a broadcast if they are `broadcast_rows` at most (16 bytes each), else as Spark sees fit.
    Texts are told apart by a 64-bit hash of their fingerprints.
    """
    spark = docs.sparkSession
    digest, gone_id, gone_digest = (free_name(n, docs.columns) for n in ("__digest", "__gone_id", "__gone_digest"))
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    hashed = F.xxhash64(*[F.to_json(F.struct(quoted(c))) if "map<" in t else quoted(c) for c, t in docs.dtypes])
    rows, rows_path = materialize_at(fingerprints(docs, id_col, text_col, shingle, sets, [hashed]).select("doc_id", F.col("keep_0").alias("digest"), "fps", F.xxhash64("fps").alias("tid")), "simhash-rows")
    texts, texts_path = materialize_at(rows.groupBy("tid").agg(F.first("fps").alias("fps")), "simhash-texts")
    roots = _linked_texts(texts, radius, sets)
    drop_path(spark, texts_path)
    placed, placed_path = materialize_at(
        rows.join(roots, rows["tid"] == roots["node"], "left").select("doc_id", "digest", F.coalesce("root", "tid").alias("grp")), "simhash-placed"
    )
    drop_path(spark, rows_path)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    several = placed.groupBy("grp").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = placed.join(several, "grp").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")))
    counted = found.groupBy("doc_id", "digest", "stays").agg(F.count(F.lit(1)).alias("n"))
    marks = materialize(counted.filter("NOT stays OR n > 1").select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest), "stays"), "simhash-marks")
    drop_path(spark, placed_path)
    marked = docs.withColumn(digest, hashed)
    at = quoted(id_col).cast("long").eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone_digest))
    small = marks.count() <= broadcast_rows
    gone = marks.drop("stays")
    out = marked.join(F.broadcast(gone) if small else gone, at, "left_anti").drop(digest)
    repeated = marks.filter("stays").drop("stays")
    if not repeated.isEmpty():  # equal rows, of which one stays: they are merged before their shuffle
        same = marked.join(F.broadcast(repeated) if small else repeated, at, "left_semi")
        whole = F.first(F.struct(*[quoted(c) for c in docs.columns])).alias("row")
        one = same.groupBy(quoted(id_col).cast("long").alias("i"), F.col(digest).alias("d")).agg(whole).select("row.*")
        out = out.unionByName(one)
    return out
