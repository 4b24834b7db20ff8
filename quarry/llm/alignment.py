"""Cross-tokenizer alignment by a cogroup of postings.

A text is encoded by two tokenizers, A on space and text, B on the text. Byte offsets where tokens of both end cut the
text into groups, and every A token of a group is linked to every B token of it. An id pair's count is the number of
documents that hold it linked, in the whole corpus; a link is best if its pair's count is the highest of its A id.

How it runs. A task cuts its documents into blocks of some million links and writes each block's postings: for each
range of A ids the distinct id pairs, and for each pair the documents that hold it with the multiplicity there. Pair
counts are a grouping of the blocks' pairs, each once with its number of documents, so they are summed before they are
shuffled. Postings then go by the range of their A ids, sorted by Spark, which spills, and are cogrouped with the counts of that
range, which say locally what the highest is: each block gets the sums of its documents from each range, and sums those.

No group grows with the corpus: a range has at most all pairs of its ids, and its postings are dealt to as many salts as
it takes for `blocks_per_group` blocks in each, with the range's counts beside them. A group of tokens in which many A
tokens meet many B tokens is counted by distinct ids, never link by link, so its links are not written out.

Defined results: a null or empty text, or one whose tokens' joined bytes are not space and text (for instance one with the
second tokenizer's own space mark in it), has no tokens: zeros, and an empty `groups_sha256`; very long texts are aligned whole,
in a block of their own; null and repeated ids do not matter, each row is a document of its own in all counts; ties for the
highest count are all best; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._bytes import pack, runs, unpack
from quarry.llm._tables import drop_path, materialize, materialize_at
from quarry.llm._text import filled, owners, sliced
from quarry.llm.chunks import tokenizer_table
from quarry.llm.sentence_pieces import MARK, codec

_RANGES = 32
#: Of a group with more links than this, distinct ids are paired, not tokens.
_CROWDED = 4096
#: Ids of A are spread over 16 bits by an odd factor, so that ranges are even.
_FACTOR = 40503
_B_BITS = 15


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary, by id."""
    from tokenizers import Tokenizer

    entries = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    added = {t["content"] for t in json.loads(Tokenizer.from_file(path).to_str())["added_tokens"]}
    # the byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for U+0100 onwards
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = entry.encode() if entry in added else bytes(byte_of[c] for c in entry)
    return out


def piece_entries(path: str) -> list[bytes]:
    """The bytes of each piece of a SentencePiece model, by id: marks as spaces, byte pieces as bytes."""
    model = codec(path).model
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]


class Aligner:
    """The two tokenizers with their tokens' bytes."""

    def __init__(self, a_path: str, b_path: str):
        a, b = byte_level_entries(a_path), piece_entries(b_path)
        if len(a) > 1 << 16 or len(b) > 1 << _B_BITS:
            raise ValueError("an id pair must fit into 31 bits")
        self.a_table, self.b_codec = tokenizer_table(a_path), codec(b_path)
        self.a_bytes, self.b_bytes = pa.array(a, pa.large_binary()), pa.array(b, pa.large_binary())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in e], np.int64) for e in (a, b))
        # an id's digits with what follows it: "," inside a side, "|" behind A's side, ";" behind B's
        self.spelled = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(1 << 16)], pa.large_string())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's and B's ids of all texts with n + 1 offsets each; texts whose bytes do not come back have none."""
        empty = pa.scalar("", pa.large_string())
        spaced = pc.if_else(pc.equal(texts, ""), empty, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, empty))
        a, a_bounds = self.a_table.tokenize(spaced)
        b, b_bounds = self.b_codec.encode(texts, end=False)
        want_ends = np.asarray(pc.binary_length(spaced)).cumsum()
        want = np.frombuffer(spaced.buffers()[2] or b"", np.uint8)[: want_ends[-1]] if len(want_ends) else np.zeros(0, np.uint8)
        right = _same(a, a_bounds, self.a_bytes, want, want_ends) & _same(b, b_bounds, self.b_bytes, want, want_ends)
        if right.all():
            return a, a_bounds, b, b_bounds
        a, a_bounds = _only(a, a_bounds, right)
        b, b_bounds = _only(b, b_bounds, right)
        return a, a_bounds, b, b_bounds


def _same(ids: np.ndarray, bounds: np.ndarray, entries: pa.Array, want: np.ndarray, want_ends: np.ndarray) -> np.ndarray:
    """For each text, whether its tokens' joined bytes are those wanted."""
    joined = entries.take(pa.array(ids))
    ends = np.frombuffer(joined.buffers()[1], np.int64, len(ids) + 1)[bounds]
    got = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: ends[-1]]
    if len(got) == len(want) and (ends[1:] == want_ends).all() and (got == want).all():
        return np.ones(len(want_ends), bool)
    want_starts = np.concatenate([[0], want_ends[:-1]])
    spans = zip(ends[:-1].tolist(), ends[1:].tolist(), want_starts.tolist(), want_ends.tolist())
    return np.array([np.array_equal(got[a:b], want[c:d]) for a, b, c, d in spans], bool)


def _only(ids: np.ndarray, bounds: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(bounds)
    return ids[np.repeat(right, sizes)], np.concatenate([[0], np.cumsum(np.where(right, sizes, 0))])


class Aligned:
    """The groups of a batch of texts, all texts one after the other."""

    def __init__(self, aligner: Aligner, texts: pa.Array):
        self.a, self.a_bounds, self.b, self.b_bounds = aligner.encode(texts)
        self.aligner = aligner
        a_ends, b_ends = np.cumsum(aligner.a_sizes[self.a]), np.cumsum(aligner.b_sizes[self.b])
        size = int(a_ends[-1]) + 1 if len(a_ends) else 1
        self.a_last, self.b_last = _among(a_ends, b_ends, size), _among(b_ends, a_ends, size)
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        n = int(self.a_last.sum())
        self.in_a, self.in_b = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        before = np.concatenate([[0], np.cumsum(self.a_last)])
        self.bounds = before[self.a_bounds]
        links = np.concatenate([[0], np.cumsum(self.in_a * self.in_b)])
        self.n_links = links[self.bounds[1:]] - links[self.bounds[:-1]]

    def digests(self) -> list[str]:
        """sha256 of each text's groups, written out; nothing for a text without tokens."""
        step = 1 << 16
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        a_start, b_start = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        codes[np.arange(len(self.a)) + b_start[self.a_group]] = self.a + step * self.a_last
        codes[np.arange(len(self.b)) + (a_start + self.in_a)[self.b_group]] = self.b + 2 * step * self.b_last
        spelled = self.aligner.spelled.take(pa.array(codes))
        at = np.frombuffer(spelled.buffers()[1], np.int64, len(codes) + 1)[self.a_bounds + self.b_bounds].tolist()
        data = memoryview(spelled.buffers()[2] or b"")
        return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at, at[1:])]

    def links(self, text_number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys (pair, text) with multiplicities; texts are numbered from text_number. A key may come more than once."""
        number = np.uint64(text_number) + owners(self.bounds).astype(np.uint64)
        crowded = self.in_a * self.in_b > _CROWDED
        b_start = np.cumsum(self.in_b) - self.in_b
        each = np.where(crowded, 0, self.in_b)[self.a_group]
        from_a = np.repeat(np.arange(len(self.a)), each)
        nth = np.arange(len(from_a)) - np.repeat(np.cumsum(each) - each, each)
        group = self.a_group[from_a]
        yield _key(self.a[from_a], self.b[b_start[group] + nth], number[group]), np.ones(len(from_a), np.int64)
        a_start = np.cumsum(self.in_a) - self.in_a
        for g in np.flatnonzero(crowded).tolist():
            a, n_a = np.unique(self.a[a_start[g] : a_start[g] + self.in_a[g]], return_counts=True)
            b, n_b = np.unique(self.b[b_start[g] : b_start[g] + self.in_b[g]], return_counts=True)
            some = max(1, (1 << 20) // len(b))
            for lo in range(0, len(a), some):
                own = a[lo : lo + some]
                yield _key(np.repeat(own, len(b)), np.tile(b, len(own)), number[g]), np.outer(n_a[lo : lo + some], n_b).ravel()


def _among(ends: np.ndarray, others: np.ndarray, size: int) -> np.ndarray:
    there = np.zeros(size, bool)
    there[others] = True
    return there[ends]


def _key(a: np.ndarray, b: np.ndarray, text: np.ndarray) -> np.ndarray:
    spread = a.astype(np.uint64) * np.uint64(_FACTOR) & np.uint64(0xFFFF)
    return (spread << np.uint64(_B_BITS) | b.astype(np.uint64)) << np.uint64(32) | text


class _Block:
    """Links of several batches, on their way into one block."""

    def __init__(self):
        self.docs: dict[str, list] = {n: [] for n in ("ids", "n_a", "n_b", "n_groups", "n_links", "digests")}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held, self.merged = 0, 0

    def add(self, ids: pa.Array, aligned: Aligned) -> None:
        for keys, counts in aligned.links(len(self.docs["digests"])):
            self.keys.append(keys)
            self.counts.append(counts)
            self.held += len(keys)
            if self.held - self.merged > 16_000_000:  # only a very long text gets here
                self._merge()
        self.docs["ids"] += ids.to_pylist()
        self.docs["digests"] += aligned.digests()
        for name, bounds in (("n_a", aligned.a_bounds), ("n_b", aligned.b_bounds), ("n_groups", aligned.bounds)):
            self.docs[name] += np.diff(bounds).tolist()
        self.docs["n_links"] += aligned.n_links.tolist()

    def _merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.uint64)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        self.keys, self.counts = [], []
        if len(counts) and counts.max() == 1:
            keys.sort()
            first, counts = runs(keys)
        else:
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first, _ = runs(keys)
            counts = np.add.reduceat(counts[order], first) if len(first) else counts
        keys = keys[first]
        self.keys, self.counts, self.held, self.merged = [keys], [counts], len(keys), len(keys)
        return keys, counts

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row for the block's documents, and one for each range of A ids with its postings."""
        block = uuid.uuid4().int >> 65
        keys, counts = self._merge()
        pair, text = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first, n_texts = runs(pair)
        distinct = pair[first]
        own, at = np.unique(distinct * _RANGES >> (16 + _B_BITS), return_index=True)
        cuts = [(int(o), int(a), int(b)) for o, a, b in zip(own, at, [*at[1:], len(distinct)])]
        ends = np.append(first, len(pair))
        parts = [(distinct[a:b], n_texts[a:b], text[ends[a] : ends[b]], counts[ends[a] : ends[b]]) for _, a, b in cuts]
        longs = lambda name: pa.array([self.docs[name]] + [None] * len(cuts), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block] * (1 + len(cuts)), pa.int64()),
                "bucket": pa.array([-1, *(o for o, _, _ in cuts)], pa.int32()),
                **{n: longs(n) for n in ("ids", "n_a", "n_b", "n_groups", "n_links")},
                "digests": pa.array([self.docs["digests"]] + [None] * len(cuts), pa.list_(pa.string())),
                "pairs": pa.array([None] + [pack(np.diff(p, prepend=0), n) for p, n, _, _ in parts], pa.binary()),
                "postings": pa.array([None] + [pack(t, width=4) for _, _, t, _ in parts], pa.binary()),
                "counts": pa.array([None] + [pack(c, width=8) for _, _, _, c in parts], pa.binary()),
                "n_docs": pa.array([len(self.docs["digests"])] * (1 + len(cuts)), pa.int64()),
            }
        )


_ROWS = (
    "block long, bucket int, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digests array<string>, pairs binary, postings binary, counts binary, n_docs long"
)
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _blocks(docs: DataFrame, a_path: str, b_path: str, block_links: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _aligner(a_path, b_path), _Block()
        for batch in sliced(batches, "text", 2 << 20):
            block.add(batch.column("doc_id"), Aligned(aligner, filled(batch.column("text"))))
            if block.held >= block_links:
                yield from block.rows()
                block = _Block()
        if block.docs["digests"]:
            yield from block.rows()

    return docs.mapInArrow(run, _ROWS)


def _read_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, n_texts = unpack(packed, 2)
    return np.cumsum(steps.astype(np.int64)), n_texts.astype(np.int64)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each linked id pair is, and whether no other of its A id is in more."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("pairs").to_pylist():
                pairs, n_texts = _read_pairs(packed)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n_texts)], ["pair", "n"])

    rows = blocks.filter("bucket >= 0").select("pairs").mapInArrow(each, "pair long, n long")
    counted = rows.groupBy("pair").agg(F.sum("n").alias("n"))
    # an A id has at most as many pairs as B has ids
    side = Window.partitionBy(F.shiftright("pair", _B_BITS))
    return counted.withColumn("best", F.col("n") == F.max("n").over(side))


def _packed_counts(counts: DataFrame) -> DataFrame:
    """One row for each range of A ids: its pairs, ascending, with counts and marks."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pair").to_numpy())
        pairs, n, best = (table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best"))
        packed = {"pairs": pack(np.diff(pairs, prepend=0)), "n": pack(n, width=8), "best": np.packbits(best).tobytes()}
        return pa.table({"own": pa.array([int(pairs[0]) * _RANGES >> (16 + _B_BITS)], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in packed.items()}})

    return counts.groupBy(F.shiftright(F.col("pair") * _RANGES, 16 + _B_BITS)).applyInArrow(run, "own int, pairs binary, n binary, best binary")


def _contributions(left: pa.Table, right: pa.Table) -> pa.Table:
    """What a range of A ids adds to each document of each block: best links, and counts over its links."""
    if right.num_rows:
        known = np.cumsum(unpack(right.column("pairs")[0].as_py())[0].astype(np.int64))
        n = unpack(right.column("n")[0].as_py(), width=8)[0].astype(np.int64)
        best = np.unpackbits(np.frombuffer(right.column("best")[0].as_py(), np.uint8), count=len(known)).astype(np.int64)
    else:
        known = n = best = np.zeros(0, np.int64)
    blocks, bests, sums = [], [], []
    columns = (left.column(c).to_pylist() for c in ("block", "pairs", "postings", "counts", "n_docs"))
    for block, packed, postings, counts, n_docs in zip(*columns):
        pairs, n_texts = _read_pairs(packed)
        at = np.repeat(np.searchsorted(known, pairs), n_texts)
        texts, times = unpack(postings)[0].astype(np.int64), unpack(counts, width=8)[0].astype(np.int64)
        total, top = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        np.add.at(total, texts, n[at] * times)
        np.add.at(top, texts, best[at] * times)
        blocks.append(block)
        bests.append(pack(top, width=8))
        sums.append(pack(total, width=8))
    return pa.table({"block": pa.array(blocks, pa.int64()), "best": pa.array(bests, pa.binary()), "sums": pa.array(sums, pa.binary())})


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of a block's documents, with what all ranges add to them."""
    if not left.num_rows:
        kinds = [pa.int64()] * 7 + [pa.string()]
        return pa.table({c.split(" ")[0]: pa.array([], k) for c, k in zip(_RESULT.split(", "), kinds)})
    get = lambda c: left.column(c)[0].values
    n = len(get("digests"))
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for top, sums in zip(right.column("best").to_pylist(), right.column("sums").to_pylist()):
        best += unpack(top, width=8)[0].astype(np.int64)
        total += unpack(sums, width=8)[0].astype(np.int64)
    return pa.table(
        {
            "doc_id": get("ids"), "n_a": get("n_a"), "n_b": get("n_b"), "n_groups": get("n_groups"), "n_links": get("n_links"),
            "n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": get("digests"),
        }
    )


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_links: int = 4_000_000, blocks_per_group: int = 64
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks, path = materialize_at(_blocks(rows, a_path, b_path, block_links), "alignment-blocks")
    counts = materialize(_packed_counts(pair_counts(blocks)), "alignment-counts")
    salts = max(1, -(-blocks.filter("bucket = -1").count() // blocks_per_group))
    postings = blocks.filter("bucket >= 0").select(
        "block", "bucket", "pairs", "postings", "counts", "n_docs", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt")
    )
    beside = counts.select("own", "pairs", "n", "best", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("own_salt"))
    added = postings.groupBy("bucket", "salt").cogroup(beside.groupBy("own", "own_salt")).applyInArrow(_contributions, "block long, best binary, sums binary")
    base = blocks.filter("bucket = -1").select(F.col("block").alias("own_block"), "ids", "n_a", "n_b", "n_groups", "n_links", "digests")
    done = materialize(base.groupBy("own_block").cogroup(added.groupBy("block")).applyInArrow(_summed, _RESULT), "alignment-result")
    drop_path(docs.sparkSession, path)
    return done
