"""Benchmark decontamination with a generalised suffix automaton of the benchmark's items.

Texts are lower-cased (A-Z) and cut into words at ASCII characters that are no digit and no letter. All items go into one
suffix automaton over words. A document's words are streamed through it: a state and the length of the longest match
that ends at each word. A window is `window` consecutive words of an item, or all words of a shorter item; a document's
word inside any occurrence of a window is hit. clean() takes hit spans longer than a limit out of the texts and drops
documents that are covered beyond a limit.

How it runs. Items are cut into chunks of bounded length that overlap by a window less one word, equal chunks are
merged, and chunks are dealt to parts of at most about part_words words. Each part's automaton is built in a task of its
own and sent to the workers, one part at a time, so that what is broadcast has a bound. With one part (200,000 words of
items by default) documents are read once and nothing is shuffled. With more, each part is a pass over all documents
that keeps the rows with hits only, and hits of a row are united by its id and two hashes of its text.

In a task, words become numbers of the items' vocabulary. A stretch in which two neighbours never stand side by side
in an item cannot hold a window of two words, so the automaton gets only the stretches in between: many at once, one
word of each at a step. A stretch of thousands of words is cut into pieces that overlap by a window less one word.

Defined results: a null text has no words, nor has an empty one; such an item has no window; a null item id counts as
the empty text; items with one id count as one item; equal items with several ids count with all of them; very long
texts and items are taken whole; a null or repeated document id does not matter, each row is judged by itself; without
items nothing is hit; an empty table gives no rows; there are no ties to break; other columns, whatever their names,
are ignored by report() and passed through by clean().
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._bytes import mix
from quarry.llm._tables import materialize
from quarry.llm._text import filled, sliced, split_words
from quarry.llm.chunks import release_tables

#: Lower case, and a space for ASCII characters that are no digit and no letter.
_PLAIN = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _PLAIN[_low:_high] = np.arange(_low, _high)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PIECE = 512
_NONE = hashlib.sha256(b"").hexdigest()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and n + 1 offsets of the texts' words."""
    plain, _ = _plain(texts)
    return split_words(plain)


def _plain(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    size = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, size + 1)
    data = _PLAIN[np.frombuffer(texts.buffers()[2] or b"", np.uint8, offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), size, [None, pa.py_buffer(offsets), pa.py_buffer(data)]), offsets


def _edges(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends, in the bytes of all texts."""
    plain, offsets = _plain(texts)
    inside = np.frombuffer(plain.buffers()[2], np.uint8, offsets[-1]) != 0x20
    first, last = inside.copy(), inside.copy()
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class _Builder:
    """A generalised suffix automaton: state 0 is the root."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, edges: dict[int, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int) -> int:
        """The state behind p's edge that holds no longer string than p's own with the word: a copy, if need be."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new, p = self._state({}, 0, self.length[last] + 1), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word)
            last = new

    def at(self, state: int, length: int) -> int:
        """The state of the last `length` words of what led to a state."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


@dataclass
class Automaton:
    """What a worker needs of a part: edges sorted by (state, word), links, lengths, and the windows by state."""

    vocabulary: pa.Array
    edges: np.ndarray
    targets: np.ndarray
    link: np.ndarray
    length: np.ndarray
    neighbours: np.ndarray
    windows: dict[int, list[tuple[int, tuple[int, ...]]]]
    items: list[str]
    window: int
    least: int

    def __post_init__(self):
        self.known: dict[int, tuple[int, frozenset[int]]] = {}

    def ending(self, state: int, length: int) -> tuple[int, frozenset[int]]:
        """The longest window that ends at a state matched to `length` words, and the items of all that end there."""
        key = state * (self.window + 1) + length
        if key not in self.known:
            best, found = 0, set()
            while state > 0:
                for size, items in self.windows.get(state, ()):
                    if size <= length:
                        best = max(best, size)
                        found.update(items)
                state = int(self.link[state])
            self.known[key] = best, frozenset(found)
        return self.known[key]

    def _stretches(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of stretches that may hold a window."""
        known = codes >= 0
        joined = np.zeros(len(codes), bool)  # a word and the one before it
        joined[1:] = known[1:] & known[:-1]
        inner = bounds[1:-1]
        joined[inner[inner < len(codes)]] = False
        at = np.flatnonzero(joined)
        slots = mix(codes[at - 1].astype(np.uint64) << np.uint64(32) | codes[at].astype(np.uint64)) & np.uint64(len(self.neighbours) - 1)
        joined[at] = self.neighbours[slots]
        if self.least < 2:
            starts = np.flatnonzero(known & ~joined)
        else:
            starts = np.flatnonzero(~joined[:-1] & joined[1:])
        after = np.flatnonzero(~np.concatenate([joined, [False]]))
        ends = after[np.searchsorted(after, starts, side="right")]
        long = ends - starts >= self.least
        return starts[long], ends[long]

    def stream(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a window may end, with the automaton's state there and the matched length (`window` at most)."""
        starts, ends = self._stretches(codes, bounds)
        step = _PIECE - (self.window - 1)
        pieces = np.maximum(-(-(ends - starts - (self.window - 1)) // step), 1)
        own = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[own] + nth * step
        size = np.minimum(ends[own], begin + _PIECE) - begin
        order = np.argsort(-size, kind="stable")
        begin, size, warm = begin[order], size[order], np.where(nth[order] > 0, self.window - 1, 0)
        state, length = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        places, states, lengths = [], [], []
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, side="left"))
            words = codes[begin[:live] + t].astype(np.uint64)
            todo = np.arange(live)
            while len(todo):
                keys = state[todo].astype(np.uint64) << np.uint64(32) | words[todo]
                at = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
                there = self.edges[at] == keys
                go, todo = todo[there], todo[~there]
                state[go] = self.targets[at[there]]
                length[go] += 1
                todo = todo[state[todo] > 0]
                state[todo] = self.link[state[todo]]
                length[todo] = self.length[state[todo]]
            end = np.flatnonzero((length[:live] >= self.least) & (t >= warm[:live]))
            if len(end):
                places.append(begin[end] + t)
                states.append(state[end].copy())
                lengths.append(np.minimum(length[end], self.window))
        if not places:
            none = np.zeros(0, np.int64)
            return none, none, none
        return np.concatenate(places), np.concatenate(states), np.concatenate(lengths)

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, frozenset[int]]]:
        """A mark for each word of all texts, n + 1 offsets of the texts' words, and the items by number of the text."""
        words, bounds = words_of(texts)
        codes = pc.fill_null(pc.index_in(words, self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        places, states, lengths = self.stream(codes, bounds)
        marks = np.zeros(len(codes) + 1, np.int64)
        found: dict[int, frozenset[int]] = {}
        if len(places):
            kinds, where = np.unique(states * (self.window + 1) + lengths, return_inverse=True)
            told = [self.ending(k // (self.window + 1), k % (self.window + 1)) for k in kinds.tolist()]
            best = np.array([b for b, _ in told])[where]
            ends = best > 0
            np.add.at(marks, places[ends] - best[ends] + 1, 1)
            np.add.at(marks, places[ends] + 1, -1)
            text = np.searchsorted(bounds, places[ends], side="right") - 1
            for key in np.unique(text * len(kinds) + where[ends]).tolist():
                i, kind = divmod(key, len(kinds))
                found[i] = found.get(i, frozenset()) | told[kind][1]
        return np.cumsum(marks)[:-1] > 0, bounds, found


def build(chunks: list[tuple[list[str], list[str]]], window: int) -> bytes:
    """The automaton of chunks (words, item ids), packed."""
    vocabulary: dict[str, int] = {}
    items: dict[str, int] = {}
    coded = []
    for words, ids in chunks:
        coded.append(([vocabulary.setdefault(w, len(vocabulary)) for w in words], [items.setdefault(i, len(items)) for i in ids]))
    builder = _Builder()
    for words, _ in coded:
        builder.add(words)
    ends: dict[tuple[int, int], set[int]] = {}
    for words, ids in coded:
        state, size = 0, min(window, len(words))
        for i, word in enumerate(words):
            state = builder.next[state][word]
            if i + 1 >= size:
                ends.setdefault((builder.at(state, size), size), set()).update(ids)
    windows: dict[int, list] = {}
    for (state, size), ids in ends.items():
        windows.setdefault(state, []).append((size, tuple(sorted(ids))))
    edges = np.array([s << 32 | w for s, e in enumerate(builder.next) for w in e], np.uint64)
    targets = np.array([t for e in builder.next for t in e.values()], np.int64)
    order = np.argsort(edges)
    pairs = {a << 32 | b for words, _ in coded for a, b in zip(words, words[1:])}
    neighbours = np.zeros(1 << max(16, (16 * len(pairs)).bit_length()), bool)
    neighbours[mix(np.array(list(pairs), np.uint64)) & np.uint64(len(neighbours) - 1)] = True
    made = {
        "vocabulary": list(vocabulary), "edges": edges[order], "targets": targets[order], "link": np.array(builder.link), "length": np.array(builder.length),
        "neighbours": np.packbits(neighbours), "windows": windows, "items": list(items), "window": window, "least": min((k[1] for k in ends), default=window),
    }
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(made))


_LOADED: dict[bytes, Automaton] = {}


def _load(packed: bytes) -> Automaton:
    """The worker's automaton for a part; only the latest is kept."""
    key = xxhash.xxh3_128_digest(packed)
    if key not in _LOADED:
        _LOADED.clear()
        made = pickle.loads(zstandard.ZstdDecompressor().decompress(packed))
        made["vocabulary"] = pa.array(made["vocabulary"], pa.large_string())
        made["neighbours"] = np.unpackbits(made["neighbours"]).astype(bool)
        _LOADED[key] = Automaton(**made)
    return _LOADED[key]


def automata(items: DataFrame, window: int = 10, part_words: int = 200_000, chunk_words: int = 5_000, id_col: str = "item_id", text_col: str = "text") -> list[Broadcast]:
    """The items' automata, sent to the workers: one for each part."""
    spark = items.sparkSession
    step = chunk_words - (window - 1)
    if step < 1:
        raise ValueError("chunk_words must be at least the window")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = words_of(filled(batch.column("text")))
            found, ids = [], []
            for item, lo, hi in zip(batch.column("item").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                for start in range(lo, max(hi - window + 1, lo + (hi > lo)), step):
                    found.append(" ".join(words[start : min(start + chunk_words, hi)].to_pylist()))
                    ids.append(item)
            digests = [xxhash.xxh3_128_digest(c.encode()) for c in found]
            sizes = [c.count(" ") + 1 for c in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(digests, pa.binary()), pa.array(found, pa.string()), pa.array(sizes, pa.int64())], ["item", "digest", "chunk", "size"])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    chunks = materialize(rows.mapInArrow(cut, "item string, digest binary, chunk string, size long"), "automaton-chunks")
    distinct = chunks.groupBy("digest").agg(F.first("chunk").alias("chunk"), F.first("size").alias("size"))
    total = distinct.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_words))
    part = F.pmod(F.xxhash64("digest"), F.lit(parts))
    named = chunks.select(part.alias("part"), "digest", "item").distinct()

    def make(left: pa.Table, right: pa.Table) -> pa.Table:
        ids: dict[bytes, list[str]] = {}
        for digest, item in zip(right.column("digest").to_pylist(), right.column("item").to_pylist()):
            ids.setdefault(digest, []).append(item)
        own = sorted(zip(left.column("digest").to_pylist(), left.column("chunk").to_pylist()))
        return pa.table({"made": pa.array([build([(c.split(" "), ids[d]) for d, c in own], window)], pa.binary())})

    made = distinct.select(part.alias("own"), "digest", "chunk").groupBy("own").cogroup(named.groupBy("part")).applyInArrow(make, "made binary")
    # a part is bounded by part_words; they come to the driver one by one
    return [spark.sparkContext.broadcast(bytes(r["made"])) for r in materialize(made, "automaton-parts").toLocalIterator()]


def _spans(marks: np.ndarray) -> np.ndarray:
    """Starts and ends of the stretches of marked words, one row for each."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2).astype("<i8")


_MARKS = "doc_id long, check string, n_words long, spans binary, items array<string>"


def _rows(docs: DataFrame, check: bool, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), (_check(text) if check else F.lit("")).alias("check"))


def _check(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _marked(rows: DataFrame, part: Broadcast | None, all_rows: bool) -> DataFrame:
    """One pass over (doc_id, text, check): (doc_id, check, n_words, spans, items) for all rows, or for those with hits only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        automaton = _load(part.value) if part else None
        for batch in sliced(batches, "text", 4 << 20):
            texts = filled(batch.column("text"))
            if automaton is None:
                bounds, marks, found = words_of(texts)[1], np.zeros(0, bool), {}
            else:
                marks, bounds, found = automaton.hits(texts)
            own = list(range(len(texts))) if all_rows else sorted(found)
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("check").take(at),
                    pa.array(np.diff(bounds)).take(at),
                    pa.array([_spans(marks[bounds[i] : bounds[i + 1]]).tobytes() if i in found else b"" for i in own], pa.binary()),
                    pa.array([sorted(automaton.items[k] for k in found[i]) if i in found else [] for i in own], pa.list_(pa.string())),
                ],
                ["doc_id", "check", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(run, _MARKS)


def _united(table: pa.Table) -> pa.Table:
    """The hits of all parts in the rows of one id and text."""
    marks, items = np.zeros(int(table.column("n_words")[0].as_py()), bool), set()
    for packed, own in zip(table.column("spans").to_pylist(), table.column("items").to_pylist()):
        items.update(own)
        for a, b in np.frombuffer(packed, "<i8").reshape(-1, 2).tolist():
            marks[a:b] = True
    return pa.table(
        {
            "hit_id": table.column("doc_id")[:1],
            "hit_check": table.column("check")[:1],
            "spans": pa.array([_spans(marks).tobytes()], pa.binary()),
            "items": pa.array([sorted(items)], pa.list_(pa.string())),
        }
    )


def _found(rows: DataFrame, parts: list[Broadcast]) -> DataFrame:
    """(hit_id, hit_check, spans, items) for each id and text that any part hits; a pass over the rows for each part."""
    found = None
    for part in parts:
        # equal rows have equal hits: one of them is enough
        own = materialize(_marked(rows, part, False).dropDuplicates(["doc_id", "check"]), "decontaminate-hits")
        found = own if found is None else found.unionByName(own)
    return found.groupBy("doc_id", "check").applyInArrow(_united, "hit_id long, hit_check string, spans binary, items array<string>")


def scan(docs: DataFrame, parts: list[Broadcast], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, items) for every row: packed stretches of hit words, and the ids of items with occurring windows."""
    if len(parts) <= 1:
        return _marked(_rows(docs, False, id_col, text_col), parts[0] if parts else None, True).drop("check")
    rows = _rows(docs, True, id_col, text_col)
    every = _marked(rows, None, True).drop("spans", "items")
    joined = every.join(_found(rows, parts), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("check") == F.col("hit_check")), "left")
    return joined.select("doc_id", "n_words", F.coalesce("spans", F.lit(b"")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, items: DataFrame, window: int = 10, part_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest) for every row; longest: words in the longest hit stretch."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.diff(np.frombuffer(s, "<i8").reshape(-1, 2), axis=1) if s else np.zeros(1, np.int64) for s in batch.column("spans").to_pylist()]
            items = batch.column("items").to_pylist()
            hit = np.array([int(s.sum()) for s in sizes], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array(hit),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() if x else _NONE for x in items]),
                    pa.array(hit > 0),
                    pa.array([int(s.max()) for s in sizes], pa.int64()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"],
            )

    scanned = scan(docs, automata(items, window, part_words), id_col, text_col)
    return scanned.mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long")


def clean(
    docs: DataFrame, items: DataFrame, window: int = 10, longest: int = 0, coverage: float = 0.5, part_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with all columns: hit stretches of more than `longest` words are cut out of the texts, from the first
    word to the last, and rows whose hit words are more than `coverage` of all are dropped. A null text stays null."""
    parts = automata(items, window, part_words)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = {c: n for c, n in zip(docs.columns, names)}
    text = own[text_col]
    rows = docs.toDF(*names).withColumn(text, F.col(text).cast("string"))
    schema = rows.schema
    if len(parts) > 1:
        hit = _found(_rows(docs, True, id_col, text_col), parts).drop("items")
        same = F.col(own[id_col]).cast("long").eqNullSafe(F.col("hit_id")) & (_check(F.col(text)) == F.col("hit_check"))
        rows = rows.join(hit, same, "left").select(*names, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, text, 4 << 20):
            column = batch.column(text)
            texts = filled(column)
            if len(parts) > 1:
                bounds = words_of(texts)[1]
                marks = np.zeros(int(bounds[-1]), bool)
                for lo, packed in zip(bounds[:-1].tolist(), batch.column("spans").to_pylist()):
                    for a, b in np.frombuffer(packed or b"", "<i8").reshape(-1, 2).tolist():
                        marks[lo + a : lo + b] = True
            else:
                marks, bounds, _ = _load(parts[0].value).hits(texts) if parts else (np.zeros(int(words_of(texts)[1][-1]), bool), words_of(texts)[1], None)
            before = np.concatenate([[0], np.cumsum(marks)])
            hit = before[bounds[1:]] - before[bounds[:-1]]
            stays = hit <= coverage * np.diff(bounds)
            if (stays & (hit > 0)).any():
                starts, ends = _edges(texts)
                data, offsets = texts.buffers()[2].to_pybytes(), np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
                left = column.to_pylist()
                for i in np.flatnonzero(stays & (hit > 0)).tolist():
                    kept, at = [], offsets[i]
                    for a, b in (_spans(marks[bounds[i] : bounds[i + 1]]) + bounds[i]).tolist():
                        if b - a > longest:
                            kept.append(data[at : starts[a]])
                            at = ends[b - 1]
                    left[i] = b"".join([*kept, data[at : offsets[i + 1]]]).decode()
                column = pa.array(left, pa.string())
            columns = [column.cast(pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays))

    return rows.mapInArrow(run, schema).toDF(*docs.columns)


def report_sql(window: int = 10) -> str:
    """DuckDB SQL for report()'s first six columns over `documents` and `benchmark`."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {words} AS w FROM documents
), items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), {window}) AS size, array_to_string(w[i : i + least(len(w), {window}) - 1], ' ') AS text
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window} + 2, 2))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), grams AS (
  SELECT d, i, size, array_to_string(w[i : i + size - 1], ' ') AS text
  FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS i FROM docs) CROSS JOIN sizes WHERE i + size - 1 <= len(w)
), found AS (SELECT d, i, size, item FROM grams JOIN windows USING (size, text)
), hit AS (SELECT d, count(DISTINCT p) AS n_hit FROM (SELECT d, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT d, i, size FROM found)) GROUP BY d
), named AS (SELECT d, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT d, item FROM found) GROUP BY d
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (d) LEFT JOIN named USING (d)
"""
