"""Quality rules: compression bands over whole documents and fixed chunks, beside plain word and line counts.

A text that says the same thing again and again compresses far better than prose, and noise or packed data hardly at
all. Each text is compressed with zstandard as a whole and in fixed chunks; compressed size over raw size must lie
in a band for the text's (or chunk's) length, because short inputs compress less whatever they hold.

A text of at most one chunk (4,096 bytes) is its own only chunk: whether that lies in the chunk band is reported, but
only the document band decides. Longer texts must meet both.

Defined results: a null text counts as empty (no words, so it fails); bytes that are not UTF-8 are counted as they
are; a ratio equal to a limit is within the band; very long texts are counted and compressed whole; rows with a null id
and repeated rows are judged like any other, one result for each row; an empty table gives no rows; other columns,
whatever their names, are ignored by judge() and passed through by keep_good().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._text import coded, filled, owners, sliced, split_words
from quarry.llm.chunks import release_tables

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_NOT_ASCII = bytes(range(128, 256))

#: (least length in bytes, lowest ratio, highest ratio): a length falls under the last row that it reaches.
#: Below 200 bytes nothing can be said. The highest ratios are for ASCII; WIDE is added by the share of other bytes, since
#: scripts of two and three bytes a letter compress less (a Chinese passage 0.94 at 300 bytes, 0.83 at 600).
#: Margin to the most that prose of 50 words or more reaches at sf0.1 (0.745 at 200 bytes, 0.679 at 600, 0.592 at 1,000,
#: 0.478 at 4,000, 0.437 at 16,000): about 0.1. Base64 and printable noise lie above at every length, random letters from 16,000
#: bytes on; shorter letters, and hex digits (0.51 to 0.58), compress like prose and stay.
DOCUMENT_BANDS = (
    (0, 0.0, 99.0), (200, 0.25, 0.85), (400, 0.25, 0.80), (600, 0.25, 0.76), (1_000, 0.20, 0.72), (2_000, 0.20, 0.68),
    (4_000, 0.12, 0.62), (16_000, 0.08, 0.56), (64_000, 0.05, 0.54),
)
CHUNK_BANDS = ((0, 0.0, 99.0), (200, 0.0, 0.87), (400, 0.0, 0.82), (600, 0.0, 0.77), (1_000, 0.10, 0.74), (2_000, 0.10, 0.70), (4_000, 0.08, 0.64))
WIDE = 0.2


@dataclass(frozen=True)
class Bands:
    """Parameters of the compression bands; a text goes if its own ratio or too many chunks' ratios are out of band."""

    document: tuple[tuple[int, float, float], ...] = DOCUMENT_BANDS
    chunk: tuple[tuple[int, float, float], ...] = CHUNK_BANDS
    chunk_bytes: int = 4096
    bad_chunk_share: float = 0.25
    level: int = 3
    wide: float = WIDE


def in_band(ratio: float, length: int, bands: tuple[tuple[int, float, float], ...], more: float = 0.0) -> bool:
    low, high = 0.0, 99.0
    for least, lo, hi in bands:
        if length >= least:
            low, high = lo, hi
    return low <= ratio <= high + more


def _more(text: bytes, bands: Bands) -> float:
    """What the share of bytes that are not ASCII adds to the highest ratio."""
    return bands.wide * (len(text) - len(text.translate(None, _NOT_ASCII))) / len(text)


def compression_verdict(text: bytes, bands: Bands, press: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, its chunks, how many of those are out of band, and whether the text stays."""
    if not text:
        return 1.0, 0, 0, True
    whole = len(press.compress(text)) / len(text)
    fits = in_band(whole, len(text), bands.document, _more(text, bands))
    if len(text) <= bands.chunk_bytes:
        return whole, 1, int(not in_band(whole, len(text), bands.chunk, _more(text, bands))), fits
    parts = [text[i : i + bands.chunk_bytes] for i in range(0, len(text), bands.chunk_bytes)]
    bad = sum(not in_band(len(press.compress(p)) / len(p), len(p), bands.chunk, _more(p, bands)) for p in parts)
    return whole, len(parts), bad, fits and bad <= bands.bad_chunk_share * len(parts)


def repeated_words(codes: np.ndarray, bounds: np.ndarray, span: int = 3) -> np.ndarray:
    """For each text, the words that stand in a window of `span` words which the text holds twice or more."""
    n_docs = len(bounds) - 1
    owner = owners(bounds)
    if len(codes) < span:
        return np.zeros(n_docs, np.int64)
    key = owner[: len(codes) - span + 1]
    whole = key == owner[span - 1 :]
    for k in range(span):  # renumber after each word, so that keys stay small and exact
        pair = key * (codes.max() + 1) + codes[k : len(codes) - span + 1 + k]
        key = np.unique(pair, return_inverse=True)[1]
    key = np.where(whole, key, -1)
    counts = np.bincount(key + 1)
    twice = (key >= 0) & (counts[key + 1] >= 2)
    covered = np.zeros(len(codes), bool)
    for k in range(span):
        covered[k : len(codes) - span + 1 + k] |= twice
    return np.bincount(owner[covered], minlength=n_docs)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measures(texts: pa.Array, bands: Bands) -> dict[str, np.ndarray]:
    """All counts and verdicts of a batch of texts."""
    n = len(texts)
    raw = texts.cast(pa.large_binary()).to_pylist()
    words, bounds = split_words(texts)
    codes, _ = coded(words)
    n_words = np.diff(bounds)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
    starts = (data & 0xC0) != 0x80  # one code point each
    out = {
        "n_words": n_words,
        "word_chars": total(starts & ~_SPACE[data]),
        "n_symbols": total(_SYMBOL[data]),
        "n_dup_lines": np.fromiter(map(repeated_lines, raw), np.int64, n),
        "n_repeat_words": repeated_words(codes, bounds),
    }
    out["base_failed"] = (n_words < 50) | (100 * out["n_repeat_words"] > 50 * n_words)
    press = zstandard.ZstdCompressor(level=bands.level)
    judged = [compression_verdict(t, bands, press) for t in raw]
    out["ratio"] = np.array([j[0] for j in judged], np.float64)
    out["n_chunks"] = np.array([j[1] for j in judged], np.int64)
    out["n_bad_chunks"] = np.array([j[2] for j in judged], np.int64)
    out["kept"] = ~out["base_failed"] & np.array([j[3] for j in judged], bool)
    return out


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks"]
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row for each document: base counts, base_failed, kept, and the compression figures behind the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, "text", 2 << 20):
            found = measures(filled(batch.column("text")), bands)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c]) for c in _COLUMNS)], ["doc_id", *_COLUMNS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The documents that meet the base rules and the bands, all columns as they were; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in sliced(batches, text_col, 2 << 20):
            yield batch.filter(pa.array(measures(filled(batch.column(text_col)), bands)["kept"]))

    return docs.mapInArrow(run, docs.schema)
