"""Text helpers that run inside tasks, on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The six characters that separate words, everywhere in this package.
SPACES = b" \t\n\x0b\x0c\r"


def filled(column: pa.Array) -> pa.Array:
    """Texts with nulls as empty texts, in the large layout so that no batch overflows 32-bit offsets.

    The texts are copied to the front of a buffer of their own: some Arrow functions (ascii_lower is one) give wrong
    bytes for a slice whose offsets do not start at zero.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = pc.fill_null(column.cast(pa.large_string()), "")
    return whole.take(pa.array(np.arange(len(whole))))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def sliced(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about max_bytes of text; a single longer text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where each text's words start: n + 1 offsets into them."""
    lists = pc.ascii_split_whitespace(texts)
    words, bounds = lists.values, np.asarray(lists.offsets)
    words, bounds = words.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
    real = np.asarray(pc.binary_length(words)) > 0
    if not real.all():
        before = np.concatenate([[0], np.cumsum(real)])
        words, bounds = words.filter(pa.array(real)), before[bounds]
    return words, bounds.astype(np.int64)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word and the table of distinct words that the numbers point into."""
    table = words.dictionary_encode()
    return np.asarray(table.indices).astype(np.int64), table.dictionary


def owners(bounds: np.ndarray) -> np.ndarray:
    """For n + 1 offsets, the number of the text that each position belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
