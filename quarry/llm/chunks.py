"""Distinct-chunk tables: tokenize every distinct word-with-its-mark once and join the ids back by position.

Word-level tokenizers never let a token run from a non-space into the space that follows it. So a text cut at those
places can be tokenized piece by piece, and as words repeat, a batch has far fewer distinct pieces ("chunks") than
pieces. The table of a batch is made with Arrow, its chunks are tokenized, and the ids are taken by position, in Arrow as
well. A cache in each Python worker, bounded by the bytes of what it holds, spares chunks that an earlier batch has had:
two Arrow arrays, the chunks and their ids, which one look-up compares with the batch's table. When the cache is full,
the half that was not used for the longest time leaves. Nothing depends on what it holds.

The library takes longer over many short texts than over one long one, so chunks that it has not had are sent to it
some hundreds in a row, as they would stand in a text, and the ids are dealt back by the bytes that each stands for.
Chunks whose bytes the tokenizer may change in number go one by one.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MARK = "\x00"


def packed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of ids, one after the other, as an Arrow array of little-endian unsigned 32-bit bytes."""
    ends = np.concatenate([[0], 4 * np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])


def packed_lists(lists: list[list[int]]) -> pa.Array:
    """The same for lists of Python."""
    return pa.array([array("I", ids).tobytes() for ids in lists], pa.large_binary())


class ChunkTable:
    """Tokenizes batches of texts through a table of distinct chunks.

    encode: the ids of each of an array of chunks, as packed() has them. cut: the characters before which a text may be
    cut when the character before is not one of `space`. cache_bytes bounds the worker's cache (CACHED is what an entry
    takes beside its text and ids).
    """

    CACHED = 20

    def __init__(self, encode: Callable[[pa.Array], pa.Array], cut: str, space: str, cache_bytes: int = 16 << 20):
        self.encode, self.cut, self.cache_bytes = encode, cut, cache_bytes
        self.twice = f"[{space}][{cut}]"
        self.seam = re.compile(f"(?<=[^{_python_class(space)}])(?=[{cut}])")
        self.texts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.batch = np.zeros(0, np.int32), 0

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, dict[int, str]]:
        """All chunks, n + 1 offsets of the texts' chunks, and whole texts to take for a chunk by its place."""
        whole = pc.match_substring(texts, _MARK)
        odd = pc.or_(whole, pc.match_substring_regex(texts, self.twice))
        marked = texts
        for c in self.cut:
            marked = pc.replace_substring(marked, c, _MARK + c)
        taken: dict[int, str] = {}
        if pc.any(odd).as_py():
            fixed = []
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
                text = texts[i].as_py()
                if _MARK in text:  # kept in one piece
                    taken[i] = text
                    fixed.append("")
                else:
                    fixed.append(_MARK.join(self.seam.split(text)))
            marked = pc.replace_with_mask(marked, odd, pa.array(fixed, pa.large_string()))
        lists = pc.split_pattern(marked, _MARK)
        bounds = np.asarray(lists.offsets).astype(np.int64)
        flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        return flat, bounds, {int(bounds[i]): t for i, t in taken.items()}

    def ids_of(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk, as packed() has them."""
        found = pc.index_in(chunks, value_set=self.texts)
        unknown = found.is_null().to_numpy(zero_copy_only=False)
        place = found.fill_null(0).to_numpy().astype(np.int64)
        place[unknown] = len(self.texts) + np.arange(int(unknown.sum()))
        self.batch += 1
        self.used[place[~unknown]] = self.batch
        new = chunks.filter(pa.array(unknown))
        ids = self.encode(new)
        got = pa.concat_arrays([self.ids, ids])
        self._keep(new, ids)
        return got.take(pa.array(place))

    def _keep(self, chunks: pa.Array, ids: pa.Array) -> None:
        """Put new chunks into the cache; if it is full, drop those of longest ago until half of it is free."""
        short = pc.less_equal(pc.binary_length(chunks), 64)  # a longer one hardly comes again
        chunks, ids = chunks.filter(short), ids.filter(short)
        self.texts, self.ids = pa.concat_arrays([self.texts, chunks]), pa.concat_arrays([self.ids, ids])
        self.used = np.concatenate([self.used, np.full(len(chunks), self.batch, np.int32)])
        if self.texts.nbytes + self.ids.nbytes + self.used.nbytes > self.cache_bytes:
            takes = np.asarray(pc.add(pc.binary_length(self.texts), pc.binary_length(self.ids))) + self.CACHED
            order = np.argsort(-self.used, kind="stable")
            stay = np.sort(order[np.cumsum(takes[order]) <= self.cache_bytes // 2])
            self.texts, self.ids, self.used = self.texts.take(pa.array(stay)), self.ids.take(pa.array(stay)), self.used[stay]

    def tokenize(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, as uint32, and n + 1 offsets into them; end_id closes each text."""
        flat, bounds, whole = self._chunks(texts)
        table = flat.dictionary_encode()
        codes, chunks = np.asarray(table.indices), table.dictionary
        if whole:
            codes = codes.copy()
            codes[list(whole)] = len(chunks) + np.arange(len(whole))
            chunks = pa.concat_arrays([chunks, pa.array(list(whole.values()), pa.large_string())])
        ids = self.ids_of(chunks)
        if end_id is not None:
            codes = np.insert(codes, bounds[1:], len(ids))
            ids = pa.concat_arrays([ids, packed_lists([[end_id]])])
            bounds = bounds + np.arange(len(bounds))
        joined = ids.take(pa.array(codes))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(codes) + 1) // 4
        data = np.frombuffer(joined.buffers()[2] or b"", "<u4", int(ends[-1]))
        return data, ends[bounds]


class JoinedEncoder:
    """The ids of chunks by the tokenizers library, AT_ONCE chunks with known bytes in a row.

    Such chunks start with the only space in them, so in a row they are tokenized as each of them alone. Where their ids
    end follows from the bytes: all of a chunk's if the tokenizer has no normalizer; else those behind its space, for
    characters that it leaves as long as they are. Should an end not be met, the chunks go one by one.
    """

    AT_ONCE = 512

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.lossless = tokenizer, tokenizer.normalizer is None
        self.known = f"^[ \\n][^{ANY_SPACE}]+$" if self.lossless else f"^[ \\n][{_LATIN}]+$"
        entries, suffix = tokenizer.get_vocab(with_added_tokens=True), getattr(tokenizer.model, "end_of_word_suffix", None) or ""
        self.sizes = np.zeros(max(entries.values()) + 1, np.int64)
        self.sizes[list(entries.values())] = [len(e.removesuffix(suffix)) for e in entries]
        # a character of an entry is a byte only in byte-level vocabularies
        self.joins = set().union(*entries) <= set(ByteLevel.alphabet()) and (self.lossless or self._keeps_lengths())

    def _keeps_lengths(self) -> bool:
        """Whether the normalizer leaves the Latin characters as long as they are, whatever stands beside them."""
        kept = self.tokenizer.normalizer.normalize_str
        latin = [chr(c) for c in range(0x100) if re.match(f"[{_python_class(_LATIN)}]", chr(c))]
        pairs = (a + b for a in latin for b in latin)
        return all(len(kept(p).encode()) == len(p.encode()) for p in pairs)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _row(self, chunks: pa.Array) -> pa.Array | None:
        """The ids of chunks with known bytes; none if their ends are not met."""
        lengths = np.asarray(pc.binary_length(chunks))
        ends = np.cumsum(lengths)
        data = memoryview(chunks.buffers()[2])[np.frombuffer(chunks.buffers()[1], np.int64, chunks.offset + 1)[-1] :]
        cuts = [0, *ends[self.AT_ONCE - 1 : -1 : self.AT_ONCE].tolist(), int(ends[-1])]
        ids = np.concatenate([np.array(i, np.uint32) for i in self._ids([str(data[a:b], "utf-8") for a, b in zip(cuts, cuts[1:])])])
        want, got = np.cumsum(lengths if self.lossless else lengths - 1), np.cumsum(self.sizes[ids])
        last = np.searchsorted(got, want)
        if last[-1] != len(ids) - 1 or (got[last] != want).any():
            return None
        return packed(ids, np.diff(last, prepend=-1))

    def __call__(self, chunks: pa.Array) -> pa.Array:
        known = pc.match_substring_regex(chunks, self.known)
        row = self._row(chunks.filter(known)) if self.joins and pc.any(known).as_py() else None
        if row is None:
            return packed_lists(self._ids(chunks.to_pylist()))
        single = packed_lists(self._ids(chunks.filter(pc.invert(known)).to_pylist()))
        known = known.to_numpy(zero_copy_only=False)
        place = np.where(known, np.cumsum(known), len(row) + np.cumsum(~known)) - 1
        return pa.concat_arrays([row, single]).take(pa.array(place))


def _python_class(space: str) -> str:
    """The same character class for Python's re, which has no \\x{...}."""
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", space)


#: Every character that Unicode, or a tokenizer's idea of it, counts as white space.
ANY_SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}"
)
#: ASCII without space and control characters, and the letters of Latin-1.
_LATIN = r"!-~\x{c0}-\x{ff}"
_TABLES: dict[str, ChunkTable] = {}


def tokenizer_table(path: str) -> ChunkTable:
    """The worker's chunk table for a file of the tokenizers library, without added special tokens.

    The names of special tokens in a text are ordinary text.
    """
    if path not in _TABLES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        _TABLES[path] = ChunkTable(JoinedEncoder(tokenizer), " \n", ANY_SPACE)
    return _TABLES[path]


def release_tables() -> None:
    """Drop this worker's tables: workers are reused, and a stage that tokenizes nothing has no need of them."""
    _TABLES.clear()


def vocabulary_path(name: str) -> str:
    """Where the installed vocabulary file of that name is."""
    import public_tokenizers

    return public_tokenizers.path(name)
