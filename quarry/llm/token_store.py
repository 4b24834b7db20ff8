"""Token ids on disk at a fixed bit width, in shards that can be read at random.

Every id takes the fewest bits that the vocabulary needs. Ids are packed 64 at a time into `width` 64-bit words, so
packing and unpacking are a few numpy operations for whole blocks. A shard holds consecutive documents:

    header   magic "QIDS", version, width, ids in a block (little-endian 32-bit)
    blocks   BLOCK ids each, the last one padded; a block starts on a byte
    footer   offsets of the blocks, document ids, null flags, offsets of the documents in ids
    tail     where the footer starts, counts of blocks and documents (64-bit), magic

Any document is read by two offsets and the blocks between them. Shards are written by the tasks of a range shuffle
on the document id (and a hash of the text, so that one id with very many rows spreads over tasks), so shard order is id
order. The number of tasks follows the bytes of the texts, and a task starts a new shard when one has `shard_ids` ids.
A retried task writes under new names; the manifest, written last, names only files of tasks that ended.

Defined results: a null text counts as empty and is the end id alone; a very long text is tokenized whole and may be
longer than shard_ids; null ids come before all others; rows that repeat an id are in order of a hash of their text,
then of the text; equal rows are interchangeable, and each comes out; an empty table writes no shard and gives no rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._tables import materialize, new_path
from quarry.llm._text import filled, sliced
from quarry.llm.chunks import tokenizer_table

MAGIC = b"QIDS"
BLOCK = 4096
_HEAD, _TAIL = struct.Struct("<4sIII"), struct.Struct("<QQQ4s")


def bit_width(vocabulary: int) -> int:
    """Bits that ids below `vocabulary` need."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids at `width` bits each, least significant bit first; the count must be a multiple of 64."""
    lanes = ids.astype(np.uint64).reshape(-1, 64)
    words = np.zeros((len(lanes), width), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8", copy=False).tobytes()


def unpack_bits(data: bytes, width: int) -> np.ndarray:
    """The ids that pack_bits() packed, as uint32."""
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    lanes = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, lane] = value & mask
    return lanes.ravel()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard, block by block; holds less than a block of ids and the documents' offsets."""

    def __init__(self, path: str, width: int):
        system, where = _opened(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out, self.width = system.open_output_stream(where), width
        self.out.write(_HEAD.pack(MAGIC, 1, width, BLOCK))
        self.rest, self.blocks = np.zeros(0, np.uint32), [_HEAD.size]
        self.ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.total = 0

    def _blocks(self, ids: np.ndarray) -> None:
        self.out.write(pack_bits(ids, self.width))
        size = BLOCK * self.width // 8
        first = self.blocks[-1]
        self.blocks.extend(range(first + size, first + size * (len(ids) // BLOCK) + 1, size))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Documents in order: their ids one after the other, and n + 1 offsets into them."""
        self.ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        self.nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.ends.append(bounds[1:] + self.total)
        self.total += len(ids)
        held = np.concatenate([self.rest, ids])
        full = len(held) // BLOCK * BLOCK
        if full:
            self._blocks(held[:full])
        self.rest = held[full:]

    def close(self) -> None:
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.zeros(BLOCK - len(self.rest), np.uint32)]))
        docs = sum(map(len, self.ids))
        for part in (np.array(self.blocks, "<u8"), *self.ids, *self.nulls, np.zeros(1, "<u8"), *(e.astype("<u8") for e in self.ends)):
            self.out.write(part.tobytes())
        self.out.write(_TAIL.pack(self.blocks[-1], len(self.blocks) - 1, docs, MAGIC))
        self.out.close()


class ShardReader:
    """Reads documents of a shard by their places, without reading what lies between."""

    def __init__(self, path: str):
        system, where = _opened(path)
        self.file = system.open_input_file(where)
        size = self.file.size()
        magic, _, self.width, self.block = _HEAD.unpack(self.file.read_at(_HEAD.size, 0))
        foot, blocks, docs, closing = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or closing != MAGIC:
            raise ValueError(f"{path} is no shard of token ids, or was cut off")
        footer = self.file.read_at(size - _TAIL.size - foot, foot)
        cut = np.cumsum([8 * (blocks + 1), 8 * docs, docs])
        self.blocks = np.frombuffer(footer[: cut[0]], "<u8").astype(np.int64)
        self.doc_ids = np.frombuffer(footer[cut[0] : cut[1]], "<i8")
        self.nulls = np.frombuffer(footer[cut[1] : cut[2]], np.uint8).astype(bool)
        self.bounds = np.frombuffer(footer[cut[2] :], "<u8").astype(np.int64)

    def read(self, first: int, last: int) -> np.ndarray:
        """The ids of the documents at places first to last - 1, one after the other."""
        lo, hi = int(self.bounds[first]), int(self.bounds[last])
        if lo == hi:
            return np.zeros(0, np.uint32)
        a, b = lo // self.block, -(-hi // self.block)
        data = self.file.read_at(int(self.blocks[b] - self.blocks[a]), int(self.blocks[a]))
        return unpack_bits(data, self.width)[lo - a * self.block : hi - a * self.block]

    def close(self) -> None:
        self.file.close()


def write_shards(
    docs: DataFrame,
    tokenizer_path: str,
    vocabulary: int,
    end_id: int,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_bytes: int = 16 << 20,
    shard_ids: int = 16 << 20,
) -> DataFrame:
    """Tokenize and write all documents in ascending id order; the manifest (shard, path, n_docs, n_ids, start).

    One shuffle, of the texts by id range. The manifest is materialized: it is the commit of the shards that it names.
    """
    width = bit_width(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, writer, shard, n = tokenizer_table(tokenizer_path), None, TaskContext.get().partitionId() << 20, 0

        def closed() -> pa.RecordBatch:
            writer.close()
            row = {"shard": pa.array([shard], pa.int64()), "path": [path], "n_docs": pa.array([n], pa.int64()), "n_ids": pa.array([writer.total], pa.int64())}
            return pa.RecordBatch.from_pydict(row)

        for batch in sliced(batches, "text", 4 << 20):
            if writer is None:
                path = f"{folder}/shard-{shard:013d}-{uuid.uuid4().hex}.ids"
                writer, n = ShardWriter(path, width), 0
            ids, bounds = table.tokenize(filled(batch.column("text")), end_id)
            if len(ids) and int(ids.max()) >> width:
                raise ValueError(f"an id does not fit {width} bits")
            writer.add(batch.column("doc_id"), ids, bounds)
            n += batch.num_rows
            if writer.total >= shard_ids:
                yield closed()
                writer, shard = None, shard + 1
        if writer:
            yield closed()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(8).cast("long"))).first()[0] or 0
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(max(1, -(-size // task_bytes)), "doc_id", "h")
    ordered = dealt.sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    written = materialize(ordered.mapInArrow(run, "shard long, path string, n_docs long, n_ids long"), "token-manifest")
    # one row for each shard; the sum over them fixes where a shard starts
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return written.withColumn("start", F.coalesce(before, F.lit(0)))


def read_shards(manifest: DataFrame, ids_at_once: int = 1 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that the manifest names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["path"])
                bounds, docs, first = shard.bounds, len(shard.doc_ids), 0
                while first < docs:
                    last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + ids_at_once, side="right")) - 1)
                    data = memoryview(shard.read(first, last).astype("<u4", copy=False)).cast("B")
                    at = (4 * (bounds[first : last + 1] - bounds[first])).tolist()
                    crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[first:last], pa.int64(), mask=shard.nulls[first:last]),
                            pa.array(bounds[first:last] + row["start"]),
                            pa.array(np.diff(bounds[first : last + 1])),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    first = last
                shard.close()

    # a task for each shard: a stated number is not joined again by adaptive execution, however small the manifest is
    spread = manifest.select("shard", "path", "start").repartitionByRange(max(1, manifest.count()), "shard")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int = 2) -> DataFrame:
    """Write the documents' ids to fresh shards in the shared folder and return what reading them back gives."""
    folder = new_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, tokenizer_path, vocabulary, end_id, folder))
