"""Media columns: content-addressed payloads in tar shards, with rows that carry digest, offset and length.

A payload is stored once for each digest of its stored form; here payloads are grey 8-bit PNG images, which keep every
byte. Each task appends to its own tar shard and stores a digest it has already written only once; the catalogue then
keeps one address for each digest in the whole table. (Copies that different tasks wrote before they knew of each other
stay in their shards as unreferenced members, as in any append-only store; moving all payloads through a shuffle to
spare them would cost more disk than they do.) The shards are ordinary tar files; members are named by digest.

Metadata columns (width, height, bit depth, colour type) are filled by range reads of the 33 bytes of a member's
header. Features need the samples, so they read the whole member, in the order of the shards.

A retried task writes a shard under a new name; only addresses of tasks that ended are in the catalogue.

Defined results: a null text counts as empty; an empty text is one row of 576 bytes 255; a very long text is one image,
stored and read whole; equal texts are one member with one address, the least of those that tasks wrote; rows with a
null id and repeated rows come out as they came in; an empty table writes nothing and gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._tables import materialize, new_path
from quarry.llm._text import byte_texts, sliced

WIDTH = 576
PAD = b"\xff"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_IHDR = struct.Struct(">IIBBBBB")
HEADER_BYTES = 33


def padded(text: bytes) -> bytes:
    """The text filled up with bytes 255 to a positive multiple of the width."""
    return text + PAD * (-len(text) % WIDTH or (0 if text else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 6) -> bytes:
    """A grey 8-bit image of WIDTH columns whose samples are the payload's bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each row starts with filter type 0
    raw[:, 1:] = rows
    head = _IHDR.pack(WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type, from the first 33 bytes."""
    if data[:8] != _SIGNATURE or data[12:16] != b"IHDR" or struct.unpack(">I", data[29:33])[0] != zlib.crc32(data[12:29]):
        raise ValueError("not the header of a PNG image")
    return _IHDR.unpack(data[16:29])[:4]


def from_png(data: bytes) -> bytes:
    """The samples of an image that to_png() wrote."""
    width, height, depth, colour = png_header(data[:HEADER_BYTES])
    if (depth, colour) != (8, 0):
        raise ValueError("only grey 8-bit images are read")
    at, body = HEADER_BYTES, []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        if zlib.crc32(data[at + 4 : at + 8 + size]) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged image")
        if kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if raw[:, 0].any():
        raise ValueError("only images without row filters are read")
    return raw[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean, deviation, entropy and a 64-bit average hash of the samples, as text."""
    x = np.frombuffer(payload, np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    seen = share[share > 0]
    parts = np.add.reduceat(x, np.arange(64) * len(x) // 64, dtype=np.int64) / np.diff(np.append(np.arange(64) * len(x) // 64, len(x)))
    bits = int.from_bytes(np.packbits(parts > x.mean()).tobytes(), "big")
    return f"mean={x.mean():.4f};sd={x.std():.4f};entropy={-(seen * np.log2(seen)).sum():.4f};ahash={bits:016x}"


class _Shard:
    """A tar file being written; knows where each member's data lies."""

    def __init__(self, path: str):
        system, where = fs.FileSystem.from_uri(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.path, self.out = path, system.open_output_stream(where)
        self.tar = tarfile.TarFile(fileobj=self.out, mode="w", format=tarfile.USTAR_FORMAT)

    def add(self, name: str, data: bytes) -> int:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        self.tar.addfile(info, io.BytesIO(data))
        return self.tar.offset - (len(data) + 511) // 512 * 512

    def close(self) -> None:
        self.tar.close()
        self.out.close()


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 256 << 20) -> DataFrame:
    """Write all payloads; (doc_id, n_bytes, digest, path, offset, length) of every row, materialized as the commit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: _Shard | None = None
        seen: dict[bytes, tuple[str, int, int]] = {}
        for batch in sliced(batches, "text", 2 << 20):
            found = []
            for text in byte_texts(batch.column("text")):
                image = to_png(padded(text))
                digest = hashlib.sha256(image)
                if (at := seen.get(digest.digest())) is None:
                    if shard is None or shard.tar.offset > shard_bytes:
                        if shard:
                            shard.close()
                        shard = _Shard(f"{folder}/media-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tar")
                    at = seen[digest.digest()] = (shard.path, shard.add(digest.hexdigest() + ".png", image), len(image))
                found.append((len(text), digest.hexdigest(), *at))
            size, digests, paths, offsets, lengths = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(digests), pa.array(paths), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["doc_id", "n_bytes", "digest", "path", "offset", "length"],
            )
        if shard:
            shard.close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, n_bytes long, digest string, path string, offset long, length long"), "media-rows")


def catalogue(stored: DataFrame) -> DataFrame:
    """(digest, path, offset, length): one address for each digest. Copies are merged before the shuffle."""
    one = stored.groupBy("digest").agg(F.min(F.struct("path", "offset", "length")).alias("a"))
    return one.select("digest", "a.path", "a.offset", "a.length")


def _reader():
    """Range reads with one open shard at a time; addresses come in the order of the shards."""
    opened: list = [None, None]

    def read(path: str, offset: int, length: int) -> bytes:
        if opened[0] != path:
            if opened[1]:
                opened[1].close()
            system, where = fs.FileSystem.from_uri(path)
            opened[:] = [path, system.open_input_file(where)]
        return opened[1].read_at(length, offset)

    return read


def with_headers(addresses: DataFrame, tasks: int = 1) -> DataFrame:
    """(digest, path, offset, length, width, height, bit_depth, colour_type), reading 33 bytes of each member.

    Addresses are small and members are not, so the caller states the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader()
        for batch in batches:
            if batch.num_rows:
                heads = [png_header(read(p, o, HEADER_BYTES)) for p, o in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist())]
                columns = [pa.array(c, pa.int32()) for c in zip(*heads)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "width", "height", "bit_depth", "colour_type"])

    dealt = addresses.select("digest", "path", "offset", "length").repartitionByRange(tasks, "path", "offset")
    ordered = dealt.sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(run, "digest string, path string, offset long, length long, width int, height int, bit_depth int, colour_type int")


def with_features(described: DataFrame) -> DataFrame:
    """Adds what needs the samples: payload_sha256, tail_crc32, media_sha256 and feature, from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                image = read(path, offset, length)
                payload = from_png(image)
                out.append((hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), hashlib.sha256(image).hexdigest(), feature_of(payload)))
            sha, crc, media, feature = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sha), pa.array(crc, pa.int64()), pa.array(media), pa.array(feature)],
                [*batch.schema.names, "payload_sha256", "tail_crc32", "media_sha256", "feature"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in described.schema)
    return described.mapInArrow(run, kinds + ", payload_sha256 string, tail_crc32 long, media_sha256 string, feature string")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_bytes: int = 8 << 20) -> DataFrame:
    """One row for each document: its address in the shards, metadata from headers, and features of the stored samples."""
    stored = store(docs, new_path(docs.sparkSession, "media-shards"), id_col, text_col)
    written = stored.agg(F.sum("length")).first()[0] or 0
    members = materialize(with_features(with_headers(catalogue(stored), max(1, -(-written // task_bytes)))), "media-members")
    return stored.select("doc_id", "n_bytes", "digest").join(members, "digest").select(
        "doc_id", "n_bytes",
        (F.col("width").cast("long") * F.col("height")).alias("payload_bytes"),
        "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), "media_sha256", "feature",
        F.col("path").alias("shard"), "offset", "width", "height", "bit_depth",
    )
