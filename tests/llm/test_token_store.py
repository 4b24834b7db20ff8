"""Token shards: exact round trips, random access, and the whole query against the tokenizers library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm import token_store as ts
from quarry.llm.chunks import vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 2, 7, 15, 16, 17, 20, 31, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 640, dtype=np.uint64).astype(np.uint32)
    data = ts.pack_bits(ids, width)
    assert len(data) == 640 * width // 8 and (ts.unpack_bits(data, width) == ids).all()


def test_width_is_the_least():
    assert [ts.bit_width(n) for n in (1, 2, 3, 256, 257, 32_000, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 15, 16, 16, 17]


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << 17, n, dtype=np.uint32) for n in (0, 1, 5000, 4096, 3, 0, 9000)]
    writer = ts.ShardWriter(f"file://{tmp_path}/a/x.ids", 17)
    for lo in range(0, len(docs), 3):
        some = docs[lo : lo + 3]
        writer.add(pa.array([None if i == 4 else i for i in range(lo, lo + len(some))], pa.int64()), np.concatenate(some), np.concatenate([[0], np.cumsum([len(d) for d in some])]))
    writer.close()
    reader = ts.ShardReader(f"file://{tmp_path}/a/x.ids")
    for i in (6, 2, 0, 5, 3, 1, 4):
        assert (reader.read(i, i + 1) == docs[i]).all()
    assert (reader.read(1, 5) == np.concatenate(docs[1:5])).all()
    assert reader.nulls.tolist() == [i == 4 for i in range(7)]
    (tmp_path / "a/y.ids").write_bytes((tmp_path / "a/x.ids").read_bytes()[:-3])
    with pytest.raises(ValueError):
        ts.ShardReader(f"file://{tmp_path}/a/y.ids")


def test_whole_query(spark, tmp_path):
    texts = {5: "Hello, World!", 1: "", 9: None, 3: "naïve  café\n\n\tx", 12: "word " * 30_000, 7: "Hello, World!", -4: "<|endoftext|> 's"}
    rows = [(i, t, 0) for i, t in texts.items()] + [(7, "a second text", 0), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = sorted(ts.store(docs, PATH, 49_408).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    start, want = 0, []
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])):  # repeated ids by hash of the text
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    folder = f"file://{tmp_path}/shards"
    manifest = ts.write_shards(docs, PATH, 49_408, 2, folder, task_bytes=40_000, shard_ids=1000)
    shards = sorted(manifest.collect(), key=lambda r: r.shard)
    assert len(shards) > 2 and [r.start for r in shards] == [0, *np.cumsum([r.n_ids for r in shards])[:-1]]
    assert sorted(map(tuple, ts.read_shards(manifest).collect()), key=lambda r: r[1]) == want
    assert ts.store(docs.limit(0), PATH, 49_408).count() == 0
