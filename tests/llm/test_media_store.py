"""Media shards: exact round trips, ordinary tar files, header reads, and the whole query."""

import hashlib
import random
import tarfile
import zlib

import pytest

from quarry.llm import media_store as ms


def test_png_round_trip_and_header():
    rng = random.Random(1)
    for n in (0, 1, 575, 576, 577, 5000):
        text = bytes(rng.randrange(256) for _ in range(n))
        payload = ms.padded(text)
        assert len(payload) % 576 == 0 and len(payload) >= 576 and len(payload) - n < 577 and payload[:n] == text and set(payload[n:]) <= {255}
        image = ms.to_png(payload)
        assert ms.from_png(image) == payload and ms.png_header(image[:33]) == (576, len(payload) // 576, 8, 0)
    with pytest.raises(ValueError):
        ms.from_png(image[:60] + b"\x00" + image[61:])
    with pytest.raises(ValueError):
        ms.png_header(b"\x00" * 33)


def test_whole_query(spark, tmp_path):
    texts = ["", None, "short", "short", "é" * 288, "x" * 576, "word " * 40_000, "short"] + [f"text number {i} " * i for i in range(40)]
    rows = [(i, t, b"z") for i, t in enumerate(texts)] + [(2, "short", b"z"), (None, "short", b"z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest binary").repartition(3)
    got = ms.media_columns(docs).collect()
    assert len(got) == len(rows)
    places = {}
    for r in got:
        text = (texts[r.doc_id] if r.doc_id is not None else "short") or ""
        payload = ms.padded(text.encode())
        image = ms.to_png(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(text.encode()), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-32:]) and r.feature == ms.feature_of(payload)
        assert (r.media_bytes, r.media_sha256) == (len(image), hashlib.sha256(image).hexdigest())
        places.setdefault(r.media_sha256, set()).add((r.shard, r.offset))
    assert all(len(p) == 1 for p in places.values())
    for shard in {r.shard for r in got}:
        with tarfile.open(shard.removeprefix("file://")) as tar:
            members = {m.name: (m.offset_data, m.size) for m in tar}
            for r in got:
                if r.shard == shard:
                    assert members[r.media_sha256 + ".png"] == (r.offset, r.media_bytes)
    assert ms.media_columns(docs.limit(0)).count() == 0


def test_small_shards_rotate(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"{i} " * 900) for i in range(30)], "doc_id long, text string").coalesce(1)
    stored = ms.store(docs, f"file://{tmp_path}/shards", shard_bytes=5_000)
    assert stored.select("path").distinct().count() > 3
    assert ms.with_headers(ms.catalogue(stored)).filter("width = 576 and bit_depth = 8").count() == 30
