"""Batches, slices and words against plain Python."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm import _text


def test_slices_give_the_same_words():
    texts = ["the Cat sat", "", "a b  c", " x ", None, "dog on mat. the", "é\tß\x0b\n"] * 5
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    for size in (1, 10, 17, 1000):
        seen = []
        for part in _text.sliced(iter([batch]), "text", size):
            words, bounds = _text.split_words(pc.ascii_lower(_text.filled(part.column("text"))))
            flat = words.to_pylist()
            seen += [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        assert seen == [[w.lower() for w in (t or "").split()] for t in texts]
    codes, table = _text.coded(words)
    assert table.take(pa.array(codes)).to_pylist() == flat
    assert _text.owners(np.array([0, 2, 2, 3])).tolist() == [0, 0, 2]
