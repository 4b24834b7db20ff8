"""The chunk-table codec against the sentencepiece library."""

import hashlib
import random

import pyarrow as pa
import sentencepiece

from quarry.llm import sentence_pieces as sp
from quarry.llm.chunks import vocabulary_path

PATH = vocabulary_path("piece_bpe_32k.model")
BITS = ["a", "Wort", "é", " ", "  ", "   ", "\n", "\t", "\x00", " ", "▁", "▁▁", "don't", "12", "🙂", "ﬁ", "<s>", "</s>", "<0x41>", "İ", "퟿", "漢字", "the", " of"]


def texts():
    rng = random.Random(8)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", " ", "  ", "▁", "a ", " a", "word " * 5000, "x" * 4000]


def test_ids_and_texts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    all_texts = texts()
    ids, bounds = sp.codec(PATH).encode(pa.array(all_texts, pa.large_string()))
    for i, text in enumerate(all_texts):
        want = model.encode(text, add_bos=False, add_eos=True)
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want, repr(text)


def test_whole_query_and_operator(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    some = texts()[:200] + texts()[-8:]
    rows = [(i, t, "x") for i, t in enumerate(some)] + [(3, some[3], "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sp.round_trip_digests(docs, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = model.encode(some[r.doc_id] if r.doc_id is not None else "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    encoded = sp.encode_documents(docs, PATH)
    decoded = {r.doc_id: r.text for r in sp.decode_documents(encoded, PATH).collect()}
    assert all(decoded[i] == model.decode(model.encode(t)) for i, t in enumerate(some))
    assert sp.round_trip_digests(docs.limit(0), PATH).count() == 0
