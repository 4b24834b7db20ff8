"""Chunks go to the library many in a row, and the bounded cache changes no ids."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm.chunks import release_tables, tokenizer_table, vocabulary_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_full_cache_changes_no_ids(name):
    """Chunks come again in the same batch, in a later one, and after they have left the cache; all but some are sent in rows."""
    release_tables()
    table = tokenizer_table(vocabulary_path(name))
    table.cache_bytes = 4000
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.encode_special_tokens = True
    rng = random.Random(name)
    latin = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]]
    words = ["".join(rng.choice(latin) for _ in range(rng.randint(1, 9))) for _ in range(1500)] + ["ẖ", "H̱", "İx", "ΑΣ", "Ⱥ", "ＡＢ", "é", "漢字", "\x00a", "'S'S", "<|endoftext|>"]
    for _ in range(6):
        texts = [rng.choice(" \n").join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(30)] + ["", " "]
        ids, bounds = table.tokenize(pa.array(texts, pa.large_string()))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert table.texts.nbytes + table.ids.nbytes + table.used.nbytes <= 4000 and len(table.texts) == len(table.ids) == len(table.used)
    release_tables()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_chunks_reach_the_library_in_rows(name, monkeypatch):
    """10,000 distinct words were 10,000 texts for the library, which took longer over them than over a few long ones."""
    sent, made = [], Tokenizer.from_file

    class Counting:
        def __init__(self, path):
            self.__dict__["inner"] = made(path)

        def __getattr__(self, attribute):
            return getattr(self.inner, attribute)

        def __setattr__(self, attribute, value):
            setattr(self.inner, attribute, value)

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

    release_tables()
    monkeypatch.setattr("tokenizers.Tokenizer", type("Files", (), {"from_file": Counting}))
    text = "x " + " ".join(f"Wörter{i}," for i in range(10_000))
    ids, bounds = tokenizer_table(vocabulary_path(name)).tokenize(pa.array([text], pa.large_string()))
    release_tables()
    assert ids.tolist() == made(vocabulary_path(name)).encode(text, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids)]
    assert len(sent) < 100
