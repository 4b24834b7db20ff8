"""Chunk tables give the libraries' ids, whatever the white space."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm.chunks import tokenizer_table, vocabulary_path

BITS = ["a", "B", "é", " ", " ", "  ", "\n", "\n\n", "\t", "\x00", " ", "'s", "don't", "12", "!!", "İ", "Σ", "é", "́", "　", "​", "ﷺ", "<|endoftext|>", "</w>", "\x1c", "\x85", "▁"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    rng = random.Random(name)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", " ", "\n", "x" * 3000]
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.encode_special_tokens = True
    ids, bounds = tokenizer_table(vocabulary_path(name)).tokenize(pa.array(texts, pa.large_string()), end_id=2)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]
