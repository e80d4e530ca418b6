"""Packing against a tokenizer as it is loaded, and all triple complements."""

import zlib

import numpy as np

from statlake.llm import packing


def test_special_tokens_in_a_text(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["<|endoftext|>", "a <|startoftext|> b", "Word<|endoftext|>more, <|endoftext|><|endoftext|>!", "<|END", "plain words."]
    expected = []
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID], "<u4")
        expected.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    got = packing.pack(documents([(i, t, "en") for i, t in enumerate(texts)])).collect()
    assert sorted(tuple(r)[:5] for r in got) == expected


def test_triple_beyond_sixteen_lengths_that_do_not_do():
    counts = np.zeros(3001, np.int64)
    for s in (0, 1, 3, 4, 9, 10, 12, 13, 27, 28, 30, 31, 36, 37, 39, 40, 81):
        counts[[1300 + s, 400 - 2 * s]] = 1  # 3000 would need the first of them twice
    counts[1000] = 3
    assert packing._Counts(counts).triple(3000) == (1000, 1000, 1000)
