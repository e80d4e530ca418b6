"""More than 64 languages."""

import random

from llm_text import sentence

from statlake.llm import language


def test_every_language_is_learned(spark, documents):
    rng = random.Random(4)
    docs = documents([(i, sentence(rng, 20), f"l{i % 70:02}") for i in range(210)])
    net = language.fit(docs, epochs=1)
    assert net.languages == [f"l{k:02}" for k in range(70)]
    assert net.bias.shape == (70,) and language.pooled(net, [b"some text", b""]).shape == (2, 70)
