"""Invented words for the tests; languages differ in their syllables."""

import random

_SYLLABLES = {"en": "th er ing an ed st wh or".split(), "de": "sch ung ein ber zu ge ich".split()}


def sentence(rng: random.Random, n: int, language: str = "en") -> str:
    syllables = _SYLLABLES[language]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def labels_frame(spark, rows):
    flag = lambda x: None if x is None else int(x)
    return spark.createDataFrame([(i, flag(q), flag(t), "x") for i, q, t in rows], "doc_id bigint, quality int, toxic int, text string")
