import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_text import sentence  # noqa: E402

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, label int, score double, version bigint, rank int"


@pytest.fixture
def documents(spark):
    """A table with columns whose names clash with those of the operators."""

    def build(rows):
        full = [(i, t, lang, "s", len(t or ""), 7, 0.5, 1, 3) for i, t, lang in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, repeated rows, rows without id, white space alone."""
    rng = random.Random(1)
    rows = [(i, sentence(rng, 80, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, " \n\t ", "de"), (103, LONG, "en"), (104, LONG + " end", None)]
    rows += [(105, rows[0][1], "de"), (105, rows[0][1], "de"), (None, rows[1][1], None), (None, None, None), (106, "12 34 !!", "en")]
    return documents(rows)
