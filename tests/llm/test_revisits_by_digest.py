"""A page_id that repeats with other html."""

import hashlib

from statlake.llm import warc


def test_revisits_belong_to_their_payload(spark):
    a, b, c = ("x" * 1000, "y" * 1200, "z" * 1500)
    rows = [(1, a), (2, a), (1, b), (1, c), (3, c)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id bigint, url string, html string")
    best = {a: 2, b: 1, c: 3}
    expected = []
    for i, h in rows:
        again = best[h] > i
        expected.append((i, len(h), hashlib.sha1(h.encode()).hexdigest(), "revisit" if again else "response", best[h] if again else None))
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=str) == sorted(expected, key=str)
