"""Hard negatives against plain products of all vectors."""

import numpy as np
import pytest

from statlake.llm import negatives


def _plain(rows, modulus=100):
    """rows: distinct (vec_id, label, vector)."""
    out = []
    x = {}
    for i, label, v in rows:
        x.setdefault((i, label, tuple(np.floor(256 * np.asarray(v, float)).tolist())), None)
    held = list(x)
    for a, label, v in held:
        if a % modulus:
            continue
        scored = [(-int(np.dot(v, w)), i, own) for i, own, w in held if i != a and len(w) == len(v)]
        same = sorted(s for s in scored if s[2] == label)[:5]
        other = sorted(s for s in scored if s[2] != label)
        for p in same:
            fit = [s for s in other if 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(a, p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(fit)]
    return sorted(out)


def _frame(spark, rows):
    full = [(i, v, label, 1.0, "x", 3) for i, label, v in rows]
    return spark.createDataFrame(full, "vec_id bigint, embedding array<float>, label int, score double, v string, rank int")


def _float(v):
    return [float(np.float32(c)) for c in v]


@pytest.mark.parametrize("first", [4096, 8])
def test_negatives_by_brute_force(spark, monkeypatch, first):
    """Groups of directions and of lengths, one vector in a third of the rows, zero vectors; short segments walk far."""
    monkeypatch.setattr(negatives, "FIRST", first)
    monkeypatch.setattr(negatives, "GROWTH", 3)
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 1, (6, 12))
    rows = [(i, i % 4, _float((middles[i % 6] + rng.normal(0, 0.4, 12)) * rng.uniform(0.2, 2))) for i in range(700)]
    rows += [(1000 + i, i % 3, _float(middles[0])) for i in range(300)]
    rows += [(2000 + 50 * i, i % 2, [0.0] * 12) for i in range(12)]
    rows += [(3000 + 50 * i, i % 2, [0.5, 0.25 * i]) for i in range(8)] + [(4000 + 50 * i, i % 2, []) for i in range(6)]
    rows += [(100, 0, _float(middles[1])), (100, 0, _float(middles[1])), (101, 1, rows[101][2])]
    odd = [(None, 1, [0.1] * 12), (5000, None, [0.1] * 12), (5100, 1, None), (5200, 1, [None] * 12), (5300, 1, [float("nan")] * 12), (5400, 1, [float("inf")] * 12)]
    got = sorted(tuple(r) for r in negatives.mine(_frame(spark, rows + odd)).collect())
    assert got == _plain(rows)


def test_few_and_no_rows(spark):
    assert negatives.mine(_frame(spark, [(1, 1, [0.5])]).limit(0)).count() == 0
    assert negatives.mine(_frame(spark, [(1, 1, [0.5]), (7, 2, [0.5])])).count() == 0
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.4]), (2, 2, [0.5, 0.2]), (3, 2, [0.5, 0.6]), (4, 2, [-0.5, 0.0])]
    assert sorted(tuple(r) for r in negatives.mine(_frame(spark, rows)).collect()) == _plain(rows) != []


def test_walk_stops_early(spark, monkeypatch):
    """Of groups of close directions a member visits its own and little more."""
    monkeypatch.setattr(negatives, "FIRST", 64)
    seen = []
    inner = negatives._meet

    def counted(lists, active, members, begin, end, k, same):
        seen.append(sum(int(lists.counts[c, begin[c] : end[c]].sum()) for c in range(len(begin))))
        return inner(lists, active, members, begin, end, k, same)

    monkeypatch.setattr(negatives, "_meet", counted)
    rng = np.random.default_rng(6)
    middles = rng.normal(0, 1, (12, 24))
    rows = [(i, i % 3, _float(middles[i % 12] + rng.normal(0, 0.02, 24))) for i in range(2400)]
    lists = negatives.build(negatives.quantised(_frame(spark, rows), 256.0), 100, 11)
    wants = lists.anchors.selectExpr("q", "bigint(0) AS want", "double('-inf') AS lo", "double('inf') AS hi")
    assert negatives.walk(lists, wants, 5, True).count() == 24 * 5
    assert sum(seen) < 0.5 * len(rows) * len(lists.counts)
