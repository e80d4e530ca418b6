"""Exact top-k by inner product with a pivot-distance index.

Vectors of unequal norm are lifted by one component to equal norm, so that the largest inner product is
the smallest distance. Each is keyed by its nearest pivot and its distance to it; distances are cut into
annuli. A query first visits the annuli nearest to it until they hold k rows, which bounds the distance
of its k-th neighbour; then those that the triangle inequality cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import map_rows, sampled, written

#: Rows of an annulus block and queries of a query block that meet in one task.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 4_096
#: Rows from which pivots are chosen, about.
PIVOT_SAMPLE = 4_096
RINGS = 4


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v, norm2, dim): floor(scale * x) of each component, as doubles in bytes.

    Vectors that are null, without id, or hold a null or non-finite component are left out.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for vec_id, values in rows:
            if vec_id is None or values is None or None in values:
                continue
            x = np.asarray(values, np.float64)
            if np.isfinite(x).all():
                v = np.floor(scale * x)
                yield vec_id, v.tobytes(), float(v @ v), len(v)

    columns = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return map_rows(columns, run, "vec_id bigint, v binary, norm2 double, dim int")


def _lift(v: np.ndarray, norm2: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(most - norm2, 0))[:, None]])


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(gap, 0))


class Index:
    """Pivots and annuli of one dimension; ``rows`` has vec_id, v, norm2, annulus, part."""

    def __init__(self, rows: DataFrame, dim: int, n: int, most: float):
        self.dim, self.most = dim, most
        chosen = sampled(rows, PIVOT_SAMPLE, n, "vec_id").select("v", "norm2", "vec_id")
        sample = sorted(chosen.collect(), key=lambda r: r["vec_id"]) or rows.select("v", "norm2").limit(1).collect()
        lifted = _lift(
            np.array([np.frombuffer(r["v"]) for r in sample]), np.array([r["norm2"] for r in sample]), most
        )
        self.pivots = _spread(lifted, int(np.clip(n // 4_000, 1, 1024)))
        own, r = _nearest(lifted, self.pivots)
        # Equal shares of the sampled distances of each pivot; the outer rings are open.
        cuts = np.full((len(self.pivots), RINGS - 1), np.inf)
        for p in range(len(self.pivots)):
            if (own == p).sum() >= RINGS:
                cuts[p] = np.quantile(r[own == p], np.arange(1, RINGS) / RINGS)
        pivots = self.pivots

        def place(batch: Iterator[tuple]) -> Iterator[tuple]:
            for vec_id, v, norm2 in batch:
                x = _lift(np.frombuffer(v)[None, :], np.array([norm2]), most)
                p, distance = (a[0] for a in _nearest(x, pivots))
                ring = int(np.searchsorted(cuts[p], distance))
                yield vec_id, v, norm2, int(p) * RINGS + ring, float(distance)

        placed = map_rows(
            rows.select("vec_id", "v", "norm2"), place,
            "vec_id bigint, v binary, norm2 double, annulus int, distance double",
        )
        self.rows = written(placed, "pivot-index")
        found = self.rows.groupBy("annulus").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"))
        # At most 1024 pivots times RINGS rows.
        table = sorted(found.collect())
        self.annuli, self.counts, self.low, self.high = (np.array(c) for c in zip(*table))


def _bounds(v: np.ndarray, pivots: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance from the lifted queries to a row of each annulus."""
    d = _apart(np.hstack([v, np.zeros((len(v), 1))]), pivots)[:, own]
    return np.maximum(0, np.maximum(d - high, low - d))


def _spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other: each next one is the row farthest from those chosen."""
    chosen = [sample[0]]
    far = _apart(sample, sample[:1])[:, 0]
    while len(chosen) < n and far.max() > 0:
        chosen.append(sample[int(far.argmax())])
        far = np.minimum(far, _apart(sample, chosen[-1][None, :])[:, 0])
    # Two steps of averaging put them inside their groups.
    pivots = np.array(chosen)
    for _ in range(2):
        own, _ = _nearest(sample, pivots)
        pivots = np.array([sample[own == p].mean(0) if (own == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _apart(x, pivots)
    own = d.argmin(1)
    return own, d[np.arange(len(x)), own]


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest one left."""
    order, left = [0], list(range(1, len(pivots)))
    while left:
        d = _apart(pivots[order[-1]][None, :], pivots[left])[0]
        order.append(left.pop(int(d.argmin())))
    return np.array(order)


def _query_blocks(index: Index, queries: DataFrame) -> DataFrame:
    """``queries`` with ``block``: those of near pivots together, about ``BLOCK_QUERIES`` in each.

    Queries of one block visit much the same annuli, so that an annulus meets few blocks.
    """
    pivots = index.pivots

    def place(rows: Iterator[tuple]) -> Iterator[tuple]:
        for query_id, v, norm2 in rows:
            x = np.hstack([np.frombuffer(v)[None, :], np.zeros((1, 1))])
            yield query_id, v, norm2, int(_nearest(x, pivots)[0][0])

    homes = written(map_rows(queries, place, "query_id bigint, v binary, norm2 double, home int"), "queries")
    # One row a pivot.
    counts = {r["home"]: r["n"] for r in homes.groupBy("home").agg(F.count("*").alias("n")).collect()}
    base, shares, block, held = [0] * len(pivots), [1] * len(pivots), 0, 0
    for home in _chain(pivots).tolist():
        n = counts.get(home, 0)
        if held and held + n > BLOCK_QUERIES:
            block, held = block + 1, 0
        base[home], shares[home] = block, max(1, -(-n // BLOCK_QUERIES))
        held += n
        if shares[home] > 1:
            block, held = block + shares[home], 0
    at = [F.element_at(F.array(*[F.lit(x) for x in values]), F.col("home") + 1) for values in (base, shares)]
    return homes.select("query_id", "v", "norm2", (at[0] + F.pmod(F.xxhash64("query_id"), at[1])).cast("int").alias("block"))


def _visit(index: Index, queries: DataFrame, k: int, first: bool) -> DataFrame:
    """(query_id, block, v, least, annulus): the annuli that a query visits in this round.

    First the nearest until they hold k + 1 rows; then all others whose bound is not beyond the
    distance of the k-th score so far (``least``).
    """
    counts, annuli, most = index.counts, index.annuli, index.most
    pivots, low, high = index.pivots, index.low, index.high

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for query_id, block, v, norm2, least in rows:
            bound = _bounds(np.frombuffer(v)[None, :], pivots, annuli // RINGS, low, high)[0]
            order = np.lexsort((annuli, bound))
            held = np.cumsum(counts[order])
            near = int(np.searchsorted(held, k + 1)) + 1
            if first:
                for a in order[:near]:
                    yield query_id, block, v, float("-inf"), int(annuli[a])
            else:
                reach = np.inf if least is None else np.sqrt(max(0.0, most + norm2 - 2 * least)) + 1e-6
                for a in order[near:]:
                    if bound[a] > reach:
                        break
                    yield query_id, block, v, float("-inf") if least is None else float(least), int(annuli[a])

    columns = queries.select("query_id", "block", "v", "norm2", "least")
    return map_rows(columns, run, "query_id bigint, block int, v binary, least double, annulus int")


def _meeting_rows(index: Index, visits: DataFrame, parts: DataFrame) -> DataFrame:
    """(annulus, part, block, vec_id, v): each row once for each query block that visits its annulus.

    The part of an annulus is in the join's key, so that a full annulus is no hot key.
    """
    pairs = visits.select("annulus", "block").distinct().join(F.broadcast(parts), "annulus")
    pairs = pairs.select(
        F.col("annulus").alias("annulus"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("block").alias("block")
    )
    rows = index.rows.join(F.broadcast(parts), "annulus")
    rows = rows.select("annulus", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), "vec_id", "v")
    return rows.join(pairs, ["annulus", "part"])


def _meet(index: Index, visits: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each visited block, none below the query's bound."""
    spark = visits.sparkSession
    parts = spark.createDataFrame(
        [(int(a), -(-int(n) // BLOCK_ROWS)) for a, n in zip(index.annuli, index.counts)], "annulus int, parts int"
    )
    rows = _meeting_rows(index, visits, parts)
    asked = visits.join(F.broadcast(parts), "annulus").select(
        "annulus", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "query_id", "v", "least"
    )

    def best(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(left) and len(right):
            left = left.sort_values("vec_id", kind="stable")
            ids = left["vec_id"].to_numpy()
            x = np.array([np.frombuffer(v) for v in left["v"]])
            for start in range(0, len(right), 256):
                q = right.iloc[start : start + 256]
                scores = np.array([np.frombuffer(v) for v in q["v"]]) @ x.T
                own = q["query_id"].to_numpy()
                scores[own[:, None] == ids[None, :]] = -np.inf
                bar = q["least"].to_numpy()
                if len(ids) > k:
                    bar = np.maximum(bar, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
                i, j = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
                s = scores[i, j]
                order = np.lexsort((j, -s, i))  # ids ascend with j
                i, j, s = i[order], j[order], s[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                keep = place < k
                out.append(pd.DataFrame({"query_id": own[i[keep]], "vec_id": ids[j[keep]], "score": s[keep].astype("int64")}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    keys = ["annulus", "part", "block"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(best, "query_id bigint, vec_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 20, modulus: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query, ties to smaller ids.

    Queries are rows whose id is divisible by ``modulus``. Vectors meet only those of their own length, empty ones too.
    A row never meets rows of its own id; of repeated rows each counts as a candidate, and a repeated
    query is asked once. An empty table gives an empty result. Scores are exact below 2**53.
    """
    spark = vectors.sparkSession
    table = written(quantised(vectors, scale), "quantised")
    sizes = table.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm2").alias("most")).collect()
    results = []
    for dim, n, most in sorted(sizes):
        rows = table.filter(F.col("dim") == dim)
        index = Index(rows, dim, n, most)
        queries = (
            rows.filter(F.col("vec_id") % modulus == 0)
            .dropDuplicates(["vec_id", "v"])
            .select(F.col("vec_id").alias("query_id"), "v", "norm2")
        )
        queries = written(_query_blocks(index, queries), "query-blocks").withColumn("least", F.lit(None).cast("double"))
        near = written(_ranked(_meet(index, _visit(index, queries, k, True), k), k), "top-near")
        least = near.filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
        known = queries.drop("least").join(least, "query_id", "left")
        far = _meet(index, _visit(index, known, k, False), k)
        results.append(_ranked(near.select("query_id", "vec_id", "score").unionByName(far), k))
    if not results:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("query_id", "rank", "vec_id", "score")
