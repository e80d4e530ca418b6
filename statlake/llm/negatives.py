"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. With the angle of a candidate to the centre and the widest angle of a
member to it, ``|candidate| * cos(max(0, angle - widest))`` times a member's length bounds their inner
product. For each cluster the candidates are put in order of that bound once, in bins; its members walk
down the list segment by segment, and a member stops when the bound of what is left cannot reach the last
score that it needs. Segments meet members in blocks, so a list of any length is walked by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import map_rows, sampled, written

#: Lists for one vector length; anchors from which their centres are fitted, about; bins of a list.
CLUSTERS, FIT_ANCHORS, BINS = 16, 4_096, 1_024
#: Rows of a list's first segment, and how much larger each next one is.
FIRST, GROWTH = 4_096, 8
#: Rows and members that meet in one task.
BLOCK_ROWS, BLOCK_MEMBERS = 16_384, 2_048
#: Added to angles and bounds for what arithmetic loses.
_ANGLE, _BOUND = 1e-6, 1e-9


def _matrix(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)


def quantised(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, label, v, norm, dim) with v the floor of scale * x as doubles in bytes.

    Rows without id or label and vectors that are null or hold a null or non-finite component are left out.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for vec_id, label, values in rows:
            if vec_id is None or label is None or values is None or None in values:
                continue
            x = np.asarray(values, np.float64)
            if np.isfinite(x).all():
                v = np.floor(scale * x)
                yield vec_id, label, v.tobytes(), float(np.sqrt(v @ v)), len(v)

    columns = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return map_rows(columns, run, "vec_id bigint, label bigint, v binary, norm double, dim int")


def _directions(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_directions(x) @ centres.T, -1, 1))


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` directions in the middle of those of ``x``, the first ones far from each other."""
    u = _directions(x)
    centres = u[:1]
    near = u @ centres[0]
    while len(centres) < n and near.min() < 1 - 1e-9:
        centres = np.vstack([centres, u[int(near.argmin())]])
        near = np.maximum(near, u @ centres[-1])
    for _ in range(5):
        own = (u @ centres.T).argmax(1)
        centres = _directions(np.array([u[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))]))
    return centres


@dataclass
class Lists:
    """Candidates with their bin in every list of their length, and the members of the lists.

    ``rows``: vec_id, label, v, first, bins. ``anchors``: q, anchor_id, label, v, norm, cluster.
    ``counts`` and ``upper`` are by list and bin: rows of the bin, and the bound at its upper edge.
    """

    rows: DataFrame
    anchors: DataFrame
    counts: np.ndarray
    upper: np.ndarray


def build(table: DataFrame, modulus: int, keep: int, clusters: int = CLUSTERS) -> Lists:
    """Clusters the anchors and puts every candidate into the lists.

    Of rows with equal vector and label only the ``keep`` smallest ids can be asked for, as they tie with
    all; the others leave the lists, so that one vector's copies do not fill them.
    """
    distinct = table.dropDuplicates(["vec_id", "label", "v"])
    ties = Window.partitionBy("v", "label").orderBy("vec_id")
    candidates = distinct.withColumn("__tie", F.row_number().over(ties)).filter(F.col("__tie") <= keep).drop("__tie")
    asked = distinct.filter(F.col("vec_id") % modulus == 0)
    asked = written(asked.select(F.monotonically_increasing_id().alias("q"), F.col("vec_id").alias("anchor_id"), "label", "v", "norm", "dim"), "anchors")
    total = asked.count()
    sample = sorted(sampled(asked, FIT_ANCHORS, total, "anchor_id").select("dim", "anchor_id", "v").collect())
    tops = {r["dim"]: r["top"] for r in candidates.groupBy("dim").agg(F.max("norm").alias("top")).collect()}
    spaces: dict[int, tuple[int, np.ndarray]] = {}
    n_lists = 0
    # One entry a vector length that has anchors.
    for dim in sorted(r["dim"] for r in asked.select("dim").distinct().collect()):
        x = [r["v"] for r in sample if r["dim"] == dim]
        # Without a sampled anchor, or components, every angle is right and the bound is the length.
        centres = _centres(_matrix(x), clusters) if x and dim else np.zeros((1, dim))
        spaces[dim] = n_lists, centres
        n_lists += len(centres)

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        for q, anchor_id, label, v, norm, dim in rows:
            first, centres = spaces[dim]
            angles = _angles(np.frombuffer(v)[None, :], centres)[0]
            yield q, anchor_id, label, v, norm, first + int(angles.argmin()), float(angles.min())

    anchors = written(map_rows(asked, join, "q bigint, anchor_id bigint, label bigint, v binary, norm double, cluster int, angle double"), "members")
    widest = np.zeros(n_lists)
    for cluster, angle in anchors.groupBy("cluster").agg(F.max("angle")).collect():
        widest[cluster] = angle + _ANGLE

    def enter(rows: Iterator[tuple]) -> Iterator[tuple]:
        for vec_id, label, v, norm, dim in rows:
            if dim not in spaces:
                continue
            first, centres = spaces[dim]
            apart = _angles(np.frombuffer(v)[None, :], centres)[0] - widest[first : first + len(centres)]
            bound = norm * np.cos(np.maximum(0, apart)) + _BOUND * tops[dim]
            top = tops[dim] * (1 + 2 * _BOUND)
            bins = np.clip((top - bound) / (2 * top) * BINS, 0, BINS - 1) if top > 0 else np.zeros(len(centres))
            yield vec_id, label, v, first, bins.astype(int).tolist()

    rows = written(map_rows(candidates.select("vec_id", "label", "v", "norm", "dim"), enter, "vec_id bigint, label bigint, v binary, first int, bins array<int>"), "lists")
    counts = np.zeros((n_lists, BINS), np.int64)
    # Lists times bins numbers.
    for cluster, at, n in rows.select("first", F.posexplode("bins").alias("i", "bin")).groupBy(F.col("first") + F.col("i"), "bin").count().collect():
        counts[cluster, at] = n
    upper = np.zeros((n_lists, BINS))
    for dim, (first, centres) in spaces.items():
        top = tops.get(dim, 0.0) * (1 + 2 * _BOUND)
        upper[first : first + len(centres)] = top - np.arange(BINS) * 2 * top / BINS
    return Lists(rows, anchors, counts, upper)


def _by_list(values, cluster: Column | str = "cluster") -> Column:
    """The value of a list, from one number for each list."""
    kind = F.array(*[F.lit(v) for v in values])
    return F.element_at(kind, F.col(cluster) + 1 if isinstance(cluster, str) else cluster + 1)


def _best(rows: pd.DataFrame, asked: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """The k best rows of a block for every want of its members."""
    out: list[tuple] = []
    if len(rows) and len(asked):
        rows = rows.sort_values("vec_id", kind="stable")
        ids, labels, x = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"].tolist())
        for start in range(0, len(asked), 256):
            some = asked.iloc[start : start + 256]
            scores = _matrix(some["v"].tolist()) @ x.T
            for s, q, own, label, wants in zip(scores, some["q"], some["anchor_id"], some["label"], some["wants"]):
                least = min(max(w["lo"], w["bar"]) for w in wants)
                able = np.flatnonzero((s >= least) & ((labels == label) == same) & (ids != own))
                held = s[able]
                for w in wants:
                    at = np.flatnonzero((held >= max(w["lo"], w["bar"])) & (held <= w["hi"]))
                    if len(at) > k:
                        at = at[held[at] >= np.partition(held[at], len(at) - k)[len(at) - k]]
                    at = at[np.argsort(-held[at], kind="stable")[:k]]  # ids ascend
                    out += [(q, w["want"], i, h) for i, h in zip(ids[able[at]].tolist(), held[at].astype(np.int64).tolist())]
    return pd.DataFrame(out, columns=["q", "want", "vec_id", "score"]).astype("int64")


def _meet(lists: Lists, active: DataFrame, members: dict[int, int], begin: np.ndarray, end: np.ndarray, k: int, same: bool) -> DataFrame:
    """(q, want, vec_id, score): the best of the bins from ``begin`` to ``end`` of each list, by block."""
    n = len(begin)
    size = [int(lists.counts[c, begin[c] : end[c]].sum()) for c in range(n)]
    parts = [max(1, -(-size[c] // BLOCK_ROWS)) for c in range(n)]
    blocks = [max(1, -(-members.get(c, 0) // BLOCK_MEMBERS)) for c in range(n)]
    low, high = begin.tolist(), end.tolist()
    here = F.transform("bins", lambda b, i: F.struct((F.col("first") + i).alias("cluster"), b.alias("bin")))
    here = F.filter(here, lambda s: (s["bin"] >= _by_list(low, s["cluster"])) & (s["bin"] < _by_list(high, s["cluster"])))
    rows = lists.rows.select("vec_id", "label", "v", F.explode(here).alias("s")).select("vec_id", "label", "v", "s.cluster")
    rows = rows.select("*", F.pmod(F.xxhash64("vec_id"), _by_list(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), _by_list(blocks) - 1)).alias("block"))
    wants = active.groupBy("q").agg(F.collect_list(F.struct("want", "lo", "hi", "bar")).alias("wants"))
    asked = lists.anchors.join(wants, "q").select(
        "q", "anchor_id", "label", "v", "wants", "cluster", F.explode(F.sequence(F.lit(0), _by_list(parts) - 1)).alias("part"),
        F.pmod(F.xxhash64("q"), _by_list(blocks)).cast("int").alias("block"),
    )

    def best(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _best(left, right, k, same)

    keys = ["cluster", "part", "block"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(best, "q bigint, want bigint, vec_id bigint, score bigint")


def walk(lists: Lists, wants: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, want, rank, vec_id, score): the first k rows of each want, scores descending, ties by id.

    ``wants`` has q, want, lo, hi: scores from lo to hi are asked for, of rows of the anchor's label or
    (not ``same``) of any other. A want leaves the walk when the bound of its list's rest is below lo or
    its k-th score so far; an equal bound may still hold a tie and goes on.
    """
    spark = wants.sparkSession
    order = Window.partitionBy("q", "want").orderBy(F.desc("score"), "vec_id")
    wants = wants.join(lists.anchors.select("q", "cluster", "norm"), "q")
    active = wants.filter("lo <= hi").withColumn("bar", F.lit(float("-inf")))
    found = spark.createDataFrame([], "q bigint, want bigint, rank int, vec_id bigint, score bigint")
    begin, size = np.zeros(len(lists.counts), np.int64), FIRST
    while True:
        # One row a list.
        members = {r["cluster"]: r["n"] for r in active.groupBy("cluster").agg(F.count_distinct("q").alias("n")).collect()}
        if not members:
            return found
        end = begin.copy()
        for c in members:
            total = np.cumsum(lists.counts[c, begin[c] :])
            end[c] = min(BINS, begin[c] + int(np.searchsorted(total, size)) + 1)
        new = _meet(lists, active, members, begin, end, k, same)
        ranked = found.drop("rank").unionByName(new).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found = written(ranked.select("q", "want", "rank", "vec_id", "score"), "walked")
        begin, size = end, size * GROWTH
        left = [float(lists.upper[c, b]) if b < BINS and lists.counts[c, b:].any() else float("-inf") for c, b in enumerate(begin)]
        bars = found.filter(F.col("rank") == k).select("q", "want", F.col("score").cast("double").alias("bar"))
        # A list with nothing left reaches nothing, whatever the member's length.
        rest = F.when(_by_list(left) == float("-inf"), float("-inf")).otherwise(F.col("norm") * _by_list(left) + _BOUND * F.col("norm") * F.abs(_by_list(left)) + 1e-6)
        active = wants.filter("lo <= hi").join(bars, ["q", "want"], "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
        active = written(active.filter((rest > float("-inf")) & (rest >= F.greatest("bar", "lo"))), "walking")


def _floor_part(value: Column, of: int = 100) -> Column:
    """floor(value / of) in whole numbers."""
    return (value - F.pmod(value, F.lit(of))) / of


def mine(
    vectors: DataFrame, modulus: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: float = 256.0, clusters: int = CLUSTERS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``modulus``; an anchor's positives its first rows of equal label, its
    negatives for each positive the first of other labels whose score is from ``low`` to ``high`` hundredths
    of the positive's. Rows without id, label or a whole finite vector take no part, vectors meet only those
    of their own length (empty ones score 0), rows of the anchor's own id never count, of repeated rows one
    counts, and an anchor id with several vectors is asked with each. An empty table gives an empty result;
    other columns are ignored. Scores are exact below 2**53.
    """
    table = written(quantised(vectors, scale), "quantised")
    lists = build(table, modulus, max(positives, negatives) + 1, clusters)
    unbound = lists.anchors.select("q", F.lit(0).cast("bigint").alias("want"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"))
    near = walk(lists, unbound, positives, True)
    score = F.col("score")
    chosen = written(
        near.select(
            "q", F.col("rank").cast("bigint").alias("want"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            (-_floor_part(-low * score)).cast("double").alias("lo"), _floor_part(high * score).cast("double").alias("hi"),
        ),
        "positives",
    )
    hard = walk(lists, chosen.select("q", "want", "lo", "hi"), negatives, False)
    hard = hard.select("q", "want", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = hard.join(chosen, ["q", "want"]).join(lists.anchors.select("q", "anchor_id"), "q")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
