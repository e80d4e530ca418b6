"""Quality: a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import blob, held_out, id_column, map_rows, marks, written

_SYMBOLS = b"*#$%&@^~=+<>{}[]\\/_"


def _classes() -> np.ndarray:
    """Byte -> class: 0 other, 1 upper case, 2 digit, 3 symbol, 4 bar, 5 sentence mark, 6 space."""
    table = np.zeros(256, np.uint8)
    table[65:91] = 1
    table[48:58] = 2
    table[list(_SYMBOLS)] = 3
    table[ord("|")] = 4
    table[list(b".!?,;:")] = 5
    table[[9, 10, 11, 12, 13, 32]] = 6
    return table


_CLASS_OF = _classes()
STATISTICS = """
words word_length upper digits symbols bars marks distinct_words repeated_neighbours
repeated_run repeated_lines symbols_of_worst_line upper_of_worst_line bars_of_worst_line longest_word
""".split()


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text; shares are smoothed so that short texts stay near the middle."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    data = np.frombuffer(text, np.uint8)
    kinds = _CLASS_OF[data]
    counts = np.bincount(kinds, minlength=7)
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = np.fromiter(map(eq, words, words[1:]), np.int64, max(0, n - 1))
    total = np.concatenate([[0], np.cumsum(same)])
    span = min(40, len(same))
    run = float((total[span:] - total[: len(total) - span]).max()) if span else 0.0
    worst = np.zeros(3)
    if size:
        starts = np.flatnonzero(np.r_[True, data[:-1] == 10])
        lengths = np.diff(np.r_[starts, size])
        for i, kind in enumerate((3, 1, 4)):
            held = np.add.reduceat((kinds == kind).astype(np.int64), starts)
            worst[i] = ((held + 0.2) / (lengths + 20.0)).max()
    def share(part: float, whole: float, weight: float = 20.0, usual: float = 0.01) -> float:
        return float(np.log((part + usual * weight) / (whole + weight)))
    return [
        float(np.log1p(n)),
        float(np.log((size - counts[6] + 30.0) / (n + 6.0))),
        share(counts[1], size),
        share(counts[2], size),
        share(counts[3], size),
        share(counts[4], size),
        share(counts[5], size),
        float(np.log((len(set(words)) + 5.0) / (n + 5.0) ** 0.8)),
        share(float(same.sum()), n),
        float(np.log1p(run)),
        share(len(lines) - len(set(lines)), len(lines), 3.0),
        *(float(v) for v in np.log(np.maximum(worst, 1e-4))),
        float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass
class Discriminant:
    """Class means and cached inverse Cholesky factors of the shrunk covariances."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        z = ((x - self.centre) / self.scale - self.means[k]) @ self.factors[k].T
        return self.constants[k] - 0.5 * (z * z).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.constants[0])
        gap = self.log_density(x, 1) - self.log_density(x, 0)
        return 1 / (1 + np.exp(-np.clip(gap / 2, -40, 40)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of ``x`` by ``label``; only these totals reach the driver."""
    p = len(STATISTICS)

    def part(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, np.ndarray] = {}
        for label, x in rows:
            v = np.r_[1.0, np.asarray(x)]
            held[label] = held.get(label, 0) + np.outer(v, v)
        for label, matrix in held.items():
            yield from ((label, i, float(v)) for i, v in enumerate(matrix.ravel()))

    summed = (
        map_rows(rows.select("label", "x"), part, "label int, cell int, value double")
        .groupBy("label", "cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    matrices: dict[int, np.ndarray] = {}
    for row in summed:
        matrices.setdefault(row["label"], np.zeros((p + 1) ** 2))[row["cell"]] = row["value"]
    return {
        k: (m[0], m.reshape(p + 1, p + 1)[0, 1:], m.reshape(p + 1, p + 1)[1:, 1:])
        for k, m in matrices.items()
    }


def fit(rows: DataFrame, shrink: float = 0.2, ridge: float = 0.05) -> Discriminant:
    """From (label, x) rows. ``shrink`` draws class covariances to the pooled one, ``ridge`` to a sphere.

    Without rows of both classes the score is the share of label 1 (0.5 without any row).
    """
    found = moments(rows)
    total = sum(n for n, _, _ in found.values())
    if len(found) < 2:
        share = found[1][0] / total if 1 in found else 0.0 if total else 0.5
        return Discriminant(np.zeros(0), np.ones(0), [], [], [float(share)])
    centre = sum(s for _, s, _ in found.values()) / total
    second = np.diag(sum(m for _, _, m in found.values())) / total
    scale = np.sqrt(np.maximum(second - centre**2, 1e-6))
    means, covariances = [], []
    for k in (0, 1):
        n, s, m = found[k]
        mean = s / n
        covariance = (m / n - np.outer(mean, mean)) / np.outer(scale, scale)
        means.append((mean - centre) / scale)
        covariances.append(covariance)
    pooled = sum(found[k][0] * covariances[k] for k in (0, 1)) / total
    factors, constants = [], []
    for k in (0, 1):
        mixed = (1 - shrink) * covariances[k] + shrink * pooled
        mixed = (1 - ridge) * mixed + ridge * np.trace(mixed) / len(mixed) * np.eye(len(mixed))
        lower = np.linalg.cholesky(mixed + 1e-6 * np.eye(len(mixed)))
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(found[k][0] / total) - np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, means, factors, constants)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document, in the order of ``STATISTICS``."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, statistics(text)

    return map_rows(docs.select(id_column(docs), blob()), run, "doc_id bigint, x array<double>")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **params) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null texts count as empty. Null ids are scored and held out; repeated rows are scored each; an empty
    table gives an empty result; other columns of ``docs`` are ignored. Of label rows
    of one document the largest counts.
    """
    described = written(describe(docs), "quality-statistics")
    model = fit(described.join(marks(labels, "quality"), "doc_id"), **params)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        for row in rows:
            held.append(row)
            if len(held) == 2048:
                yield from scored(held)
                held = []
        if held:
            yield from scored(held)

    def scored(held: list[tuple]) -> Iterator[tuple]:
        for (doc_id, _), value in zip(held, model.score(np.array([x for _, x in held]))):
            yield doc_id, float(value)

    return map_rows(described, run, "doc_id bigint, score double").select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
