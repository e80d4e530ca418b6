"""Toxicity: a counterfactual-regularised linear classifier.

Features are words and word beginnings. Their document counts by class are summed over all learning
rows; the most telling features enter a logistic model, which is fitted by Newton steps on a bounded
sample. Identity terms in labelled sentences are swapped for other terms and for none at all; the
squared change of the score is part of the loss, so that naming a group moves no score.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import WordCache, blob, held_out, id_column, map_rows, marks, sampled, written

#: Groups whose naming alone is no insult; a parameter of ``fit``.
IDENTITY_TERMS = """
women men girls boys muslims christians jews hindus buddhists atheists immigrants refugees
black white asian latino gay lesbian bisexual transgender straight disabled blind deaf elderly
frauen männer muslime christen juden einwanderer flüchtlinge schwule lesben
femmes hommes musulmans chrétiens juifs immigrés réfugiés homosexuels lesbiennes
mujeres hombres musulmanes cristianos judíos inmigrantes refugiados homosexuales lesbianas
""".split()
PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|-_/\\+=~`"
_SENTENCE = re.compile(rb"[.!?\n]+")


def word_features(word: bytes) -> tuple[bytes, ...]:
    """The bare lower-case word and its beginnings of four and five characters."""
    core = word.strip(PUNCTUATION)
    if not core:
        return ()
    text = core.decode("utf-8", "replace")
    found = [core]
    for length in (4, 5):
        if len(text) > length:
            found.append(b"%d^" % length + text[:length].encode())
    return tuple(found)


@dataclass
class Model:
    features: dict[bytes, int]
    weights: np.ndarray
    bias: float

    def columns(self, word: bytes) -> tuple[int, ...]:
        known = self.features
        return tuple(known[f] for f in word_features(word) if f in known)

    def score(self, columns: Iterable[int]) -> float:
        z = self.bias + float(self.weights[list(columns)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _present(text: bytes | None, cache: WordCache) -> set[int]:
    found: set[int] = set()
    for columns in map(cache.__getitem__, set((text or b"").lower().split())):
        if columns:
            found.update(columns)
    return found


def class_counts(rows: DataFrame) -> DataFrame:
    """(feature, positive, negative): documents of each class that hold the feature.

    ``rows`` has text (bytes) and label. Counts are summed in the worker before the shuffle.
    """

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        cache, held = WordCache(word_features), {}
        for text, label in rows:
            present = set()
            for features in map(cache.__getitem__, set((text or b"").lower().split())):
                present.update(features)
            for feature in present:
                pair = held.setdefault(feature, [0, 0])
                pair[0 if label else 1] += 1
            if len(held) > 400_000:
                yield from ((f, *pair) for f, pair in held.items())
                held = {}
        yield from ((f, *pair) for f, pair in held.items())

    parts = map_rows(rows.select("text", "label"), count, "feature binary, positive bigint, negative bigint")
    return parts.groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative")
    )


def fit(
    rows: DataFrame,
    identity_terms: Iterable[str] = tuple(IDENTITY_TERMS),
    n_features: int = 1024,
    least_ratio: float = 15.0,
    sample: int = 6000,
    ridge: float = 0.1,
    penalty: float = 20.0,
    steps: int = 25,
) -> Model:
    """A model from ``rows`` (doc_id, text as bytes, label 0/1).

    Class counts cover every row. The weights are fitted on about ``sample`` rows of each class, chosen
    by id hash. Without rows of both classes the score is their share (0 without any).
    Features are those more frequent in toxic rows than chance explains (``least_ratio``).
    ``penalty`` weighs the counterfactual term.
    """
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    positives, negatives = totals.get(1, 0), totals.get(0, 0)
    if not positives or not negatives:
        share = (positives + 1e-6) / (positives + negatives + 1.0)
        return Model({}, np.zeros(0), float(np.log(share / (1 - share))))
    # Log-likelihood ratio of a feature's counts against equal shares in both classes.
    both = F.col("positive") + F.col("negative")
    share = positives / (positives + negatives)
    telling = 2 * (
        F.col("positive") * F.log((F.col("positive") + 1e-9) / (both * share))
        + F.col("negative") * F.log((F.col("negative") + 1e-9) / (both * (1 - share)))
    )
    chosen = (
        class_counts(rows)
        .filter((F.col("positive") > both * share) & (telling >= least_ratio))
        .orderBy(telling.desc(), "feature")
        .limit(n_features)
        .select("feature")
        .collect()
    )
    terms = [term.lower().encode() for term in identity_terms]
    names = dict.fromkeys(bytes(r["feature"]) for r in chosen)
    for term in terms:
        names.update(dict.fromkeys(word_features(term)))
    model = Model({name: i for i, name in enumerate(names)}, np.zeros(len(names)), 0.0)
    x, y, products, swaps = _sample(rows, model, terms, sample, totals)
    counter = penalty * products / max(1, swaps) * len(y) ** 0.5
    prior = np.log(positives / negatives) - np.log(max(1, (y > 0).sum()) / max(1, (y == 0).sum()))
    weights, bias = np.zeros(len(names)), 0.0
    flat = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    joint = np.zeros(len(names) + 1)
    damp = np.diag(np.r_[np.full(len(names), ridge), 1e-6])
    damp[:-1, :-1] += counter
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(flat @ joint, -30, 30)))
        slope = flat.T @ (y - chance) - damp @ joint
        curve = (flat * np.maximum(chance * (1 - chance), 1e-6)[:, None]).T @ flat + damp
        move = np.linalg.solve(curve, slope)
        joint += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-4:
            break
    weights, bias = joint[:-1], joint[-1] + prior
    return Model(model.features, weights, float(bias))


def _sample(rows: DataFrame, model: Model, terms: list[bytes], size: int, totals: dict[int, int]):
    """Feature matrix and labels of a bounded sample; summed products of the counterfactual differences, and
    their number.

    Only the columns that a document holds reach the driver, never its text. A difference names a few
    columns, so the sum of products has the size of the model whatever is mentioned.
    """
    known = {term: sorted(model.columns(term)) for term in dict.fromkeys(terms)}

    def columns(rows: Iterator[tuple]) -> Iterator[tuple]:
        cache = WordCache(model.columns)
        for text, label in rows:
            low = (text or b"").lower()
            mentioned = set()
            if any(term in low for term in known):
                for sentence in _SENTENCE.split(low):
                    mentioned.update({w.strip(PUNCTUATION) for w in sentence.split()} & known.keys())
            yield sorted(_present(low, cache)), int(label), sorted(mentioned)

    parts = [
        sampled(rows.filter(F.col("label") == label), size, totals.get(label, 0), "doc_id").select("text", "label")
        for label in (0, 1)
    ]
    taken = map_rows(
        parts[0].unionByName(parts[1]), columns, "held array<int>, label int, mentioned array<binary>"
    ).collect()
    n = len(model.features)
    x, products, swaps = np.zeros((len(taken), n), np.float32), np.zeros((n, n)), 0

    def swap(term: bytes, replacement: list[int]) -> None:
        nonlocal swaps
        at = np.array([*known[term], *replacement], int)
        change = np.r_[np.ones(len(known[term])), -np.ones(len(replacement))]
        np.add.at(products, (at[:, None], at[None, :]), np.outer(change, change))
        swaps += 1

    ordered = list(known)
    for i, row in enumerate(taken):
        x[i, row["held"]] = 1
        for term in map(bytes, row["mentioned"]):
            other = ordered[(ordered.index(term) + 1 + i) % len(ordered)]
            swap(term, [])
            swap(term, known[other])
    # Every term against none at all, so that terms no sentence names stay neutral too.
    for term in ordered:
        swap(term, [])
    y = np.array([r["label"] for r in taken], float)
    return x, y, products, swaps


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document; a null or empty text has the score of no features."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        cache = WordCache(model.columns)
        for doc_id, text in rows:
            yield doc_id, model.score(sorted(_present(text, cache)))

    return map_rows(docs.select(id_column(docs), blob()), run, "doc_id bigint, score double")


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of the rows that may be learned from: remainder of 5 not 0.

    Of label rows of one document the largest counts.
    """
    # Hinted, so that the same join is planned whatever the size of the labels.
    return docs.select(id_column(docs), blob()).filter(~held_out(5, 0)).join(marks(labels, label).hint("merge"), "doc_id")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **params) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null ids are scored and count as held out; repeated rows are scored each; an empty table gives an
    empty result; other columns of ``docs`` are ignored.
    """
    learn = written(labelled(docs, labels, "toxic"), "toxic-rows")
    model = fit(learn, **params)
    return score(docs, model).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, all columns as they are."""

    def run(batches):
        import pyarrow as pa

        cache = WordCache(model.columns)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([model.score(sorted(_present(t, cache))) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
