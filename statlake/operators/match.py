"""Best match by name: exact, else the most similar candidate of the same block."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.operators.joins import left_enrich

THRESHOLD = 0.6


def similarity(left: str, right: str) -> float:
    """Ratio of matching characters of two names, upper-cased."""
    return SequenceMatcher(None, left.upper(), right.upper()).ratio()


def _keep_similar(threshold: float):
    """Score batches of pairs; the two quick ratios are upper bounds that save most full ones."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = SequenceMatcher(None)
        for batch in batches:
            scores = pd.Series(0.0, index=batch.index)
            # The matcher indexes its second text once per distinct text.
            for other, names in batch.groupby("other")["name"]:
                matcher.set_seq2(other.upper())
                for i, name in names.items():
                    matcher.set_seq1(name.upper())
                    if matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold:
                        scores[i] = matcher.ratio()
            yield batch.assign(score=scores)[scores >= threshold]

    return score


@F.pandas_udf(T.ArrayType(T.StringType()))
def _letters(names: pd.Series) -> pd.Series:
    """Letters of a name, the n-th copy of a letter told apart: ABA -> A1 B1 A2."""

    def numbered(name: str | None) -> list[str]:
        seen: Counter[str] = Counter()
        result = []
        for letter in (name or "").upper():
            seen[letter] += 1
            result.append(f"{letter}{seen[letter]}")
        return result

    return names.map(numbered)


def _rare_letters(names: DataFrame, frequency: DataFrame, threshold: float) -> DataFrame:
    """The rarest letters of each name, as many as it takes for two similar names to share one.

    Two names of similarity t share at least ``t / 2 * (len a + len b)`` letters and their
    lengths differ by at most ``t / (2 - t)``, so a name shares at least
    ``need = ceil(len * t / (2 - t))`` of its letters, and one of its ``len - need + 1`` rarest.
    """
    share = threshold / (2 - threshold)
    letters = names.withColumn("letters", _letters("name"))
    letters = letters.select("block", "name", F.size("letters").alias("length"), F.explode("letters").alias("letter"))
    counted = letters.join(frequency, ["block", "letter"], "left")
    rarest = Window.partitionBy("block", "name").orderBy(F.coalesce("names", F.lit(0)), "letter")
    need = F.ceil(F.col("length") * share - 1e-9)
    return (
        counted.withColumn("place", F.row_number().over(rarest))
        .where(F.col("place") <= F.col("length") - need + 1)
        .select("block", "letter", "name", "length")
    )


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All pairs of distinct ``(block, name)`` with similarity at or above the threshold.

    Exact: the letter join only drops pairs that cannot reach the threshold.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    frequency = (
        right.select("block", F.explode(_letters("name")).alias("letter"))
        .groupBy("block", "letter")
        .agg(F.count(F.lit(1)).alias("names"))
    )
    a = _rare_letters(left, frequency, threshold)
    b = _rare_letters(right, frequency, threshold).withColumnsRenamed({"name": "other", "length": "other_length"})
    share = threshold / (2 - threshold) - 1e-9
    near = (F.col("length") >= F.col("other_length") * share) & (F.col("other_length") >= F.col("length") * share)
    pairs = a.join(b, ["block", "letter"]).where(near).select("block", "name", "other").distinct()
    schema = T.StructType([*pairs.schema.fields, T.StructField("score", T.DoubleType())])
    return pairs.mapInPandas(_keep_similar(threshold), schema)


def best_matches(
    wanted: DataFrame,
    candidates: DataFrame,
    block: str,
    name: str,
    position: str,
    values: Sequence[str],
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Wanted rows with the values of their best candidate and ``is_matched``.

    Work is done once per distinct (block, name). Equal scores go to the candidate that comes
    first by ``position``; a name listed twice keeps its first place and its last values.
    """
    names = wanted.select(F.col(block).alias("block"), F.col(name).alias("name")).dropna().distinct()
    listed = (
        candidates.select(F.col(block).alias("block"), F.col(name).alias("name"), position, *values)
        .dropna(subset=["block", "name"])
        .groupBy("block", "name")
        .agg(
            F.min(position).alias("place"),
            F.max_by(F.struct(*values), F.col(position)).alias("found"),
        )
    )
    exact = names.join(listed, ["block", "name"]).select("block", "name", "found")
    rest = names.join(listed.select("block", "name"), ["block", "name"], "left_anti")
    scored = similar_pairs(rest, listed.select("block", "name"), threshold)
    others = listed.select("block", F.col("name").alias("other"), "place", "found")
    best = F.max_by("found", F.struct("score", -F.col("place")))
    fuzzy = scored.join(others, ["block", "other"]).groupBy("block", "name").agg(best.alias("found"))
    matches = exact.unionByName(fuzzy).select(
        "block", F.col("name").alias("__name"), *[F.col(f"found.{v}").alias(v) for v in values],
        F.lit(True).alias("is_matched"),
    )
    found = left_enrich(wanted, matches, {block: "block", name: "__name"}, [*values, "is_matched"])
    return found.withColumn("is_matched", F.coalesce("is_matched", F.lit(False)))


def required_letters(length: int, threshold: float = THRESHOLD) -> int:
    """Letters a name of this length must share with any similar name."""
    return math.ceil(length * threshold / (2 - threshold) - 1e-9)
