"""Unions by name, labels and set differences."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of frames with the same columns, matched by name."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def union_padded(frames: Iterable[DataFrame]) -> DataFrame:
    """Union over all columns seen; a frame without a column contributes nulls."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def union_labelled(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Union of frames with the name of each written to ``label``."""
    return union_padded(df.withColumn(label, F.lit(name)) for name, df in frames.items())


def label_if_absent(df: DataFrame, labels: Mapping[str, object]) -> DataFrame:
    """Add constant text columns, keeping a column that is already there."""
    missing = {name: F.lit(str(value)) for name, value in labels.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def long_labels(frames: Mapping[str, DataFrame], label: str, common: Mapping[str, object]) -> DataFrame:
    """One table of several row sets, each labelled by its key value."""
    return union_padded(
        label_if_absent(df, {**common, label: value}) for value, df in frames.items()
    )


def names_missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Names expected but not found."""
    return expected.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def project(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Select by ``{output name: expression}``."""
    return df.select(*[column.alias(name) for name, column in columns.items()])
