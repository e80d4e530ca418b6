"""Row numbers and one-row-per-key choices that hold up when one key owns most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    slices: Sequence[Column],
    output: str,
    start: int = 1,
) -> DataFrame:
    """``row_number`` per group without sorting a whole group in one task.

    ``slices`` are expressions that never decrease along ``order`` (a day of a timestamp, the
    first letters of a name, a file and block). A group is cut into its slices; rows are
    numbered inside a slice and shifted by the number of rows in the earlier slices, which is
    known from a small count per (group, slice). ``order`` must be total inside a group.
    """
    names = [f"__slice_{i}" for i in range(len(slices))]
    cut = df.withColumns(dict(zip(names, slices)))
    # One struct key: equal when all parts are equal, nulls included, and the numbering
    # window, the count and the join all hash on it, so the rows are shuffled once.
    cut = cut.withColumn("__cut", F.struct(*group, *names))
    counts = cut.groupBy("__cut").agg(F.count(F.lit(1)).alias("__rows"))
    owner = [F.col(f"__cut.{name}") for name in group]
    before = Window.partitionBy(*owner).orderBy(*[F.col(f"__cut.{name}") for name in names])
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__cut", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__cut").orderBy(*order))
    return (
        cut.withColumn("__inside", inside)
        .join(offsets, "__cut", "inner")
        .select(*df.columns, (F.col("__before") + F.col("__inside") + (start - 1)).alias(output))
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. Catalyst turns ``= 1`` into a group limit that already
    cuts every map partition to one row per key before the shuffle."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def running_index(df: DataFrame, group: str, order: Sequence[Column], slices: Sequence[Column], output: str) -> DataFrame:
    """0-based position inside a group, as text."""
    numbered = number_rows(df, [group], order, slices, output, start=0)
    return numbered.withColumn(output, F.col(output).cast("string"))
