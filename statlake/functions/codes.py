"""Coded text to booleans and numbers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_no(column: Column) -> Column:
    """Y -> true, N -> false, anything else -> null."""
    return F.when(column == "Y", True).when(column == "N", False)


def flag_or_false(column: Column, truth: str) -> Column:
    """True for ``truth``, false for everything else including null."""
    return F.coalesce(column == truth, F.lit(False))


def code_map(column: Column, codes: Mapping[str, object]) -> Column:
    """Simple CASE over fixed codes, null for a code that is not listed."""
    return reduce(
        lambda chain, item: chain.when(column == item[0], F.lit(item[1])),
        list(codes.items())[1:],
        F.when(column == next(iter(codes)), F.lit(next(iter(codes.values())))),
    )
