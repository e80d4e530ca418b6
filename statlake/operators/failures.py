"""Loading past slices that fail: errors as values beside the rows that parsed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "_error"


def with_errors(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``rows`` with the name of the first check that a row fails, null for a good row.

    A check is true for a bad row; one that is null counts as passed. An error already there stays.
    """
    found = [F.col(ERROR)] if ERROR in rows.columns else []
    found += [F.when(bad, F.lit(name)) for name, bad in checks.items()]
    return rows.withColumn(ERROR, F.coalesce(*found, F.lit(None).cast("string")))


def parse_json_rows(payloads: DataFrame, text: str, row_type: T.StructType | str) -> DataFrame:
    """The struct of a JSON text as columns, and the error column; a text that does not parse is no exception.

    Columns of the payload that the struct does not have stay.
    """
    kind = T.StructType.fromDDL(row_type) if isinstance(row_type, str) else row_type
    bad = "__corrupt"
    schema = T.StructType([*kind.fields, T.StructField(bad, T.StringType())])
    row = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    kept = [c for c in payloads.columns if c != text and c not in kind.names and c != ERROR]
    old = [F.col(ERROR).alias("__old")] if ERROR in payloads.columns else []
    parsed = payloads.select(*kept, *old, F.col(text).isNull().alias("__empty"), row.alias("__row"))
    found = [F.col("__old")] if old else []
    found += [F.when(F.col("__empty"), "no payload"), F.when(F.col(f"__row.{bad}").isNotNull(), "bad json")]
    return parsed.select(*kept, *[F.col(f"__row.`{n}`").alias(n) for n in kind.names], F.coalesce(*found).alias(ERROR))


def split_slices(rows: DataFrame, slices: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, failures) of rows with an error column.

    A slice is loaded whole or not at all: one bad row fails it. Failures are one row a slice, with its least
    error and its number of bad rows. Null slice values are values like others.
    """
    key = F.struct(*[F.col(c) for c in slices])
    bad = rows.where(F.col(ERROR).isNotNull())
    failures = bad.groupBy(*slices).agg(F.min(ERROR).alias("error"), F.count(F.lit(1)).alias("bad_rows"))
    lost = failures.select(key.alias("__lost"))
    # Structs are equal with their nulls, so a null slice finds its failure.
    good = rows.withColumn("__slice", key).join(lost, F.col("__slice") == F.col("__lost"), "left_anti")
    return good.drop("__slice", ERROR), failures


def slice_text(slices: Sequence[str]) -> Column:
    """A slice as one JSON text, as the table of failures keeps it."""
    return F.to_json(F.struct(*[F.col(c) for c in slices]), {"ignoreNullFields": "false"})
