"""Sinks beside the loaded tables: models as tables or views, sorted CSV, several tables in one write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.sources.tables import LOAD_ID


def with_load_id(df: DataFrame, load_id: str) -> DataFrame:
    return df.withColumn(LOAD_ID, F.lit(load_id))


def materialise(df: DataFrame, name: str, as_table: bool, bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """A model as a stored table or as a view.

    A table can be laid out by the columns that it is joined on: equal keys of two tables with the same number
    of buckets lie in files of the same number, sorted, and are joined without a shuffle of either.
    """
    if not as_table:
        df.createOrReplaceTempView(name)
        return
    writer = df.write.mode("overwrite")
    if bucket_by:
        # Dealt as the buckets are: one file a bucket, whatever the number of tasks before.
        dealt = df.repartition(buckets, *bucket_by)
        writer = dealt.write.mode("overwrite").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Lookup as CSV with a header, globally sorted; part files follow the sort order."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


#: Column of a joint write that names the table of a row.
TAG = "_table"


def tagged(rows: Mapping[str, Column]) -> Column:
    """Rows of several shapes from one input row: an array of (tag, one struct column a table).

    ``rows`` has an array of structs for each table. All but the tag's own column of an element are null.
    """
    kinds = list(rows)

    def shaped(name: str) -> Column:
        def shape(row: Column) -> Column:
            none = {other: F.when(F.lit(False), F.element_at(rows[other], 1)) for other in kinds}
            return F.struct(F.lit(name).alias(TAG), *[(row if other == name else none[other]).alias(other) for other in kinds])

        return F.transform(rows[name], shape)

    empty = F.filter(shaped(kinds[0]), lambda _: F.lit(False))
    return F.concat(*[F.coalesce(shaped(name), empty) for name in kinds])


def write_tagged(df: DataFrame, rows: Mapping[str, Column], path: str) -> None:
    """All tables of ``rows`` in one pass over ``df``, one folder each."""
    df.select(F.explode(tagged(rows)).alias("row")).select("row.*").write.partitionBy(TAG).parquet(path)


def read_tagged(spark: SparkSession, path: str, schema, name: str) -> DataFrame:
    """One table of a joint write; ``schema`` is that of ``tagged`` rows. Only its folder and column are read."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.where(F.col(TAG) == name).select(f"{name}.*")
