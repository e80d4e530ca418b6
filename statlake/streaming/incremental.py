"""Incremental loads through Structured Streaming.

Landed files are a stream source: the checkpoint remembers which were read, each micro-batch
is merged by key, and a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.sources.tables import LoadedTable


def landed_files(
    spark: SparkSession, folder: str, file_format: str, schema: T.StructType, files_per_batch: int = 1000, **options
) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema)
    return reader.options(maxFilesPerTrigger=files_per_batch, **options).load(folder)


def merge_stream(
    stream: DataFrame,
    table: LoadedTable,
    checkpoint: str,
    newest_first: Sequence[Column] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Merge everything that has landed since the last run, then stop."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        table.merge(rows, newest_first)

    _run(stream.writeStream.foreachBatch(merge_batch), checkpoint)


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def newest_of_stream(stream: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Key and ``row``, the newest row of each key so far, as a stateful aggregation.

    The newest row has the largest ``newest`` columns, in their order, whenever it arrives: a late file with
    older rows changes nothing. The state lives in the JVM's state store, and the checkpoint is the cursor.
    """
    row = F.struct(*[F.col(c) for c in stream.columns])
    return stream.groupBy(*key).agg(F.max_by(row, F.struct(*newest)).alias("row"))


def follow_newest(stream: DataFrame, key: Sequence[str], newest: Sequence[str], path: str, checkpoint: str) -> None:
    """Keep the newest row of every key of what has landed since the last run, then stop.

    Each micro-batch writes the keys it changed to a folder of its own, which a repeated batch overwrites:
    the stored rows are never read, let alone joined.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select("row.*").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _run(newest_of_stream(stream, key, newest).writeStream.outputMode("update").foreachBatch(write_batch), checkpoint)


def read_newest(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """The newest row of each key: of the rows that the batches wrote for it, that of the last batch."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    row = F.struct(*[F.col(c) for c in schema.names])
    return rows.groupBy(*[F.col(c).alias(f"__{c}") for c in key]).agg(F.max_by(row, "batch").alias("row")).select("row.*")
