"""Helpers shared by the operators: words, learning splits, written tables, Arrow rows."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.session import work_dir

#: Most bytes of text in one block of documents that a Python task holds.
BLOCK_BYTES = 8 << 20
#: Rows of an Arrow batch that are plain Python values at a time.
SLICE_ROWS = 256
#: Most entries of a per-worker word cache; it is emptied beyond.
CACHE_WORDS = 200_000


def blob(name: str = "text") -> Column:
    """UTF-8 bytes of a text column. ``bytes.split()`` splits at exactly 0x20 and 0x09-0x0D."""
    return F.col(f"`{name}`").cast("binary")


def crc(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """True for rows kept from learning. A null id is never learned from."""
    return F.coalesce(crc(doc_id) % modulus == remainder, F.lit(True))


def marks(labels: DataFrame, name: str, modulus: int = 5) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from, one for each id: remainder of ``modulus`` not 0.

    Labels other than 0 and 1 are left out. Rows that label one document differently count as label 1.
    """
    rows = labels.select(id_column(labels), F.col(name).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isin(0, 1) & ~held_out(modulus, 0))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def conf(spark: SparkSession, key: str, default: str) -> str:
    return spark.conf.get(key, default) or default


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: cuts lineage, survives lost
    executors, and repeated uses do not compute it again."""
    path = os.path.join(work_dir(df.sparkSession, label), "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(df: DataFrame) -> int:
    return max(1, int(conf(df.sparkSession, "spark.sql.shuffle.partitions", "200")))


def block_count(df: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about ``block_bytes`` compressed bytes: scan partitions times their largest size."""
    size = conf(df.sparkSession, "spark.sql.files.maxPartitionBytes", "134217728")
    found = re.fullmatch(r"(\d+)([kmg]?)b?", size.lower())
    each = int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[found[2]] if found else 128 << 20
    return max(1, df.rdd.getNumPartitions()) * max(1, -(-each // block_bytes))


def arrow_rows(rows: Iterable[Sequence], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most ``size`` rows."""
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, schema.types)], schema=schema
    )


def release() -> None:
    """Gives memory that a task freed back to the machine: workers are used again by later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_rows(
    df: DataFrame, function: Callable[[Iterator[tuple]], Iterable[Sequence]], schema: str, size: int = 4096
) -> DataFrame:
    """``function`` from an iterator over a partition's rows (plain Python values) to rows.

    Batches pass through Arrow; only one batch and what ``function`` keeps are in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                # A batch may hold many long texts: few of them are copied into Python values at a time.
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    yield from zip(*(column.to_pylist() for column in part.columns))

        try:
            yield from arrow_rows(function(rows()), arrow, size)
        finally:
            release()

    return df.mapInArrow(run, schema)


def in_groups(rows: Iterable[tuple], size: int = 2 << 20) -> Iterator[list[tuple]]:
    """Rows in lists of about ``size`` bytes of their last value, a text."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[-1] or b"")
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


class WordCache(dict):
    """Remembers ``make(word)``; forgets everything when it has grown too large."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value


def sampled(df: DataFrame, n: int, total: int, *keys: str) -> DataFrame:
    """About ``n`` of ``total`` rows (all if fewer), by a hash of their keys: each task picks its own."""
    share = min(1.0, 1.2 * n / max(1, total))
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))


def id_column(df: DataFrame, name: str = "doc_id") -> Column:
    return F.col(name).cast("bigint").alias(name)


def summed(parts: DataFrame, key: str = "int") -> DataFrame:
    """(key, data) with the float32 arrays of equal key added up, spread over tasks by key, whose type is ``key``."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int | bytes, np.ndarray] = {}
        for each, data in rows:
            value = np.frombuffer(data, np.float32).astype(np.float64)
            held[each] = held[each] + value if each in held else value
        yield from ((each, value.astype(np.float32).tobytes()) for each, value in held.items())

    schema = f"key {key}, data binary"
    dealt = parts.repartition(min(64, shuffle_width(parts)), "key")
    return map_rows(dealt, run, schema, 16)
