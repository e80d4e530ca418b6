"""Loaded tables in Spark's catalog, written by Spark's own commits.

A loader owns a schema. Its tables are partitioned by an expression over their key, and a merge overwrites
the partitions of its batch alone (dynamic partition overwrite). Beside them stand control tables, whose
names begin with an underscore: the ledger of loads, the status of every partition, cursors, and the slices
that failed to load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statlake.operators.merge import newest_per_key, upsert
from statlake.session import staged

PART, LOAD_ID = "_part", "_load_id"
LEDGER, STATUS, CURSORS, FAILURES = "_loads", "_status", "_cursors", "_failures"

_STATUS_COLUMNS = "table_name string, part string, load_id string, rows bigint, watermark string"
_CURSOR_COLUMNS = "resource string, cursor string"
_FAILURE_COLUMNS = "table_name string, slice string, error string, bad_rows bigint, load_id string"
_LEDGER_COLUMNS = "load_id string, status bigint, inserted_at timestamp, table_name string, rows bigint, watermark string"


def open_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create the schema if it is absent, below ``location`` if one is given."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{place}")


def drop_schema(spark: SparkSession, schema: str) -> None:
    """Drop a schema with its tables, ledger, status, cursors and failures; an absent one is no error."""
    spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")


def catalog_names(spark: SparkSession, schema: str) -> DataFrame:
    """``name`` of every table of a schema, control tables too; no rows for an absent schema."""
    if not spark.catalog.databaseExists(schema):
        return spark.createDataFrame([], "name string")
    return spark.sql(f"SHOW TABLES IN `{schema}`").where(~F.col("isTemporary")).select(F.col("tableName").alias("name"))


def control(spark: SparkSession, schema: str, name: str) -> DataFrame:
    """A control table, without rows if it is absent."""
    full = f"`{schema}`.`{name}`"
    if spark.catalog.tableExists(full):
        return spark.table(full)
    columns = {LEDGER: _LEDGER_COLUMNS, STATUS: _STATUS_COLUMNS, CURSORS: _CURSOR_COLUMNS, FAILURES: _FAILURE_COLUMNS}
    return spark.createDataFrame([], columns[name])


def set_control(rows: DataFrame, schema: str, name: str, of: str, value: str) -> None:
    """``rows`` become those of a control table whose column ``of`` is ``value``; the others stay.

    They are staged first, as they may come from the table itself.
    """
    spark, full = rows.sparkSession, f"`{schema}`.`{name}`"
    fixed = staged(rows.withColumn(of, F.lit(value)).hint("rebalance"), "control")
    if not spark.catalog.tableExists(full):
        fixed.write.option("partitionOverwriteMode", "dynamic").partitionBy(of).saveAsTable(full)
    elif fixed.isEmpty():
        # A dynamic overwrite leaves a partition that has no new rows; a static one empties it.
        columns = ", ".join(f"`{c}`" for c in spark.table(full).columns if c != of)
        spark.sql(f"INSERT OVERWRITE TABLE {full} PARTITION (`{of}` = '{value}') SELECT {columns} FROM {{rows}} WHERE FALSE", rows=fixed)
    else:
        fixed.select(*spark.table(full).columns).write.insertInto(full, overwrite=True)


class LoadedTable:
    """A table of the catalog with a key.

    ``partition_by`` is an SQL expression over the key, such as the year of a key date. The driver knows the
    partitions of a batch by name. ``watermark`` is the expression of the table's time, kept in its status.
    """

    def __init__(
        self, spark: SparkSession, schema: str, name: str, key: Sequence[str] = (), partition_by: str | Column | None = None,
        watermark: str | None = None,
    ):
        self.spark, self.schema, self.name, self.key = spark, schema, name, list(key)
        self.full = f"`{schema}`.`{name}`"
        self.partition_by = F.expr(partition_by) if isinstance(partition_by, str) else partition_by
        self.watermark = watermark

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.full)

    def read(self) -> DataFrame | None:
        """The table, or None before the first write."""
        return self.spark.table(self.full).drop(PART) if self.exists() else None

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full}")
        if self.spark.catalog.tableExists(f"`{self.schema}`.`{STATUS}`"):
            set_control(control(self.spark, self.schema, STATUS).limit(0), self.schema, STATUS, "table_name", self.name)

    def _mark(self) -> Column:
        mark = F.max(F.expr(self.watermark)) if self.watermark else F.max(F.lit(None))
        return mark.cast("string").alias("watermark")

    def _cut(self, df: DataFrame) -> DataFrame:
        return df if self.partition_by is None else df.withColumn(PART, self.partition_by.cast("string"))

    def _staged(self, df: DataFrame) -> tuple[DataFrame, dict]:
        """``df`` written below the shared folder, and what an observation of that write saw.

        A row with a null key column fails the load before the table is touched.
        """
        seen, broken = Observation(), F.lit(False)
        for name in self.key:
            broken = broken | F.col(name).isNull()
        held = staged(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("without_key"), self._mark()), "batch")
        if seen.get["without_key"]:
            raise ValueError(f"{seen.get['without_key']} rows with a null in key columns {self.key} of {self.full}")
        return held, seen.get

    def _create(self, rows: DataFrame) -> None:
        writer = self._spread(rows).write.mode("overwrite")
        if self.partition_by is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(PART)
        writer.saveAsTable(self.full)

    def _spread(self, rows: DataFrame) -> DataFrame:
        # Few files a partition, and a large partition is split over tasks.
        return rows if self.partition_by is None else rows.hint("rebalance", PART)

    def replace(self, df: DataFrame) -> dict:
        """The table becomes ``df``, which may be made from it. Returns what was written: rows, watermark."""
        held, seen = self._staged(self._cut(df))
        self._create(held)
        self._note(None)
        return seen

    def merge(self, batch: DataFrame, newest_first: Sequence[Column] | None = None) -> dict:
        """Upsert by key; a repeated batch leaves the table as it is. Returns rows and watermark of the batch.

        New columns are added to the table, absent ones are null. The batch is staged; of the table only the
        partitions of the batch are read and overwritten, and none if they hold the batch already. A table without
        partitions is staged whole.
        """
        fresh, seen = self._staged(self._cut(newest_per_key(batch, self.key, newest_first)))
        if not self.exists():
            self._create(fresh)
            self._note(None)
            return seen
        self._widen(fresh)
        stored, touched = self.spark.table(self.full), None
        if self.partition_by is not None:
            load = F.col(LOAD_ID) if LOAD_ID in fresh.columns else F.lit(None).cast("string")
            sizes = {(r[0], r[1]): r[2] for r in fresh.groupBy(PART, load).count().collect()}
            touched = list(dict.fromkeys(part for part, _ in sizes))
            stored = stored.where(_among(PART, touched))
            if self._repeats(stored, fresh, sizes):
                return seen
        merged = upsert(stored, fresh, self.key).select(*stored.columns)
        if self.partition_by is None:
            merged = staged(merged, "merged")
        self._spread(merged).write.insertInto(self.full, overwrite=True)
        self._note(touched)
        return seen

    def _repeats(self, stored: DataFrame, fresh: DataFrame, sizes: dict) -> bool:
        """Whether the table already holds every row of ``fresh`` as it is, so that nothing need be written.

        Rows are compared only where the status has as many rows of these loads in these partitions.
        """
        known = control(self.spark, self.schema, STATUS).where(F.col("table_name") == self.name)
        loads = list({load for _, load in sizes})
        if None in loads or {f.name: f.dataType for f in stored.schema} != {f.name: f.dataType for f in fresh.schema}:
            return False
        if any("map<" in f.dataType.simpleString() for f in fresh.schema):
            return False
        noted = {(r["part"], r["load_id"]): r["rows"] for r in known.where(F.col("load_id").isin(loads)).collect()}
        if any(noted.get(of) != rows for of, rows in sizes.items()):
            return False
        held = stored.where(F.col(LOAD_ID).isin(loads)).select(*[F.col(c).alias(f"__{c}") for c in fresh.columns])
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in fresh.columns]
        return fresh.join(held, same, "left_anti").isEmpty()

    def _widen(self, fresh: DataFrame) -> None:
        known = {c.lower() for c in self.spark.table(self.full).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema if f.name.lower() not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {self.full} ADD COLUMNS ({', '.join(new)})")

    def _note(self, touched: Sequence[str | None] | None) -> None:
        """Renew the status of the written partitions: rows and watermark for each load in them."""
        now, part = self.spark.table(self.full), F.col(PART) if self.partition_by is not None else F.lit("")
        if touched is not None:
            now = now.where(_among(PART, touched))
        load = F.col(LOAD_ID) if LOAD_ID in now.columns else F.lit(None).cast("string")
        fresh = now.groupBy(part.alias("part"), load.alias("load_id")).agg(F.count(F.lit(1)).alias("rows"), self._mark())
        kept = control(self.spark, self.schema, STATUS).where(F.col("table_name") == self.name).drop("table_name")
        if touched is None:
            kept = kept.limit(0)
        else:
            kept = kept.where(~_among("part", touched))
        set_control(kept.unionByName(fresh), self.schema, STATUS, "table_name", self.name)


def _among(column: str, values: Sequence[str | None]) -> Column:
    """Never null, so that its negation is the rest."""
    named = F.col(column).isin([v for v in values if v is not None])
    found = F.coalesce(named, F.lit(False))
    return found | F.col(column).isNull() if None in values else found


def read_cursors(spark: SparkSession, schema: str) -> DataFrame:
    """``resource, cursor`` of a loader, kept in its schema and dropped with it."""
    return control(spark, schema, CURSORS).select("resource", "cursor")


def advance_cursor(spark: SparkSession, schema: str, resource: str, value: str) -> None:
    moved = spark.range(1).select(F.lit(value).alias("cursor"))
    set_control(moved, schema, CURSORS, "resource", resource)


def append_ledger(spark: SparkSession, schema: str, load_id: str, status: int, inserted_at, table: str, seen: dict) -> None:
    """One row for a table of a load; status 0 is success. ``seen`` is what was observed while it was written."""
    row = [(load_id, status, inserted_at, table, seen.get("rows"), seen.get("watermark"))]
    spark.createDataFrame(row, _LEDGER_COLUMNS).write.mode("append").saveAsTable(f"`{schema}`.`{LEDGER}`")
