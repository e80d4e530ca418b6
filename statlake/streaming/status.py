"""Table and loader status as small aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.sources.tables import LEDGER, STATUS, catalog_names, control


def data_tables(catalog_names: DataFrame, name: str = "name") -> DataFrame:
    """Names without the internal tables, which begin with an underscore."""
    return catalog_names.where(~F.col(name).startswith("_"))


def table_watermark(df: DataFrame, expression: str) -> DataFrame:
    """One row: the largest value of the table's time expression as text, null if empty."""
    return df.agg(F.max(F.expr(expression)).cast("string").alias("watermark"))


def table_watermarks(tables: Mapping[str, DataFrame | None], expressions: Mapping[str, str]) -> DataFrame:
    """``table_name, watermark`` per declared table; an absent table has a null watermark."""
    some = next((df for df in tables.values() if df is not None), None)
    spark = SparkSession.active() if some is None else some.sparkSession
    if not expressions:
        return spark.createDataFrame([], "table_name string, watermark string")
    rows = []
    for name, expression in expressions.items():
        df = tables.get(name)
        if df is None:
            df = spark.range(1).select(F.lit(None).cast("string").alias("watermark"))
        else:
            df = table_watermark(df, expression)
        rows.append(df.select(F.lit(name).alias("table_name"), "watermark"))
    return reduce(DataFrame.unionByName, rows)


def laggard_watermark(watermarks: DataFrame, by: str = "loader") -> DataFrame:
    """The oldest watermark per loader; null as soon as one table has none."""
    complete = F.count("watermark") == F.count(F.lit(1))
    return watermarks.groupBy(by).agg(F.when(complete, F.min("watermark")).alias("laggard"))


def successful(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == 0)


def last_loads(ledger: DataFrame, by: str = "loader") -> DataFrame:
    """Last load time and number of successful loads."""
    good = successful(ledger)
    if "load_id" in ledger.columns:  # a load that was repeated counts once
        good = good.groupBy(by, "load_id").agg(F.max("inserted_at").alias("inserted_at"))
    return good.groupBy(by).agg(
        F.max("inserted_at").alias("last_load"), F.count(F.lit(1)).alias("load_count")
    )


def tables_status(tables: Mapping[str, DataFrame], expressions: Mapping[str, str], ledger: DataFrame) -> DataFrame:
    """``table_name, watermark, rows, last_load, load_count`` for every table of a loader."""
    rows = [
        table_status(df, ledger, watermark=expressions.get(name)).select(F.lit(name).alias("table_name"), "watermark", "rows", "last_load", "load_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def table_status(df: DataFrame, ledger: DataFrame, load_id: str = "_load_id", watermark: str | None = None) -> DataFrame:
    """One row: rows of the table, last load time, number of distinct successful loads.

    With ``watermark``, an expression over the table, its largest value too, as text.

    Rows are first counted per load id; the ledger then meets one row per load instead of
    the table.
    """
    mark = F.max(F.expr(watermark)).cast("string") if watermark else F.max(F.lit(None).cast("string"))
    per_load = df.groupBy(F.col(load_id).alias("load_id")).agg(F.count(F.lit(1)).alias("rows"), mark.alias("watermark"))
    found = _with_loads(per_load, ledger, [])
    return found if watermark else found.drop("watermark")


def _with_loads(per_load: DataFrame, ledger: DataFrame, by: list[str]) -> DataFrame:
    """From ``load_id, rows, watermark`` of each load: watermark, rows, last load, number of loads."""
    # A ledger that names a load twice must not count its rows twice.
    good = successful(ledger).groupBy(F.col("load_id").alias("__load")).agg(F.max("inserted_at").alias("inserted_at"))
    joined = per_load.join(good, F.col("load_id") == F.col("__load"), "left")
    return joined.groupBy(*by).agg(
        F.max("watermark").alias("watermark"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max("inserted_at").alias("last_load"),
        F.count("__load").alias("load_count"),
    )


def status_of_schema(spark: SparkSession, schema: str, declared: Iterable[str] = ()) -> DataFrame:
    """``table_name, watermark, rows, last_load, load_count`` of a loader, from its control tables alone.

    A declared table that is absent, or whose loader never ran, has no watermark, no load and 0 rows.
    """
    per_load = control(spark, schema, STATUS).groupBy("table_name", "load_id").agg(
        F.sum("rows").alias("rows"), F.max("watermark").alias("watermark")
    )
    found = _with_loads(per_load, control(spark, schema, LEDGER), ["table_name"])
    names = list(declared)
    if not names:
        return found
    listed = spark.createDataFrame([(name,) for name in names], "table_name string")
    zero = F.lit(0).cast("bigint")
    all_of = listed.join(found, "table_name", "full")
    return all_of.withColumns({"rows": F.coalesce("rows", zero), "load_count": F.coalesce("load_count", zero)})


def status_of_loaders(spark: SparkSession, loaders: Mapping[str, Mapping[str, str | None]], prefix: str = "") -> DataFrame:
    """``loader_status`` of every loader from the catalog and the control tables, with no scan of a data table.

    ``loaders``: for each loader its tables with their watermark expressions, None without one. A loader that
    never ran has no schema and stands with 0 tables and 0 loads.
    """
    registry, tables, ledger, marks = [], [], [], []
    for loader, declared in loaders.items():
        schema, timed = f"{prefix}{loader}", [name for name, mark in declared.items() if mark]
        tag = F.lit(loader).alias("loader")
        registry.append((loader, not timed))
        tables.append(catalog_names(spark, schema).select(tag, "name"))
        ledger.append(control(spark, schema, LEDGER).select(tag, "load_id", "status", "inserted_at"))
        if timed:
            found = status_of_schema(spark, schema, timed).where(F.col("table_name").isin(timed))
            marks.append(found.select(tag, "table_name", "watermark"))
    listed = spark.createDataFrame(registry, "loader string, full_refresh_only boolean")
    none = spark.createDataFrame([], "loader string, table_name string, watermark string")
    return loader_status(listed, reduce(DataFrame.unionByName, tables), reduce(DataFrame.unionByName, ledger), reduce(DataFrame.unionByName, marks, none))


def loader_status(registry: DataFrame, tables: DataFrame, ledger: DataFrame, watermarks: DataFrame) -> DataFrame:
    """One row per registered loader, also for one that never ran.

    ``registry``: ``loader, full_refresh_only``; ``tables``: ``loader, name``; ``ledger``:
    ``loader, status, inserted_at``; ``watermarks``: ``loader, table_name, watermark``.
    """
    counts = data_tables(tables).groupBy("loader").agg(F.count(F.lit(1)).alias("table_count"))
    zero = F.lit(0).cast("bigint")
    return (
        registry.join(counts, "loader", "left")
        .join(last_loads(ledger), "loader", "left")
        .join(laggard_watermark(watermarks), "loader", "left")
        .withColumn("table_count", F.coalesce("table_count", zero))
        .withColumn("load_count", F.coalesce("load_count", zero))
        .select("loader", "table_count", "last_load", "load_count", "laggard", "full_refresh_only")
    )
