"""Where a load resumes, and what a status asks it to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resume_from(cursor: Column, start: Column, update: bool = False) -> Column:
    """The stored cursor, inclusive, wins over the asked start; ``update`` ignores it."""
    return start if update else F.coalesce(cursor, start)


def resume_from_type(cursor: Column, type_start: Column, start: Column, update: bool = False) -> Column:
    """Cursor of one draft type, clamped so that it never begins before type or request."""
    return F.greatest(type_start, start) if update else F.greatest(F.coalesce(cursor, type_start), start)


def rows_to_load(source: DataFrame, cursors: DataFrame, resource: str, time: str, start, end, update: bool = False) -> DataFrame:
    """Source rows from the resume point to the end. ``cursors`` has ``resource, cursor`` and one
    row per resource, so the value is read once and becomes a literal that prunes partitions."""
    stored = cursors.where(F.col("resource") == resource).select("cursor").limit(1).collect()
    kind = source.schema[time].dataType
    begin = F.lit(start) if update or not stored or stored[0]["cursor"] is None else F.lit(stored[0]["cursor"])
    return source.where((F.col(time) >= begin.cast(kind)) & (F.col(time) <= F.lit(end).cast(kind)))


def advance(cursors: DataFrame, resource: str, value: Column) -> DataFrame:
    """Cursor table with one resource moved on."""
    others = cursors.where(F.col("resource") != resource)
    kind = cursors.schema["cursor"].dataType
    moved = cursors.sparkSession.range(1).select(F.lit(resource).alias("resource"), value.cast(kind).alias("cursor"))
    return others.unionByName(moved)


def watermark_year(value: Column) -> Column:
    """Year of ``YYYY``, ``YYYY-MM-DD`` or ``YYYYMMDD``; null for anything else."""
    known = value.rlike(r"^(\d{4}|\d{4}-\d{2}-\d{2}|\d{8})$")
    return F.when(known, F.substring(value, 1, 4).cast("int"))


def watermark_date(value: Column) -> Column:
    """ISO text of a date watermark; null for a bare season and anything else."""
    compact = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value).when(value.rlike(r"^\d{8}$"), compact)


def load_plan(status: DataFrame, action: str, today: Column) -> DataFrame:
    """What to load per loader: ``plan`` with ``plan_start`` and ``plan_end``.

    ``status`` has ``laggard, full_refresh_only, accepts_dates``. Plans are ``full_refresh``,
    ``full_refresh_history``, ``full_history``, ``dates`` and ``seasons``.
    """
    if action not in ("full", "incremental"):
        raise ValueError(f"unknown action: {action!r}")
    single_shot, laggard = F.col("full_refresh_only"), F.col("laggard")
    if action == "full":
        plan = F.when(single_shot, "full_refresh").otherwise("full_refresh_history")
        nothing = F.lit(None).cast("string")
        return status.withColumns({"plan": plan, "plan_start": nothing, "plan_end": nothing})
    day, year = watermark_date(laggard), watermark_year(laggard)
    refused = F.raise_error(F.lit("incremental is not valid for a full-refresh-only loader")).cast("string")
    by_date = F.col("accepts_dates") & day.isNotNull()
    plan = (
        F.when(single_shot, refused)
        .when(by_date, "dates")
        .when(year.isNotNull(), "seasons")
        .otherwise("full_history")
    )
    start = F.when(by_date, day).when(year.isNotNull(), year.cast("string"))
    end = F.when(by_date, today.cast("string")).when(year.isNotNull(), F.year(today).cast("string"))
    return status.withColumns({"plan": plan, "plan_start": start, "plan_end": end})


def failed_slices(failures: DataFrame) -> DataFrame:
    """Failed rounds per (year, type) as a sorted list. Rounds are made distinct first, so a
    list holds at most the rounds of one draft."""
    slices = failures.select("year", "type", "round").distinct()
    return slices.groupBy("year", "type").agg(F.sort_array(F.collect_list("round")).alias("rounds"))
