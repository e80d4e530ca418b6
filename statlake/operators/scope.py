"""Load scopes: seasons, dates, resource names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scope:
    """What to load: an inclusive season range or an inclusive date range."""

    seasons: tuple[int, int] | None = None
    dates: tuple[dt.date, dt.date] | None = None


def _pair(start, end, name: str):
    if (start is None) != (end is None):
        raise ValueError(f"start and end {name} must be given together")
    return None if start is None else (start, end)


def make_scope(
    *,
    earliest: int,
    today: dt.date,
    season: int | None = None,
    start_season: int | None = None,
    end_season: int | None = None,
    date: dt.date | None = None,
    start_date: dt.date | None = None,
    end_date: dt.date | None = None,
    full_history: bool = False,
) -> Scope:
    """Check the arguments against each other and resolve them; nothing given means this season."""
    by_season = any(value is not None for value in (season, start_season, end_season))
    by_date = any(value is not None for value in (date, start_date, end_date))
    if sum((by_season, by_date, full_history)) > 1:
        raise ValueError("seasons, dates and full history exclude each other")
    seasons = _pair(start_season, end_season, "season")
    dates = _pair(start_date, end_date, "date")
    if (season is not None and seasons) or (date is not None and dates):
        raise ValueError("a single value and a range exclude each other")
    if date is not None:
        return Scope(dates=(date, date))
    if dates:
        return Scope(dates=dates)
    if full_history:
        return Scope(seasons=(earliest, today.year))
    if season is not None:
        return Scope(seasons=(season, season))
    return Scope(seasons=seasons or (today.year, today.year))


def scope_dates(scope: Scope) -> tuple[dt.date, dt.date]:
    """The date range of a scope; seasons run from 1 March to 31 December."""
    if scope.dates:
        return scope.dates
    first, last = scope.seasons
    return dt.date(first, 3, 1), dt.date(last, 12, 31)


def in_seasons(season: Column, seasons: tuple[int, int]) -> Column:
    """Season filter on the column as stored, so that partitions can be pruned."""
    return season.between(F.lit(seasons[0]), F.lit(seasons[1]))


def in_dates(day: Column, dates: tuple[dt.date, dt.date]) -> Column:
    """Date filter that also holds for a timestamp column: end day included, no cast of the column."""
    after = dates[1] + dt.timedelta(days=1)
    return (day >= F.lit(dates[0])) & (day < F.lit(after))


def text_year_is(text: Column, year: Column | int) -> Column:
    """Rows whose text year parses and equals the year (drops repeated header rows)."""
    return F.coalesce(text.try_cast("double") == F.lit(year).cast("double"), F.lit(False))


def choose_resources(available: Mapping[str, object], wanted: Iterable[str] | None) -> dict[str, object]:
    """The wanted subset by name; an unknown name is an error."""
    if not wanted:
        return dict(available)
    names = list(wanted)
    unknown = sorted(set(names) - set(available))
    if unknown:
        raise ValueError(f"unknown resources {unknown}; available: {sorted(available)}")
    return {name: available[name] for name in names}


def scope_grid(spark, seasons: tuple[int, int], legs: DataFrame) -> DataFrame:
    """Every season with every leg: the season range is expanded on each leg row."""
    first, last = seasons
    return legs.withColumn("season", F.explode(F.sequence(F.lit(first), F.lit(last))))


def write_by_season(df: DataFrame, path: str, season: str = "season") -> None:
    """Rows laid out by season, so that a season scope opens no folder of another season."""
    df.hint("rebalance", season).write.partitionBy(season).parquet(path)


def rows_of_grid(facts: DataFrame, grid: DataFrame, season: str = "season") -> DataFrame:
    """The rows of the grid's seasons, once for each leg of it.

    A grid has a row for each season and leg, a few hundred at most, and is broadcast; facts laid out by
    season are then pruned to its seasons when the query runs.
    """
    return facts.join(F.broadcast(grid), season)


def month_chunks(start: Column, end: Column) -> Column:
    """Array of ``(chunk_start, chunk_end)``: calendar months clipped at both ends."""
    months = F.sequence(F.trunc(start, "month"), F.greatest(start, end), F.expr("interval 1 month"))
    clipped = F.transform(
        months,
        lambda month: F.struct(
            F.greatest(month, start).alias("chunk_start"),
            F.least(F.last_day(month), end).alias("chunk_end"),
        ),
    )
    return F.filter(clipped, lambda chunk: chunk["chunk_start"] <= chunk["chunk_end"])
