"""Text to number and date, null instead of an error for a bad value.

Raw tables hold text, and one bad cell must not fail a job, so every cast is a try-cast.
Text with a fraction rounds half away from zero when an integer is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 18 fraction digits leave 20 for the integer part: enough for a 64-bit value.
_EXACT = "decimal(38,18)"


def _whole(column: Column, target: str) -> Column:
    text = column.cast("string")
    # Plain digits, the usual case, skip the costly decimal step.
    return F.coalesce(text.try_cast(target), F.round(text.try_cast(_EXACT), 0).try_cast(target))


def parse_int(column: Column) -> Column:
    return _whole(column, "int")


def parse_long(column: Column) -> Column:
    return _whole(column, "bigint")


def parse_count(column: Column) -> Column:
    """Integer, with an absent count read as 0."""
    return F.coalesce(parse_int(column), F.lit(0))


def parse_decimal(column: Column, precision: int = 18, scale: int = 3) -> Column:
    """Straight to decimal: a detour through double would move .005 ties."""
    return column.try_cast(f"decimal({precision},{scale})")


def parse_date(column: Column) -> Column:
    return column.try_cast("date")


def parse_money(column: Column) -> Column:
    """``$1,234`` -> 1234, empty text -> null."""
    return parse_int(F.regexp_replace(column, r"[$,]", ""))


def guarded_date(year: Column, month: Column, day: Column, today: Column | None = None) -> Column:
    """Date from parts; null for an absent part, a year outside 1800..today or a day
    the calendar does not have (30 February)."""
    latest = F.year(today if today is not None else F.current_date())
    y, m, d = (parse_long(part) for part in (year, month, day))
    text = F.concat_ws("-", y.cast("string"), m.cast("string"), d.cast("string"))
    complete = y.isNotNull() & m.isNotNull() & d.isNotNull()
    return F.when(complete & y.between(F.lit(1800), latest), text.try_cast("date"))
