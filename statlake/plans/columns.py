"""Select lists from plain text tables: ``source kind output`` per line.

Kinds: ``text`` (as it is), ``int``, ``long``, ``count`` (int, null as 0), ``date``, ``yes_no``,
``numeric`` (decimal(18,3)) and ``p,s`` for decimal(p,s). A line of two words renames text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.functions import parse_count, parse_date, parse_decimal, parse_int, parse_long, yes_no

_CASTS = {
    "text": lambda c: c,
    "string": lambda c: c.cast("string"),
    "int": parse_int,
    "long": parse_long,
    "count": parse_count,
    "date": parse_date,
    "yes_no": yes_no,
    "numeric": parse_decimal,
}


def cast_as(column: Column, kind: str) -> Column:
    if "," in kind:
        precision, scale = kind.split(",")
        return parse_decimal(column, int(precision), int(scale))
    return _CASTS[kind](column)


def select_list(table: str) -> list[Column]:
    columns = []
    for line in table.strip().splitlines():
        words = line.split()
        source, output = words[0], words[-1]
        kind = words[1] if len(words) == 3 else "text"
        columns.append(cast_as(F.col(f"`{source}`"), kind).alias(output))
    return columns


def output_names(table: str) -> list[str]:
    return [line.split()[-1] for line in table.strip().splitlines()]
