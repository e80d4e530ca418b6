"""Text functions: accents, link cells, placeholders, display form."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _accent_table() -> tuple[str, str]:
    """Characters whose canonical form is one other character once its marks are gone."""
    accented, plain = [], []
    for code in range(0x80, sys.maxunicode + 1):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        base = "".join(p for p in parts if not unicodedata.category(p).startswith("M"))
        if len(base) == 1 and base != letter:
            accented.append(letter)
            plain.append(base)
    # Above the 16-bit range a letter is two Java chars, which translate() cannot map.
    pairs = [(a, p) for a, p in zip(accented, plain) if ord(a) < 0x10000 and ord(p) < 0x10000]
    return "".join(a for a, _ in pairs), "".join(p for _, p in pairs)


def strip_accents(column: Column) -> Column:
    """Remove marks; letters without a decomposition (Ł, Ø, ß) stay."""
    accented, plain = _accent_table()
    return F.translate(F.regexp_replace(column, r"\p{M}+", ""), accented, plain)


def null_texts(column: Column, *placeholders: str) -> Column:
    """Null for any of the placeholder texts."""
    return F.when(~column.isin(*placeholders), column)


def link_id_type(link: Column) -> Column:
    return (
        F.when(link.contains("register"), "baseball_reference_minor_league_id")
        .when(link.contains("players"), "baseball_reference_id")
        .otherwise("NA")
    )


def link_player_id(link: Column) -> Column:
    """After the last ``=`` of a register link; base name without extension of a player link."""
    base_name = F.substring_index(link, "/", -1)
    return (
        F.when(link.contains("register"), F.substring_index(link, "=", -1))
        .when(link.contains("players"), F.substring_index(base_name, ".", 1))
        .otherwise("NA")
    )


def link_note(text: Column, link: Column) -> Column:
    """Text in the first parentheses, only for a cell without a link."""
    inside = F.substring_index(F.regexp_extract(text, r"\(([^(]*)", 1), ")", 1)
    return F.when(link.isNull() & text.contains("("), inside).otherwise("NA")


def link_team_id(link: Column) -> Column:
    tail = F.substring_index(link, "team_ID=", -1)
    return F.when(link.isNotNull() & (link != ""), F.substring_index(tail, "&year_ID=", 1)).otherwise("NA")


def display_value(column: Column, kind: str) -> Column:
    """``-`` for null, thousands separators for counts, seconds for timestamps."""
    shown = {
        "count": lambda: F.format_number(column, 0),
        "timestamp": lambda: F.date_format(column, "yyyy-MM-dd HH:mm:ss"),
        "text": lambda: column.cast("string"),
    }[kind]()
    return F.coalesce(shown, F.lit("-"))
