"""Tables in raw web pages to rows.

A page is parsed by one small function inside ``mapInArrow``; Spark spreads the pages. The
rules for link cells are Column expressions on the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.text import link_id_type, link_note, link_player_id, link_team_id
from statlake.operators.scope import text_year_is
from statlake.sources.layouts import DRAFT_RENAMES

ROW_FIELDS = {"row_index": "int", "cells": "array<struct<name:string,text:string,link:string>>"}
LINK_FIELDS = {"position": "int", "link": "string"}
# Rows handed back to Spark at a time.
_CHUNK = 5_000


class _TableRows(HTMLParser):
    """Body rows of every table, keyed by the header texts of that table.

    End tags may be left out: a new cell ends the cell before it, a new row or section the row, and
    the table's end (or the page's) everything open. Cells beyond the headers are named by their
    place (``column_3``), and so are all cells of a table without header cells.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[dict]] = []
        self._names: list[str] = []
        self._row: list[tuple[bool, dict]] | None = None
        self._cell: dict | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("table", "tr", "thead", "tbody", "tfoot"):
            self._end_row()
            if tag == "table":
                self._names = []
            elif tag == "tr":
                self._row = []
        elif tag in ("td", "th"):
            if self._row is None:
                self._row = []
            self._cell = {"text": "", "link": None}
            self._row.append((tag == "th", self._cell))
        elif tag == "a" and self._cell is not None and self._cell["link"] is None:
            self._cell["link"] = dict(attrs).get("href")

    def handle_data(self, data):
        if self._cell is not None:
            self._cell["text"] += data

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._cell = None
        elif tag in ("tr", "thead", "tbody", "tfoot", "table"):
            self._end_row()

    def close(self):
        super().close()
        self._end_row()

    def _end_row(self) -> None:
        row, self._row, self._cell = self._row, None, None
        if not row:
            return
        if not self._names and all(is_head for is_head, _ in row):
            self._names = _distinct_names([_tidy(cell["text"]) or "" for _, cell in row])
            return
        names = self._names + [f"column_{i}" for i in range(len(self._names), len(row))]
        self.rows.append(
            [{"name": name, "text": _tidy(cell["text"]), "link": cell["link"]} for name, (_, cell) in zip(names, row)]
        )


_BLANKS = re.compile(r"[\r\n]+|\s{2,}")
# Tags without attributes but a link's target, each with the text after it. ``&`` in a target only as ``&amp;``.
_TAG = r'<(?:(/?(?:table|thead|tbody|tfoot|tr|td|th|a))|a href="((?:[^"&<>]|&amp;)*)")>([^<]*)'
_PLAIN_TAG, _PLAIN_PAGE = re.compile(_TAG), re.compile(f"(?:{_TAG})*+")


def _tidy(text: str) -> str | None:
    return _BLANKS.sub(" ", text.strip()) or None


def _feed(parser: HTMLParser, html: str) -> None:
    """The parser's events for a whole page; one of plain table tags alone is cut up by a pattern, which is faster."""
    if not (html.endswith(">") and _PLAIN_PAGE.fullmatch(html)):
        parser.feed(html)
        parser.close()
        return
    for tag, target, text in _PLAIN_TAG.findall(html):
        if not tag:
            parser.handle_starttag("a", [("href", target.replace("&amp;", "&"))])
        elif tag[0] == "/":
            parser.handle_endtag(tag[1:])
        else:
            parser.handle_starttag(tag, [])
        if text:
            parser.handle_data(unescape(text) if "&" in text else text)
    parser.close()


def _distinct_names(names: Sequence[str]) -> list[str]:
    """A repeated header gets ``.1``, ``.2`` ... behind its name."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        count = seen.get(name, 0)
        seen[name] = count + 1
        result.append(f"{name}.{count}" if count else name)
    return result


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[str | None] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links.append(dict(attrs).get("href"))


def _page_rows(html: str) -> list[dict]:
    parser = _TableRows()
    _feed(parser, html)
    return [{"row_index": i, "cells": row} for i, row in enumerate(parser.rows)]


def _page_links(html: str) -> list[dict]:
    parser = _Links()
    parser.feed(html)
    return [{"position": i, "link": link} for i, link in enumerate(parser.links)]


def _row_columns(rows: list[dict]) -> list[pa.Array]:
    cells = [cell for row in rows for cell in row["cells"]]
    texts = [pa.array([cell[name] for cell in cells], pa.string()) for name in ("name", "text", "link")]
    ends = accumulate((len(row["cells"]) for row in rows), initial=0)
    held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(texts, ["name", "text", "link"]))
    return [pa.array([row["row_index"] for row in rows], pa.int32()), held]


def _link_columns(rows: list[dict]) -> list[pa.Array]:
    return [pa.array([row["position"] for row in rows], pa.int32()), pa.array([row["link"] for row in rows], pa.string())]


def _per_page(
    pages: DataFrame, html: str, keep: Sequence[str], fields: dict[str, str],
    parse: Callable[[str], list[dict]], columns: Callable[[list[dict]], list[pa.Array]],
) -> DataFrame:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema]
    added = [f"`{name}` {kind}" for name, kind in fields.items()]
    names = list(keep)

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The page's columns come first, then its text.
            kept_columns = batch.columns[: len(names)]

            def made(rows: list[dict], owners: list[int]) -> pa.RecordBatch:
                owner = pa.array(owners, pa.int32())
                return pa.RecordBatch.from_arrays([*(c.take(owner) for c in kept_columns), *columns(rows)], names=[*names, *fields])

            rows, owners = [], []
            for at, text in enumerate(batch.columns[len(names)].to_pylist()):
                found = parse(text or "")
                rows += found
                owners += [at] * len(found)
                if len(rows) >= _CHUNK:
                    yield made(rows, owners)
                    rows, owners = [], []
            if rows:
                yield made(rows, owners)

    return pages.select(*keep, html).mapInArrow(parse_batches, ", ".join([*kept, *added]))


def table_rows(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """``(*keep, row_index, cells)``: body rows of all tables of a page, cells by header text."""
    rows = _per_page(pages, html, keep, ROW_FIELDS, _page_rows, _row_columns)
    entries = F.transform("cells", lambda c: F.struct(c["name"], F.struct(c["text"], c["link"])))
    return rows.withColumn("cells", F.map_from_entries(entries))


def page_links(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """``(*keep, position, link)``: targets of the anchors of a page in page order."""
    return _per_page(pages, html, keep, LINK_FIELDS, _page_links, _link_columns)


def draft_rows(pages: DataFrame, html: str, year: str, draft_type: str, columns: Sequence[str]) -> DataFrame:
    """Draft table rows of pages that carry their year and draft type.

    Rows whose year differs from the page's (repeated headers) and rows without a round or a
    pick are dropped. ``columns`` are the table headers to keep besides year, name and team.
    """
    wanted = list(dict.fromkeys(["Year", *columns, "Name", "Tm"]))
    cell = {name: F.col("cells")[name] for name in wanted}
    name, team = cell["Name"], cell["Tm"]
    rows = table_rows(pages, html, [year, draft_type])
    rows = rows.where(text_year_is(cell["Year"]["text"], F.col(year)))
    return rows.select(
        *[cell[c]["text"].alias(DRAFT_RENAMES.get(c, c)) for c in wanted],
        F.coalesce(name["link"], F.lit("NA")).alias("link"),
        link_id_type(name["link"]).alias("id_type"),
        link_player_id(name["link"]).alias("player_id"),
        link_note(name["text"], name["link"]).alias("notes"),
        link_team_id(team["link"]).alias("team_id"),
        F.col(draft_type).alias("draft_type"),
    ).dropna(subset=["Year", "Rnd", "RdPck"])
