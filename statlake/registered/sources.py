"""Readers, payloads, pages, sinks and streams over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators.ranking import running_index
from statlake.registered.base import Registry, Tables, with_inputs
from statlake.session import work_dir
from statlake.sources import csv_files, pages, payloads
from statlake.sources.sinks import write_sorted_csv

REGISTRY = Registry()


# ---- CSV -------------------------------------------------------------------------------

def _landed(t: Tables, name: str, columns: list[str], header: bool) -> str:
    """A driver table written as CSV text below the shared folder."""
    path = work_dir(t.spark, name)
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    getattr(t, name).select(*texts).write.option("header", header).csv(path)
    return path


_ORDER_TEXT = """
    SELECT CAST(o_orderkey AS VARCHAR) AS {0}, CAST(o_custkey AS VARCHAR) AS {1}, o_orderpriority AS {2} FROM orders
"""
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority"]


@REGISTRY.add("csv_headed", _ORDER_TEXT.format(*_ORDER_COLUMNS))
def _(t: Tables):
    return csv_files.read_headed(t.spark, _landed(t, "orders", _ORDER_COLUMNS, True))


@REGISTRY.add("csv_repositioned", _ORDER_TEXT.format("_2b", "_3b", "priority"))
def _(t: Tables):
    path = _landed(t, "orders", _ORDER_COLUMNS, True)
    return csv_files.read_repositioned(t.spark, path, ["_2B", "_3B", "Priority"])


@REGISTRY.add("csv_headerless", _ORDER_TEXT.format("game", "player", "priority"))
def _(t: Tables):
    path = _landed(t, "orders", _ORDER_COLUMNS, False)
    return csv_files.read_headerless(t.spark, path, ["game", "player", "priority"])


@REGISTRY.add("csv_typed", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(t: Tables):
    path = _landed(t, "orders", _ORDER_COLUMNS, True)
    return csv_files.read_typed_headed(
        t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    )


@REGISTRY.add(
    "csv_label_files",
    " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, '2024' AS year, '{kind}' AS split_type FROM customer"
        for kind in ("raw", "percent")
    ),
)
def _(t: Tables):
    path = _landed(t, "customer", ["c_custkey", "c_name"], True)
    return csv_files.read_label_files(t.spark, {"raw": path, "percent": path}, "split_type", {"year": 2024})


@REGISTRY.add("sorted_csv_lookup", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def _(t: Tables):
    path = work_dir(t.spark, "lookup")
    write_sorted_csv(t.customer.select("c_custkey", "c_name"), path, ["c_name", "c_custkey"])
    return csv_files.read_headed(t.spark, path)


# ---- JSON payloads ---------------------------------------------------------------------

# One game per order, built with the payload's own field names; two in three have a line score.
_SIDE = """named_struct('team', named_struct('id', {id}, 'name', concat('T', {id})),
  'leagueRecord', named_struct('wins', cast({id} % 100 as int), 'losses', cast({id} % 62 as int), 'pct', '.500'),
  'score', cast({id} % 11 as int), 'isWinner', {id} % 2 = 0)"""
_LINE = "named_struct('runs', cast(o_orderkey % 5 as int), 'hits', cast({i} + o_custkey % 3 as int))"
_INNINGS = ", ".join(
    f"named_struct('num', {i}, 'ordinalNum', '{i}th', 'home', {_LINE.format(i=i)}, 'away', {_LINE.format(i=i + 1)})"
    for i in (1, 2, 3)
)
_GAME = f"""
to_json(named_struct('dates', array(named_struct('date', date_format(o_orderdate, 'yyyy-MM-dd'), 'games', array(
  named_struct('gamePk', o_orderkey, 'season', date_format(o_orderdate, 'yyyy'), 'dayNight', o_orderpriority,
    'isTie', o_orderkey % 7 = 0,
    'teams', named_struct('home', {_SIDE.format(id='o_custkey')}, 'away', {_SIDE.format(id='o_orderkey')}),
    'linescore', if(o_orderkey % 3 <> 0, named_struct('currentInning', 3, 'innings', array({_INNINGS})), null),
    'officials', array(named_struct('official', named_struct('id', o_custkey, 'fullName', o_orderstatus),
      'officialType', 'Home Plate'), named_struct('official', named_struct('id', o_orderkey, 'fullName', cast(null as string)),
      'officialType', 'First Base'))
  ))))))
"""


def _games(t: Tables):
    path = work_dir(t.spark, "payloads")
    t.orders.select(F.expr(_GAME).alias("payload")).write.text(path)
    return payloads.games_of(payloads.read_schedule_payloads(t.spark, path))


_FLAT_KNOWN = {
    "game_pk": "o_orderkey",
    "season": "strftime(o_orderdate, '%Y')",
    "day_night": "o_orderpriority",
    "is_tie": "o_orderkey % 7 = 0",
    "current_inning": "CASE WHEN o_orderkey % 3 <> 0 THEN 3 END",
    **{
        f"{side}_{name}": sql.format(id=key)
        for side, key in (("home", "o_custkey"), ("away", "o_orderkey"))
        for name, sql in {
            "team_id": "{id}",
            "team_name": "'T' || {id}",
            "record_wins": "CAST({id} % 100 AS INTEGER)",
            "record_losses": "CAST({id} % 62 AS INTEGER)",
            "record_pct": "'.500'",
            "score": "CAST({id} % 11 AS INTEGER)",
            "is_winner": "{id} % 2 = 0",
        }.items()
    },
}


_FLAT_NAMES = [line.split()[0] for line in payloads.GAME_PATHS.strip().splitlines()]


@REGISTRY.add(
    "nested_flatten",
    "SELECT " + ", ".join(f"{_FLAT_KNOWN.get(name, 'NULL')} AS {name}" for name in _FLAT_NAMES) + " FROM orders",
)
def _(t: Tables):
    return payloads.flat_games(_games(t))


@REGISTRY.add(
    "explode_innings",
    """
    SELECT o_orderkey AS game_pk, CAST(i AS INTEGER) AS inning_num, i || 'th' AS inning_ordinal,
      CAST(o_orderkey % 5 AS INTEGER) AS home_runs, CAST(i + o_custkey % 3 AS INTEGER) AS home_hits,
      CAST(NULL AS INTEGER) AS home_errors, CAST(NULL AS INTEGER) AS home_left_on_base,
      CAST(o_orderkey % 5 AS INTEGER) AS away_runs, CAST(i + 1 + o_custkey % 3 AS INTEGER) AS away_hits,
      CAST(NULL AS INTEGER) AS away_errors, CAST(NULL AS INTEGER) AS away_left_on_base
    FROM orders, generate_series(1, 3) s(i) WHERE o_orderkey % 3 <> 0
    """,
)
def _(t: Tables):
    return payloads.inning_rows(_games(t))


@REGISTRY.add(
    "explode_officials",
    """
    SELECT o_orderkey AS game_pk, 'Home Plate' AS official_type, o_custkey AS official_id,
      o_orderstatus AS official_full_name FROM orders
    UNION ALL SELECT o_orderkey, 'First Base', o_orderkey, NULL FROM orders
    """,
)
def _(t: Tables):
    return payloads.official_rows(_games(t))


@REGISTRY.add(
    "explode_array",
    """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, CAST(embedding[i] AS DOUBLE) AS value
    FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
    """,
)
def _(t: Tables):
    rows = t.embeddings.select("vec_id", F.posexplode("embedding").alias("position", "value"))
    return rows.withColumn("value", F.col("value").cast("double"))


@REGISTRY.add(
    "leaderboard_rows",
    with_inputs("""
    SELECT extracted_at, TRY_CAST(record_content::JSON ->> 'playerid' AS INTEGER) AS playerid,
      record_content::JSON ->> 'Name' AS name FROM raw_fg_json
    """),
)
def _(t: Tables):
    data = t.raw_fg_json.select(
        "extracted_at", F.concat(F.lit('{"data": ['), F.col("record_content"), F.lit("]}")).alias("payload")
    )
    empty = t.raw_fg_json.select("extracted_at", F.lit("{}").alias("payload"))
    rows = payloads.leaderboard_rows(data.unionByName(empty), "payload", "struct<playerid:int,Name:string>")
    return rows.select("extracted_at", "row.playerid", F.col("row.Name").alias("name"))


# ---- web pages -------------------------------------------------------------------------

@REGISTRY.add(
    "page_links",
    """
    SELECT page_id, CAST(position - 1 AS INTEGER) AS position, links[position] AS link FROM (
      SELECT page_id, links, unnest(generate_series(1, len(links))) AS position FROM (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages))
    """,
)
def _(t: Tables):
    return pages.page_links(t.pages, "html", ["page_id"])


_HREF = "unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))"


@REGISTRY.add(
    "link_fields",
    f"""
    WITH links AS (SELECT page_id, {_HREF} AS href FROM pages),
    cells AS (SELECT page_id, 'https://x/register/player.fcgi?id=' || substr(href, 2) AS minor_link,
      '/players/' || substr(href, 2) || '.shtml' AS major_link FROM links)
    SELECT page_id, 'baseball_reference_minor_league_id' AS minor_type, string_split(minor_link, '=')[-1] AS minor_id,
      'baseball_reference_id' AS major_type, string_split(string_split(major_link, '/')[-1], '.')[1] AS major_id
    FROM cells
    """,
)
def _(t: Tables):
    from statlake.functions import link_id_type, link_player_id

    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("href"))
    href = F.substr("href", F.lit(2))
    cells = links.select(
        "page_id",
        F.concat(F.lit("https://x/register/player.fcgi?id="), href).alias("minor"),
        F.concat(F.lit("/players/"), href, F.lit(".shtml")).alias("major"),
    )
    return cells.select(
        "page_id",
        link_id_type(F.col("minor")).alias("minor_type"), link_player_id(F.col("minor")).alias("minor_id"),
        link_id_type(F.col("major")).alias("major_type"), link_player_id(F.col("major")).alias("major_id"),
    )


# One draft page per order: a table with a repeated header row and one pick.
_DRAFT_HTML = """
concat('<table><thead><tr><th>Year</th><th>Rnd</th><th>RdPck</th><th>Name</th><th>Tm</th></tr></thead><tbody>',
  '<tr><th>Year</th><th>Rnd</th><th>RdPck</th><th>Name</th><th>Tm</th></tr>',
  '<tr><td>', year(o_orderdate), '</td><td>', o_orderkey % 50 + 1, '</td><td>', o_orderkey % 30 + 1, '</td><td>',
  if(o_orderkey % 2 = 0, concat('<a href="/players/p/p', o_custkey, '.shtml">P ', o_custkey, '</a>'), 'P (DNS)'),
  '</td><td><a href="/d?team_ID=T', o_custkey % 30, '&amp;year_ID=2000">T</a></td></tr></tbody></table>')
"""


@REGISTRY.add(
    "draft_page_rows",
    """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS "Year", CAST(o_orderkey % 50 + 1 AS VARCHAR) AS "Rnd",
      CAST(o_orderkey % 30 + 1 AS VARCHAR) AS "RdPck",
      CASE WHEN o_orderkey % 2 = 0 THEN 'P ' || o_custkey ELSE 'P (DNS)' END AS "Name", 'T' AS "Tm",
      CASE WHEN o_orderkey % 2 = 0 THEN '/players/p/p' || o_custkey || '.shtml' ELSE 'NA' END AS link,
      CASE WHEN o_orderkey % 2 = 0 THEN 'baseball_reference_id' ELSE 'NA' END AS id_type,
      CASE WHEN o_orderkey % 2 = 0 THEN 'p' || o_custkey ELSE 'NA' END AS player_id,
      CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE 'DNS' END AS notes, 'T' || (o_custkey % 30) AS team_id,
      o_orderstatus AS draft_type
    FROM orders WHERE o_orderkey % 5 <> 0
    """,
)
def _(t: Tables):
    made = t.orders.select(
        # One page in five carries the year of another draft: its rows are dropped.
        (F.year("o_orderdate") + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)).alias("page_year"),
        F.col("o_orderstatus").alias("page_type"),
        F.expr(_DRAFT_HTML).alias("html"),
    )
    rows = pages.draft_rows(made, "html", "page_year", "page_type", ["Rnd", "RdPck"])
    return rows.withColumnRenamed("page_type", "draft_type")


# ---- row positions ---------------------------------------------------------------------

@REGISTRY.add(
    "event_index_in_game",
    """
    SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS VARCHAR) AS event_id
    FROM conversations
    """,
)
def _(t: Tables):
    turns = t.conversations.select("conv_id", "turn")
    return running_index(turns, "conv_id", [F.col("turn")], [F.floor(F.col("turn") / 1000)], "event_id")
