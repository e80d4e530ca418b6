"""Files as they land, tables laid out for pruning and joins, schemas found in the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from statlake.operators import joins, scope, unions
from statlake.plans import leaderboards, loads, team_ids
from statlake.registered.base import Registry, Tables, with_inputs
from statlake.registered.loads import _schema
from statlake.registered.sources import REGISTRY as SOURCES
from statlake.registered.sources import _games
from statlake.session import work_dir
from statlake.sources import csv_files, layouts, payloads
from statlake.sources.sinks import materialise, read_tagged
from statlake.streaming import cursors

REGISTRY = Registry()
_YEARS = range(1992, 2003)


def _land_seasons(t: Tables, name: str, make, header: bool = False) -> str:
    """Orders as one landed file a season, ``make(orders, year)`` being its rows."""
    root = work_dir(t.spark, "seasons")
    for year in _YEARS:
        rows = make(t.orders.where(F.year("o_orderdate") == year), year)
        texts = [F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]
        rows.select(*texts).write.option("header", header).csv(f"{root}/seasons/{year}/{name.format(year=year)}")
    return root


# ---- landed files ------------------------------------------------------------------------

@REGISTRY.add(
    "csv_two_widths",
    """
    SELECT strftime(o_orderdate, '%Y%m%d') AS date, CAST(o_orderkey AS VARCHAR) AS game_num, 'T' || (o_custkey % 30) AS home_team,
      CASE WHEN year(o_orderdate) >= 1996 THEN 'PARK' || (o_custkey % 9) END AS location, o_orderpriority AS postponement_cancellation
    FROM orders
    """,
)
def _(t: Tables):
    """Files before 1996 lack the location; each file begins with its header row."""

    def rows(orders, year):
        cells = {name: F.lit("x") for name in layouts.SEASON_SCHEDULE_COLUMNS}
        cells |= {
            "date": F.date_format("o_orderdate", "yyyyMMdd"), "game_num": F.col("o_orderkey"), "home_team": F.concat(F.lit("T"), F.col("o_custkey") % 30),
            "location": F.concat(F.lit("PARK"), F.col("o_custkey") % 9), "postponement_cancellation": F.col("o_orderpriority"),
        }
        names = [name for name in cells if year >= 1996 or name != "location"]
        made = orders.select(*[cells[name].cast("string").alias(name) for name in names])
        header = t.spark.range(1).select(*[F.lit("Date" if name == "date" else name).alias(name) for name in names])
        return header.unionByName(made)

    read = csv_files.read_season_schedules(t.spark, _land_seasons(t, "{year}schedule.csv", rows))
    return read.select("date", "game_num", "home_team", "location", "postponement_cancellation")


_ROSTER_SQL = """
    SELECT 'p' || o_custkey AS player_id, 'L' AS last_name, 'F' AS first_name, 'R' AS bats, 'R' AS throws,
      'T' || (o_custkey % 30) AS team, o_orderstatus AS position, strftime(o_orderdate, '%Y') AS season FROM orders
"""


def _rosters(t: Tables):
    def rows(orders, year):
        return orders.selectExpr(
            "concat('p', o_custkey)", "'L' AS b", "'F' AS c", "'R' AS d", "'R' AS e", "concat('T', o_custkey % 30)", "o_orderstatus"
        ).toDF(*layouts.ROSTER_COLUMNS)

    return csv_files.read_rosters(t.spark, _land_seasons(t, "ALL{year}.ROS", rows))


@REGISTRY.add("csv_rosters", _ROSTER_SQL)
def _(t: Tables):
    return _rosters(t)


@REGISTRY.add("csv_absent_files", f"SELECT player_id, season, 'landed' AS root FROM ({_ROSTER_SQL})")
def _(t: Tables):
    """Two roots, one of them without any roster: its rows are none, with a warning."""
    landed = _rosters(t).withColumn("root", F.lit("landed"))
    absent = csv_files.read_rosters(t.spark, work_dir(t.spark, "nothing")).withColumn("root", F.lit("absent"))
    return landed.unionByName(absent).select("player_id", "season", "root")


@REGISTRY.add(
    "csv_umpires",
    """SELECT 'u' || o_custkey AS umpire_id, o_orderstatus AS last_name, o_orderpriority AS first_name, strftime(o_orderdate, '%Y') AS season FROM orders""",
)
def _(t: Tables):
    def rows(orders, year):
        return orders.select(F.concat(F.lit("u"), "o_custkey").alias("ID"), F.col("o_orderstatus").alias("last"), F.col("o_orderpriority").alias("first"))

    return csv_files.read_umpires(t.spark, _land_seasons(t, "UMPIRES{year}.txt", rows, header=True))


@REGISTRY.add("csv_register_shards", "SELECT CAST(c_custkey AS VARCHAR) AS key_uuid, c_name AS name_last FROM customer")
def _(t: Tables):
    """Four shards, and a file beside them that is none."""
    folder = work_dir(t.spark, "register")
    people = t.customer.select(F.col("c_custkey").cast("string").alias("key_uuid"), F.col("c_name").alias("name_last"))
    for i, shard in enumerate("07az"):
        people.where(F.col("key_uuid").cast("bigint") % 4 == i).write.option("header", True).csv(f"{folder}/people-{shard}.csv")
    people.write.option("header", True).csv(f"{folder}/names.csv")
    return csv_files.read_register(t.spark, folder)


def _game_logs(t: Tables, playoffs: str):
    """Season logs, and the orders of one customer in seven as logs of two series."""
    columns = layouts.game_log_columns()

    def rows(orders, year=None):
        made = {"date": F.date_format("o_orderdate", "yyyyMMdd"), "home_team": F.concat(F.lit("T"), F.col("o_custkey") % 30), "game_num": F.col("o_orderkey").cast("string")}
        return orders.select(*[made.get(c, F.lit(None).cast("string")).alias(c) for c in columns])

    root = _land_seasons(t, "GL{year}.TXT", rows)
    for i, series in enumerate(("WS", "wc")):
        rows(t.orders.where((F.col("o_custkey") % 7 == 0) & (F.col("o_orderkey") % 2 == i))).write.csv(f"{root}/gamelog/GL{series}.txt")
    return csv_files.read_game_logs(t.spark, root, playoffs).select("date", "home_team", "game_num", "game_type")


_LOG_COLUMNS = "strftime(o_orderdate, '%Y%m%d') AS date, 'T' || (o_custkey % 30) AS home_team, CAST(o_orderkey AS VARCHAR) AS game_num"
_SERIES_SQL = f"""
    SELECT {_LOG_COLUMNS}, CASE WHEN o_orderkey % 2 = 0 THEN 'world_series' ELSE 'wild_card' END AS game_type
    FROM orders WHERE o_custkey % 7 = 0
"""


@REGISTRY.add("game_logs_with_playoffs", f"SELECT {_LOG_COLUMNS}, 'regular_season' AS game_type FROM orders UNION ALL {_SERIES_SQL}")
def _(t: Tables):
    return _game_logs(t, "include")


@REGISTRY.add("game_logs_playoffs_only", _SERIES_SQL)
def _(t: Tables):
    return _game_logs(t, "only")


@REGISTRY.add(
    "csv_dotted_names",
    """SELECT CAST(l_orderkey AS VARCHAR) AS game_pk, CAST(l_partkey AS VARCHAR) AS pitcher_1, CAST(l_suppkey AS VARCHAR) AS fielder_2_1 FROM lineitem""",
)
def _(t: Tables):
    path = work_dir(t.spark, "pitches")
    t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").toDF("game_pk", "pitcher.1", "fielder_2.1").write.option("header", True).csv(path)
    return csv_files.read_pitches(t.spark, path)


@REGISTRY.add(
    "events_by_class",
    """
    SELECT CASE conv_id % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'box' ELSE 'deduced' END AS event_class, CAST(conv_id AS VARCHAR) AS "GAME_ID",
      CAST(turn AS VARCHAR) AS "TURN", CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS VARCHAR) AS "EVENT_ID"
    FROM conversations
    """,
)
def _(t: Tables):
    """Conversations as decoded games in files of three classes; each class is a table of its own."""
    folder = work_dir(t.spark, "decoded")
    turns = t.conversations.select(F.col("conv_id").alias("GAME_ID"), F.col("turn").alias("TURN"))
    for i, suffix in enumerate(("EVA", "ebn", "EDN")):
        turns.where(F.col("GAME_ID") % 3 == i).orderBy("GAME_ID", "TURN").write.option("header", True).csv(f"{folder}/2024X.{suffix}")
    classes = {name: csv_files.read_decoded_events(t.spark, folder, name) for name in layouts.EVENT_FILE_GLOBS}
    return unions.union_labelled(classes, "event_class").select("event_class", "GAME_ID", "TURN", "EVENT_ID")


_LANDED = ["Batting.csv", "People.csv", "Teams.csv"]


@REGISTRY.add(
    "inventory_gaps",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{name}', 'absent')" for name in sorted(set(layouts.LAHMAN_FILES.values()) - set(_LANDED)))
    + ", ('ASIA.csv', 'unmapped'), ('AFRICA.csv', 'unmapped')) v(name, state)",
)
def _(t: Tables):
    """A release of three known files, and one of each of two regions that no table maps to."""
    folder = work_dir(t.spark, "release")
    for name in _LANDED:
        t.customer.select("c_custkey").write.csv(f"{folder}/{name}")
    for region in ("ASIA", "AFRICA"):
        t.region.where(F.col("r_name") == region).select("r_name").write.csv(f"{folder}/{region}.csv")
    absent, extra = csv_files.inventory_gaps(t.spark, folder)
    return unions.union_labelled({"absent": absent, "unmapped": extra}, "state").select("name", "state")


# ---- one parse, several tables -----------------------------------------------------------

def _one_parse(name: str):
    def query(t: Tables):
        path = work_dir(t.spark, "schedule")
        schema = payloads.write_schedule_tables(_games(t), path)
        return read_tagged(t.spark, path, schema, name)

    return query


for _name, _like in (("schedules", "nested_flatten"), ("schedules_linescore_innings", "explode_innings"), ("schedules_officials", "explode_officials")):
    REGISTRY.add(f"one_parse_{_name}", SOURCES[_like][1])(_one_parse(_name))


# ---- layouts -----------------------------------------------------------------------------

def _by_season(t: Tables, path: str):
    lines = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_quantity", "year(l_shipdate) AS season")
    scope.write_by_season(lines, path)
    return t.spark.read.parquet(path)


@REGISTRY.add(
    "season_scope_pruned",
    """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS season FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1997""",
)
def _(t: Tables):
    wanted = scope.make_scope(earliest=1992, today=dt.date(2001, 8, 1), start_season=1995, end_season=1997)
    rows = _by_season(t, work_dir(t.spark, "by-season"))
    return rows.where(scope.in_seasons(F.col("season"), wanted.seasons)).select("l_orderkey", "l_linenumber", "season")


@REGISTRY.add(
    "scope_grid_pruned",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS season, leg, CAST(count(*) AS BIGINT) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem, (VALUES ('WC'), ('DS'), ('CS'), ('WS'), ('POST')) legs(leg) WHERE year(l_shipdate) BETWEEN 1994 AND 1996 GROUP BY ALL
    """,
)
def _(t: Tables):
    legs = leaderboards.leg_dimension(t.spark).where("is_postseason").select("leg")
    grid = scope.scope_grid(t.spark, (1994, 1996), legs)
    found = scope.rows_of_grid(_by_season(t, work_dir(t.spark, "by-season")), grid)
    return found.groupBy("season", "leg").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("double").alias("quantity"))


@REGISTRY.add(
    "bucketed_enrich",
    """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderpriority FROM lineitem LEFT JOIN
      (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) ON l_orderkey = o_orderkey
    """,
)
def _(t: Tables):
    """A fact and its lookup, both stored in buckets of their key, joined without a shuffle."""
    prefix = _schema(t)
    buckets = max(1, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    materialise(t.lineitem.select("l_orderkey", "l_linenumber"), f"`{prefix}`.facts", True, ["l_orderkey"], buckets)
    lookup = t.orders.where("o_orderkey % 5 <> 0").select("o_orderkey", "o_custkey", "o_orderpriority")
    materialise(lookup, f"`{prefix}`.lookup", True, ["o_orderkey"], buckets)
    facts, side = t.spark.table(f"`{prefix}`.facts"), t.spark.table(f"`{prefix}`.lookup")
    return facts.join(joins.hinted(side, "merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")


# ---- schemas found in the data -----------------------------------------------------------

# Records of which few have a further key, one of them of two kinds.
_RECORDS = """SELECT CASE WHEN o_orderkey % 977 = 3 THEN replace(record_content, '}}', ', "rare": true, "mixed": 5, "none": null}}')
    WHEN o_orderkey % 977 = 5 THEN replace(record_content, '}}', ', "mixed": "five", "deep": {{"a": 1}}}}')
    WHEN o_orderkey % 977 = 6 THEN substr(record_content, 1, 20) ELSE record_content END AS record_content
  FROM (SELECT o_orderkey, {0} AS record_content FROM orders)"""
_RECORD = """'{{"playerid": ' || CAST(o_custkey AS {0}) || ', "1B": ' || CAST(o_orderkey % 200 AS {0}) || ', "BB%": 0.' || CAST(10 + o_orderkey % 80 AS {0})
  || ', "Name": "' || o_orderpriority || '"}}'"""


@REGISTRY.add(
    "record_fields",
    f"""
    WITH r AS ({_RECORDS.format(_RECORD.format('VARCHAR'))}),
    j AS (SELECT record_content::JSON AS j FROM r WHERE json_valid(record_content)),
    k AS (SELECT j, unnest(json_keys(j)) AS name FROM j),
    kinds AS (SELECT name, json_type(j, '$."' || name || '"') AS kind FROM k)
    SELECT name, CASE WHEN bool_and(kind IN ('BOOLEAN', 'NULL')) AND bool_or(kind = 'BOOLEAN') THEN 'boolean'
        WHEN bool_and(kind IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL')) THEN CASE WHEN name IN ('playerid', '1B') THEN 'int' ELSE 'double' END
        ELSE 'string' END AS type, CAST(count(*) AS BIGINT) AS records
    FROM kinds GROUP BY name
    """,
)
def _(t: Tables):
    return leaderboards.record_fields(t.sql(_RECORDS.format(_RECORD.format("STRING"))))


_ENTRIES = "p_partkey AS position, p_brand AS \"group\", p_type AS raw_name, lower(p_name) AS column_name, p_name AS type"


@REGISTRY.add(
    "dictionary_of_table",
    f"""
    WITH first AS (SELECT {_ENTRIES} FROM part WHERE p_size < 4 QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) = 1),
    fields AS (SELECT DISTINCT p_type AS raw_name FROM part UNION ALL SELECT c_mktsegment FROM customer GROUP BY ALL)
    SELECT raw_name, column_name, type, COALESCE("group", 'unmapped') AS "group" FROM fields LEFT JOIN first USING (raw_name)
    """,
)
def _(t: Tables):
    return _mapped(t)


def _mapped(t: Tables):
    """Part types and market segments as fields, small parts as the dictionary, the first part of a type counting."""
    fields = t.part.select(F.col("p_type").alias("raw_name")).distinct()
    fields = fields.unionByName(t.customer.select(F.col("c_mktsegment").alias("raw_name")).distinct())
    entries = t.part.where("p_size < 4").selectExpr(*_ENTRIES.replace('"', "`").split(", "))
    return leaderboards.mapped_fields(fields, entries)


@REGISTRY.add(
    "dictionary_group_counts",
    f"""
    WITH first AS (SELECT {_ENTRIES} FROM part WHERE p_size < 4 QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) = 1),
    fields AS (SELECT DISTINCT p_type AS raw_name FROM part UNION ALL SELECT c_mktsegment FROM customer GROUP BY ALL)
    SELECT COALESCE("group", 'unmapped') AS "group", CAST(count(*) AS BIGINT) AS fields FROM fields LEFT JOIN first USING (raw_name) GROUP BY ALL
    """,
)
def _(t: Tables):
    return leaderboards.group_field_counts(_mapped(t))


# ---- cursors, positions, team ids --------------------------------------------------------

@REGISTRY.add(
    "cursor_clamp",
    """
    WITH types(type, first_season, asked, stored) AS (VALUES ('O', 1995, 1993, 1997), ('F', 1994, 1992, NULL), ('P', 1992, 1996, 1994))
    SELECT o_orderkey, o_orderstatus AS type, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders JOIN types ON type = o_orderstatus
    WHERE year(o_orderdate) >= greatest(COALESCE(stored, first_season), asked)
    """,
)
def _(t: Tables):
    types = t.spark.createDataFrame([("O", 1995, 1993, 1997), ("F", 1994, 1992, None), ("P", 1992, 1996, 1994)], "type string, first int, asked int, stored int")
    begin = cursors.resume_from_type(F.col("stored"), F.col("first"), F.col("asked"))
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("type"), F.year("o_orderdate").alias("season"))
    found = joins.inner_enrich(rows, types.withColumn("begin", begin), {"type": "type"}, ["begin"])
    return found.where("season >= begin").select("o_orderkey", "type", "season")


@REGISTRY.add(
    "positions_of_boards",
    """
    WITH boards(board) AS (VALUES ('outs_above_average'), ('fielding_run_value')),
    rows AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 = 0 THEN 'OF' ELSE CAST(l_partkey % 10 AS VARCHAR) END AS position FROM lineitem)
    SELECT board, position, CAST(count(*) AS BIGINT) AS lines FROM rows, boards
    WHERE position <> '1' AND NOT (board = 'outs_above_average' AND position = 'OF') GROUP BY ALL
    """,
)
def _(t: Tables):
    rows = t.lineitem.select(F.expr("if(l_partkey % 10 = 0, 'OF', cast(l_partkey % 10 as string))").alias("position"))
    boards = {board: rows.where(F.col("position").isin(*loads.positions_for(board))) for board in ("outs_above_average", "fielding_run_value")}
    return unions.union_labelled(boards, "board").groupBy("board", "position").agg(F.count(F.lit(1)).alias("lines"))


# Ids with a letter too many find the id itself; others share no letter with any.
_MISSING = """
    SELECT "yearID" AS year_id, CASE WHEN CAST("teamIDfg" AS INT) % 3 = 0 THEN "teamID" WHEN CAST("teamIDfg" AS INT) % 3 = 1 THEN "teamID" || 'x' ELSE '#####' END AS team_name,
      'fg' || "teamIDfg" AS team_id FROM raw_team_ids
"""


def _matched_teams(t: Tables):
    missing = t.sql(_MISSING.replace('"', "").replace("INT)", "INT)"))
    teams = t.raw_team_ids.withColumn("position", F.col("teamIDfg").cast("int"))
    return team_ids.match_team_ids(missing, teams, "position")


_MATCHED_SQL = with_inputs("""
    SELECT "yearID", CASE WHEN CAST("teamIDfg" AS INT) % 3 < 2 THEN "lgID" ELSE '' END AS "lgID", CASE WHEN CAST("teamIDfg" AS INT) % 3 < 2 THEN "teamID" ELSE '' END AS "teamID",
      CASE WHEN CAST("teamIDfg" AS INT) % 3 < 2 THEN "franchID" ELSE '' END AS "franchID", 'fg' || "teamIDfg" AS "teamIDfg",
      CASE WHEN CAST("teamIDfg" AS INT) % 3 < 2 THEN "teamIDBR" ELSE '' END AS "teamIDBR", CASE WHEN CAST("teamIDfg" AS INT) % 3 < 2 THEN "teamIDretro" ELSE '' END AS "teamIDretro"
    FROM raw_team_ids
""")


@REGISTRY.add("team_id_match", _MATCHED_SQL)
def _(t: Tables):
    return _matched_teams(t)


@REGISTRY.add(
    "team_id_summary",
    with_inputs("""
    SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (CAST("teamIDfg" AS INT) % 3 < 2) AS BIGINT) AS matched,
      CAST(count(*) FILTER (CAST("teamIDfg" AS INT) % 3 = 2) AS BIGINT) AS unmatched FROM raw_team_ids
    """),
)
def _(t: Tables):
    return team_ids.match_summary(_matched_teams(t))
