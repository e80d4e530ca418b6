"""Raw tables and their loads: write mode, key, watermark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.operators.failures import slice_text, split_slices
from statlake.operators.unions import label_if_absent
from statlake.session import staged
from statlake.sources import layouts
from statlake.sources.sinks import with_load_id
from statlake.sources.tables import FAILURES, LoadedTable, append_ledger, control, drop_schema, open_schema, set_control


@dataclass(frozen=True)
class RawTable:
    """A loaded table. Without a key a load replaces it, with one it merges.

    ``partition_by`` is an expression over the key: a merge rewrites only the partitions it touches.
    """

    loader: str
    name: str
    key: tuple[str, ...] = ()
    watermark: str | None = None
    replaces: bool = False
    partition_by: str | None = None


def _tables(loader: str, keys: dict[str, str], watermark: str | None, partition_by: str | None = None) -> list[RawTable]:
    return [
        RawTable(loader, name, tuple(key.split()), watermark, partition_by=partition_by)
        for name, key in keys.items()
    ]


# Keys and watermarks of the merged tables.
_BATTING_BOARDS = {
    "exit_velo_barrels": "player_id year",
    "expected_stats": "player_id year",
    "percentile_ranks": "player_id year",
    "pitch_arsenal_stats": "player_id year pitch_type",
    "bat_tracking": "id year",
}
_PITCHING_BOARDS = {
    **_BATTING_BOARDS,
    "pitch_arsenals": "pitcher year arsenal_type",
    "pitch_movement": "pitcher_id year pitch_type",
    "active_spin": "entity_id year spin_type",
}
_FIELDING_BOARDS = {
    "outs_above_average": "player_id year position",
    "fielding_run_value": "id year position",
    "outfield_directional_oaa": "player_id year",
    "outfield_catch_prob": "player_id year",
    "outfielder_jump": "resp_fielder_id year",
    "catcher_poptime": "entity_id year",
    "catcher_framing": "id year",
}
_RUNNING_BOARDS = {"sprint_speed": "player_id year", "running_splits": "player_id year split_type"}
_LEADERBOARDS = dict.fromkeys(("batting", "pitching", "fielding"), "playerid season team leg")
# Game numbers grow with time, so a batch of new games touches few of these ranges. They are dealt over a fixed number
# of partitions in turn: the driver lists and names partitions, whose number must not grow with the games.
GAME_PARTITIONS = 512
_GAME_RANGE = f"pmod(cast(cast(game_pk as bigint) / 5000 as bigint), {GAME_PARTITIONS})"
_YEAR_OF_DATE = "substr(cast(`date` as string), 1, 4)"
_EVENTS = dict.fromkeys(
    ("retrosheet_game_logs_full", "retrosheet_game_logs_box", "retrosheet_game_logs_deduced"),
    "GAME_ID EVENT_ID",
)

RAW_TABLES: list[RawTable] = [
    *[RawTable("lahman", name, replaces=True) for name in layouts.LAHMAN_FILES],
    *[RawTable("baseball_reference_war", name, replaces=True) for name in ("war_batting", "war_pitching")],
    *_tables("baseball_reference_draft", {"draft_results": "Year draft_type Rnd RdPck"}, "year", "Year"),
    RawTable("chadwick_register", "people", ("key_uuid",), replaces=True),
    *_tables("fangraphs", _LEADERBOARDS, "season", "season"),
    RawTable("mlb_statsapi_schedules", "schedules", ("game_pk",), "season", partition_by=_GAME_RANGE),
    RawTable("mlb_statsapi_schedules", "schedules_linescore_innings", ("game_pk", "inning_num"), partition_by=_GAME_RANGE),
    RawTable("mlb_statsapi_schedules", "schedules_officials", ("game_pk", "official_type"), partition_by=_GAME_RANGE),
    *_tables("retrosheet_events", _EVENTS, "substr(game_id, 4, 4)", "substr(GAME_ID, 4, 4)"),
    RawTable("retrosheet", "game_logs", ("home_team", "date", "game_num"), "date", partition_by=_YEAR_OF_DATE),
    *_tables("retrosheet_rosters", {"rosters": "player_id team season"}, "season", "season"),
    RawTable("retrosheet_schedules", "schedules", ("date", "game_num", "home_team"), "date", partition_by=_YEAR_OF_DATE),
    *_tables("retrosheet_umpires", {"umpires": "umpire_id season"}, "season", "season"),
    RawTable("statcast_pitches", "pitches", ("game_pk", "at_bat_number", "pitch_number"), "game_date", partition_by=_GAME_RANGE),
    *_tables("statcast_batting_leaderboards", _BATTING_BOARDS, "year", "year"),
    *_tables("statcast_pitching_leaderboards", _PITCHING_BOARDS, "year", "year"),
    *_tables("statcast_fielding_leaderboards", _FIELDING_BOARDS, "year", "year"),
    *_tables("statcast_running_leaderboards", _RUNNING_BOARDS, "year", "year"),
]

# Label values of the tables that hold one row set per label.
ARSENAL_TYPES = ("avg_speed", "n", "avg_spin", "avg_break_x", "avg_break_z", "avg_vert_break")
PITCH_TYPES = ("FF", "SI", "FC", "SL", "CH", "CU", "FS", "KN", "ST", "SV")
SPIN_TYPES = ("spin-based", "movement-based")
SPLIT_TYPES = ("raw", "percent")
POSITIONS = ("2", "3", "4", "5", "6", "7", "8", "9", "OF")


def positions_for(table: str) -> tuple[str, ...]:
    """Outs above average has no combined outfield board."""
    return tuple(p for p in POSITIONS if table != "outs_above_average" or p != "OF")


def raw_table(loader: str, name: str) -> RawTable:
    found = [t for t in RAW_TABLES if (t.loader, t.name) == (loader, name)]
    if not found:
        raise KeyError(f"{loader}.{name}")
    return found[0]


def loader_tables(loader: str) -> dict[str, RawTable]:
    return {t.name: t for t in RAW_TABLES if t.loader == loader}


def loader_registry(spark: SparkSession) -> DataFrame:
    """``loader, full_refresh_only, accepts_dates`` for every loader."""
    by_date = {"mlb_statsapi_schedules", "statcast_pitches"}
    rows = []
    for loader in dict.fromkeys(t.loader for t in RAW_TABLES):
        marks = [t.watermark for t in loader_tables(loader).values() if t.watermark]
        rows.append((loader, not marks, loader in by_date))
    return spark.createDataFrame(rows, "loader string, full_refresh_only boolean, accepts_dates boolean")


def open_table(spark: SparkSession, table: RawTable, prefix: str = "") -> LoadedTable:
    """A raw table in the schema of its loader, whose name may have a prefix."""
    return LoadedTable(spark, f"{prefix}{table.loader}", table.name, table.key, table.partition_by, table.watermark)


def load_table_batch(
    spark: SparkSession,
    table: RawTable,
    batch: DataFrame,
    load_id: str,
    loaded_at: dt.datetime,
    newest_first: Sequence[Column] | None = None,
    prefix: str = "",
) -> None:
    """Write one batch, the status of its partitions and its ledger row.

    The ledger follows the data: a load that failed half way is not in it, and running it again gives
    the same table."""
    target = open_table(spark, table, prefix)
    open_schema(spark, target.schema)
    rows = with_load_id(batch, load_id)
    seen = target.replace(rows) if table.replaces else target.merge(rows, newest_first)
    append_ledger(spark, target.schema, load_id, 0, loaded_at, table.name, seen)


def load_slices(
    spark: SparkSession,
    table: RawTable,
    batch: DataFrame,
    slices: Sequence[str],
    load_id: str,
    loaded_at: dt.datetime,
    newest_first: Sequence[Column] | None = None,
    prefix: str = "",
) -> None:
    """Load the slices of a batch that parsed; keep the others as failures to be tried again.

    ``batch`` has the error column of ``with_errors``. A slice that is in the batch and did not fail leaves the
    failures of the table, also when an earlier load had put it there.
    """
    target = open_table(spark, table, prefix)
    open_schema(spark, target.schema)
    parsed = staged(batch, "parsed")
    good, failed = split_slices(parsed, slices)
    load_table_batch(spark, table, good, load_id, loaded_at, newest_first, prefix)
    keyed = slice_text(slices).alias("slice")
    fresh = failed.select(keyed, "error", "bad_rows", F.lit(load_id).alias("load_id"))
    old = control(spark, target.schema, FAILURES).where(F.col("table_name") == table.name).drop("table_name")
    kept = old.join(parsed.select(keyed).distinct(), "slice", "left_anti")
    set_control(kept.unionByName(fresh), target.schema, FAILURES, "table_name", table.name)


def full_refresh(spark: SparkSession, loader: str, prefix: str = "") -> None:
    """Drop all a loader has in one call: tables, ledger, status, failures and cursors."""
    drop_schema(spark, f"{prefix}{loader}")


def season_batch(df: DataFrame, season: str, labels: dict[str, object]) -> DataFrame:
    """A season's rows with the season as text and further labels, where they are absent."""
    return label_if_absent(df, {"season": season, **labels})
