"""The people register: one person, many provider ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions import guarded_date, parse_long, strip_accents
from statlake.operators.joins import left_enrich
from statlake.plans.columns import select_list

# Register column -> model column.
_IDS = """
key_uuid person_id
key_mlbam mlbam_id
key_retro retrosheet_id
key_bbref baseball_reference_id
key_bbref_minors baseball_reference_minor_league_id
key_fangraphs fangraphs_id
key_npb npb_id
key_sr_nfl pro_football_reference_id
key_sr_nba basketball_reference_id
key_sr_nhl hockey_reference_id
"""
_NAMES = """
name_suffix suffix
name_last last_name_accented
name_first first_name_accented
name_given given_name_accented
name_matrilineal matrilineal_name
"""
_ROLES = {"played": "played", "managed": "managed", "umpired": "umpired"}
_LEVELS = {"pro": "pro", "mlb": "mlb", "col": "college"}


def _spans() -> list[Column]:
    """First and last year per role and level; colleges have no umpires."""
    return [
        parse_long(F.col(f"{level}_{role}_{edge}")).alias(f"{edge}_{level_name}_game_{role_name}")
        for role, role_name in _ROLES.items()
        for level, level_name in _LEVELS.items()
        if (level, role) != ("col", "umpired")
        for edge in ("first", "last")
    ]


def _life_event(event: str, today: Column | None) -> list[Column]:
    year, month, day = (F.col(f"{event}_{part}") for part in ("year", "month", "day"))
    return [
        guarded_date(year, month, day, today).alias(f"{event}_date"),
        parse_long(year).alias(f"{event}_year"),
        parse_long(month).alias(f"{event}_month"),
        parse_long(day).alias(f"{event}_day"),
    ]


def register(people: DataFrame, today: Column | None = None) -> DataFrame:
    """Ids, names with and without accents, guarded birth and death dates, career spans."""
    return people.select(
        *select_list(_IDS),
        strip_accents(F.col("name_last")).alias("last_name"),
        strip_accents(F.col("name_first")).alias("first_name"),
        strip_accents(F.col("name_given")).alias("given_name"),
        *select_list(_NAMES),
        *_life_event("birth", today),
        *_life_event("death", today),
        *_spans(),
    )


def person_id_lookup(people: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``person_id, lahman_id`` for every Lahman person."""
    ids = people.select(F.col("playerid").alias("lahman_id"), F.col("bbrefid").alias("__bbref"))
    found = left_enrich(ids, crosswalk, {"__bbref": "baseball_reference_id"}, ["person_id"])
    return found.select("person_id", "lahman_id")
