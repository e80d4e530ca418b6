"""Team id lookup across providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions import surrogate_key
from statlake.operators.joins import left_enrich
from statlake.operators.match import best_matches
from statlake.plans.columns import select_list

# Lookup column -> model column.
_TEAM_IDS = """
yearID year_id
lgID league_id
teamID team_id
franchID franchise_id
teamIDfg fangraphs_team_id
teamIDBR baseball_reference_team_id
teamIDretro retrosheet_team_id
"""
_MATCHED = ("lgID", "teamID", "franchID", "teamIDBR", "teamIDretro")


def fangraphs_team_ids(raw: DataFrame) -> DataFrame:
    rows = raw.select(*select_list(_TEAM_IDS))
    return rows.select(surrogate_key("year_id", "team_id").alias("year_team_id"), "*")


def team_id_lookup(teams: DataFrame, team_ids: DataFrame) -> DataFrame:
    """Team seasons with every provider's id, where the provider ids are known."""
    take = ["fangraphs_team_id", "baseball_reference_team_id", "retrosheet_team_id"]
    seasons = teams.select("year_id", "league_id", "team_id", "franchise_id")
    seasons = seasons.withColumn("__year", F.col("year_id").cast("string"))
    ids = team_ids.withColumn("__year", F.col("year_id").cast("string"))
    found = left_enrich(seasons, ids, {"__year": "__year", "team_id": "team_id"}, take).drop("__year")
    return found.select(surrogate_key("year_id", "team_id").alias("year_team_id"), "*")


def match_team_ids(missing: DataFrame, teams: DataFrame, position: str) -> DataFrame:
    """Seven-column lookup: exact id, else the most similar id of the season, else blanks.

    ``missing``: ``year_id, team_name, team_id``. ``teams``: the raw team seasons with
    ``position``, their order, which settles equal scores and repeated ids.
    """
    candidates = teams.select(
        F.col("yearID").alias("block"), F.col("teamID").alias("name"), position, *_MATCHED
    )
    wanted = missing.select(
        F.col("year_id").alias("block"), F.col("team_name").alias("name"), F.col("team_id").alias("teamIDfg")
    )
    matched = best_matches(wanted, candidates, "block", "name", position, _MATCHED)
    blank = F.lit("")
    return matched.select(
        F.col("block").alias("yearID"),
        *[F.when(F.col("is_matched"), F.col(name)).otherwise(blank).alias(name) for name in _MATCHED[:3]],
        F.col("teamIDfg"),
        *[F.when(F.col("is_matched"), F.col(name)).otherwise(blank).alias(name) for name in _MATCHED[3:]],
    )


def match_summary(matched: DataFrame) -> DataFrame:
    """Counts of all, matched and unmatched teams."""
    found = F.col("teamID") != ""
    return matched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("matched"),
        F.count_if(~found).alias("unmatched"),
    )


def first_unmatched(matched: DataFrame, limit: int = 10) -> DataFrame:
    """The first unmatched teams of the report, by season and id."""
    rows = matched.where(F.col("teamID") == "").select("yearID", "teamIDfg")
    return rows.orderBy("yearID", "teamIDfg").limit(limit)
