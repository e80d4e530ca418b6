"""Game log model: six game types in one table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions import code_map, flag_or_false, joined_md5, null_texts, parse_long
from statlake.operators.unions import union_labelled
from statlake.plans.columns import select_list
from statlake.sources.layouts import LINEUP_SLOTS, LOG_TEAM_STATS, MODEL_GAME_TYPES, SIDES

# Identity part of the model.
_HEAD = """
date date
game_num long date_game_index
day_of_week day_of_week
game_type game_type
visiting_team visiting_team
visiting_team_league visiting_team_league
visiting_team_game_num long visiting_team_game_number
home_team home_team
home_team_league home_team_league
home_team_game_num long home_team_game_number
visiting_score long visiting_score
home_score long home_score
num_outs long number_of_outs
"""
_VENUE = """
completion_info completion_info
forfeit_info forfeit_info
protest_info protest_info
park_id retrosheet_ballpark_id
attendance long attendance
time_of_game_minutes long game_length_minutes
visiting_line_score visiting_score_line
home_line_score home_score_line
"""
# Long names of the team statistics whose raw names are short.
_STAT_NAMES = {
    "abs": "at_bats", "homeruns": "home_runs", "rbi": "runs_batted_in", "sac_hits": "sacrifice_hits",
    "sac_flies": "sacrifice_flies", "hbp": "hit_by_pitches", "bb": "walks", "iw": "intentional_walks",
    "k": "strikeouts", "sb": "stolen_bases", "cs": "caught_stealing", "gdp": "ground_into_double_plays",
    "ci": "reached_on_catcher_interference", "lob": "left_on_base",
    "individual_er": "individual_earned_runs", "er": "earned_runs", "wp": "wild_pitches",
    "po": "putouts", "pb": "passed_balls", "dp": "double_plays", "tp": "triple_plays",
}
# Person in the raw name -> in the model name.
_PEOPLE = {
    "ump_home": "home_plate_umpire",
    "ump_first": "first_base_umpire",
    "ump_second": "second_base_umpire",
    "ump_third": "third_base_umpire",
    "ump_lf": "left_field_umpire",
    "ump_rf": "right_field_umpire",
    "visiting_manager": "visiting_manager",
    "home_manager": "home_manager",
    "winning_pitcher": "winning_pitcher",
    "losing_pitcher": "losing_pitcher",
    "save_pitcher": "save_pitcher",
    "game_winning_rbi": "game_winning_run_batted_in",
    "visiting_starting_pitcher": "visiting_starting_pitcher",
    "home_starting_pitcher": "home_starting_pitcher",
}
_NONE_TEXT = "(none)"
_NONE_FOR = ("ump_lf", "ump_rf", "save_pitcher", "game_winning_rbi")


def union_game_types(logs: Mapping[str, DataFrame]) -> DataFrame:
    """Raw logs of all game types with the type as a label."""
    return union_labelled(logs, "game_type")


def model_game_type(loaded: DataFrame) -> DataFrame:
    """Loader labels to the model's labels where the two differ."""
    mapped = code_map(F.col("game_type"), MODEL_GAME_TYPES)
    return loaded.withColumn("game_type", F.coalesce(mapped, F.col("game_type")))


def game_logs(raw: DataFrame) -> DataFrame:
    """Typed, renamed game logs with a hash id; ``raw`` carries ``game_type``."""
    stats = [
        parse_long(F.col(f"{side}_{stat}")).alias(f"{side}_{_STAT_NAMES.get(stat, stat)}")
        for side in SIDES
        for stat in LOG_TEAM_STATS
    ]
    people = []
    for source, output in _PEOPLE.items():
        name = F.col(f"{source}_name")
        people.append(F.col(f"{source}_id").alias(f"{output}_retrosheet_id"))
        people.append((null_texts(name, _NONE_TEXT) if source in _NONE_FOR else name).alias(output))
    lineups = []
    for side in SIDES:
        for slot in LINEUP_SLOTS:
            raw_slot, batter = f"{side}_{slot}", f"{side}_batter_{slot}"
            lineups += [
                F.col(f"{raw_slot}_id").alias(f"{batter}_retrosheet_id"),
                F.col(f"{raw_slot}_name").alias(batter),
                F.col(f"{raw_slot}_pos").alias(f"{batter}_position"),
            ]
    return raw.select(
        joined_md5("date", "visiting_team", "home_team", "game_num").alias("retrosheet_game_id"),
        *select_list(_HEAD),
        flag_or_false(F.col("day_night"), "D").alias("is_day_game"),
        *select_list(_VENUE),
        *stats,
        *people,
        *lineups,
        F.col("misc").alias("game_notes"),
        F.col("acquisition_info"),
    )
