"""Wins-above-replacement models and draft results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions import null_texts, parse_money, surrogate_key, yes_no
from statlake.operators.joins import conditional_key_enrich, left_enrich
from statlake.plans.columns import output_names, select_list

# Batting source column, type, model column.
_BATTING = """
age long age
pa long plate_appearances
g long games_played
inn 6,1 innings
runs_bat 6,2 runs_batting
runs_br 6,2 runs_baserunning
runs_dp 6,2 runs_ground_into_double_play
runs_field 6,2 runs_fielding
runs_infield 6,2 runs_infield
runs_outfield 6,2 runs_outfield
runs_catcher 6,2 runs_catcher
runs_good_plays 6,2 runs_good_plays
runs_defense 6,2 runs_defense
runs_position 6,2 runs_position
runs_position_p 6,2 runs_position_pitcher_adjustment
runs_replacement 6,2 runs_replacement
runs_above_rep 6,2 runs_above_replacement
runs_above_avg 6,2 runs_above_average
runs_above_avg_off 6,2 runs_above_average_offense
runs_above_avg_def 6,2 runs_above_average_defense
waa 6,2 wins_above_average
waa_off 6,2 wins_above_average_offense
waa_def 6,2 wins_above_average_defense
war 6,2 wins_above_replacement
war_off 6,2 wins_above_replacement_offense
war_def 6,2 wins_above_replacement_defense
war_rep 6,2 replacement_player_wins_above_replacement
salary long salary
teamrpg 10,5 average_team_runs_scored_per_game
opprpg 10,5 average_team_runs_allowed_per_game
opprppa_rep 10,5 average_team_runs_allowed_per_plate_appearance_against_replacement
opprpg_rep 10,5 average_team_runs_allowed_per_game_against_replacement
pyth_exponent 7,3 pythagenpat_exponent
pyth_exponent_rep 7,3 pythagenpat_exponent_replacement
waa_win_perc 8,4 wins_above_average_win_percentage_with_average_team
waa_win_perc_off 8,4 wins_above_average_win_percentage_with_average_team_offense
waa_win_perc_def 8,4 wins_above_average_win_percentage_with_average_team_defense
waa_win_perc_rep 8,4 wins_above_average_win_percentage_with_average_team_replacement
ops_plus 14,10 on_base_plus_slugging_plus
tob_lg 7,3 leage_average_player_times_on_base
tb_lg 7,3 league_average_player_total_bases
"""

# Pitching source column, type, model column.
_PITCHING = """
age long age
g long games
gs long games_started
ipouts long outs_pitched
ipouts_start long outs_pitched_as_starter
ipouts_relief long outs_pitched_as_reliever
ra long runs_allowed
xra 7,3 expected_runs_allowed
xra_sprp_adj 7,3 expected_runs_allowed_role_adjustment
xra_extras_adj 7,3 expected_runs_allowed_extra_adjustment
xra_def_pitcher 7,3 expected_runs_allowed_team_defense_adjustment
ppf long home_park_factor
ppf_custom long pitched_park_factor
xra_final 7,3 expected_runs_allowed_final
bip long balls_in_play
bip_perc 7,3 percent_of_teams_balls_in_play
rs_def_total 7,1 team_defensive_runs_saved
runs_above_avg 7,3 runs_above_average
runs_above_avg_adj 7,3 runs_above_average_adjusted
runs_above_rep 7,3 runs_above_average_multiplied_by_replacement_level_factor
rpo_replacement 5,3 runs_per_out_replacement_level
gr_leverage_index_avg 5,2 leverage_in_relief_appearances
war 5,2 wins_above_replacement
war_rep 6,4 replacement_pitcher_wins_above_replacement
salary long salary
teamrpg 10,5 average_team_runs_per_game_with_pitcher
opprpg 10,5 average_opponent_runs_per_game
opprpg_rep 10,5 average_opponent_runs_allowed_per_game_against_replacement
pyth_exponent 7,3 pythagenpat_exponent
waa 7,4 wins_above_average
waa_adj 7,4 wins_above_average_adjusted
waa_win_perc 7,4 wins_above_average_win_percentage_with_average_team
era_plus 6,1 era_plus
er_lg 7,3 league_average_pitcher_earned_runs
"""

# Names that the loader's snake-case rule splits -> plain names.
_LOADED_NAMES = {
    "team_rp_g": "teamrpg",
    "opp_rp_g": "opprpg",
    "opp_rp_pa_rep": "opprppa_rep",
    "opp_rp_g_rep": "opprpg_rep",
    "i_pouts": "ipouts",
    "i_pouts_start": "ipouts_start",
    "i_pouts_relief": "ipouts_relief",
    "x_ra": "xra",
    "x_ra_sprp_adj": "xra_sprp_adj",
    "x_ra_extras_adj": "xra_extras_adj",
    "x_ra_def_pitcher": "xra_def_pitcher",
    "x_ra_final": "xra_final",
    "rp_o_replacement": "rpo_replacement",
}

# Identity columns shared by both models.
_IDENTITY = """
player_id baseball_reference_id
stint_id stint
team_id team_id
lg_id league_id
year_id year_id
"""


def _season_rows(raw: DataFrame, crosswalk: DataFrame, mlbam: Column, extra: list[Column]) -> DataFrame:
    # Cast before the join: numbers are moved through it instead of the texts they come from.
    typed = raw.select(*select_list(_IDENTITY), mlbam.alias("mlbam_id"), *extra)
    found = left_enrich(typed, crosswalk, {"baseball_reference_id": "baseball_reference_id"}, ["person_id"])
    regular = F.lit(False)
    identity = output_names(_IDENTITY)
    return found.select(
        surrogate_key("person_id", "stint", "team_id", "year_id", regular).alias("player_stint_year_id"),
        surrogate_key("person_id", "team_id", "year_id").alias("player_year_team_id"),
        surrogate_key("person_id", "year_id").alias("player_year_id"),
        "person_id",
        "mlbam_id",
        *identity,
        regular.alias("is_postseason"),
        *[name for name in typed.columns if name not in (*identity, "mlbam_id")],
    )


def batting_war(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Batting value per player, year and stint; ``person_id`` from the crosswalk."""
    extra = [yes_no(F.col("pitcher")).alias("is_pitcher"), *select_list(_BATTING)]
    return _season_rows(raw, crosswalk, F.col("mlb_id"), extra)


def pitching_war(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Pitching value per player, year and stint."""
    return _season_rows(raw, crosswalk, F.col("mlb_id"), select_list(_PITCHING))


def _plain_names(raw: DataFrame) -> DataFrame:
    renamed = {old: new for old, new in _LOADED_NAMES.items() if old in raw.columns}
    return raw.withColumnsRenamed(renamed).withColumn("mlb_id", F.col("mlb_id").try_cast("bigint"))


def batting_war_loaded(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The same from the loaded table, whose names went through the snake-case rule."""
    return batting_war(_plain_names(raw), crosswalk)


def pitching_war_loaded(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return pitching_war(_plain_names(raw), crosswalk)


# Draft source column -> model column.
_DRAFT_HEAD = """
rnd round
rdpck round_pick
ovpck overall_pick
team_id team_id
tm team_name
person_id person_id
"""
_DRAFT_TAIL = """
pos position
draftedoutof school
type school_type
"""
REGULAR_DRAFT = "6rg"
# Fixed value: the mark of a minor-league player, led by a no-break space.
MINORS_MARK = "\u00a0(minors)"
MISSING_TEXTS = ("NA", "nan", "None")


def draft_results(raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Draft picks; the type of id in a row decides which provider id finds the person."""
    found = conditional_key_enrich(
        raw,
        crosswalk,
        "id_type",
        "player_id",
        {
            "baseball_reference_id": "baseball_reference_id",
            "baseball_reference_minor_league_id": "baseball_reference_minor_league_id",
        },
        ["person_id"],
        spread=["year", "rnd", "rdpck"],
    )
    picks = found.select(
        F.col("year").alias("year_id"),
        F.coalesce(F.col("dt"), F.lit(REGULAR_DRAFT)).alias("draft_type"),
        *select_list(_DRAFT_HEAD),
        F.replace(F.replace(F.col("name"), F.lit(MINORS_MARK), F.lit("")), F.lit("*"), F.lit("")).alias("name"),
        parse_money(F.col("bonus")).alias("bonus"),
        *select_list(_DRAFT_TAIL),
        null_texts(F.col("notes"), *MISSING_TEXTS).alias("notes"),
    )
    key = surrogate_key("year_id", "draft_type", "overall_pick").alias("draft_result_id")
    return picks.select(key, "*")
