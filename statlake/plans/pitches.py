"""Pitch model: the widest fact, with one dimension in thirteen roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions import parse_long, surrogate_key
from statlake.operators.joins import resolve_roles
from statlake.plans.columns import output_names, select_list

# Raw column, type, model column, before the person columns.
_SITUATION = """
game_pk long game_id
game_date date game_date
game_year long game_year
game_type string game_type
home_team string home_team
away_team string away_team
home_score long home_score
away_score long away_score
post_home_score long post_home_score
post_away_score long post_away_score
bat_score long batting_team_score
fld_score long fielding_team_score
stand string batter_stand
p_throws string pitcher_hand
inning long inning
inning_topbot string half_inning
at_bat_number long game_plate_appearance
pitch_number long pitch_number
balls long balls
strikes long strikes
outs_when_up long outs
if_fielding_alignment string infield_alignment
of_fielding_alignment string outfield_alignment
"""
# Raw id column -> role.
_ROLES = {
    "batter": "batter",
    "pitcher": "pitcher",
    "fielder_2": "catcher",
    "fielder_3": "first_base",
    "fielder_4": "second_base",
    "fielder_5": "third_base",
    "fielder_6": "shortstop",
    "fielder_7": "left_field",
    "fielder_8": "center_field",
    "fielder_9": "right_field",
    "on_1b": "runner_on_first",
    "on_2b": "runner_on_second",
    "on_3b": "runner_on_third",
}
# Raw column, type, model column, after the person columns.
_MEASURES = """
pitch_type string pitch_type
pitch_name string pitch_name
sz_top numeric strike_zone_top
sz_bot numeric strike_zone_bottom
release_speed numeric release_speed
release_spin_rate long release_spin_rate
spin_axis long spin_axis
release_extension numeric release_extension
release_pos_x numeric release_position_x
release_pos_y numeric release_position_y
release_pos_z numeric release_position_z
vx0 numeric velocity_50_x
vy0 numeric velocity_50_y
vz0 numeric velocity_50_z
ax numeric acceleration_50_x
ay numeric acceleration_50_y
az numeric acceleration_50_z
pfx_x numeric movement_x
pfx_z numeric movement_z
plate_x numeric plate_x
plate_z numeric plate_z
zone numeric strike_zone_location
effective_speed numeric effective_speed
events string plate_appearance_result
des string plate_appearance_result_description
type string pitch_result
description string pitch_result_description
bb_type string batted_ball_type
hit_location long initial_fielder
hc_x numeric hit_coordinate_x
hc_y numeric hit_coordinate_y
hit_distance_sc numeric hit_distance
launch_speed numeric exit_velocity
launch_angle long launch_angle
launch_speed_angle long launch_speed_angle
estimated_ba_using_speedangle numeric estimated_batting_average
estimated_woba_using_speedangle numeric estimated_woba
woba_value numeric woba_value
woba_denom numeric woba_denominator
babip_value long babip_value
iso_value long number_of_extra_bases
delta_home_win_exp numeric home_win_expectancy_delta
delta_run_exp numeric run_expectancy_delta
"""


def pitches(raw: DataFrame, crosswalk: DataFrame, strategy: str | None = None) -> DataFrame:
    """Typed pitches with the person ids of everyone on the field."""
    typed = raw.select(
        *select_list(_SITUATION),
        *[parse_long(F.col(source)).alias(f"{role}_mlbam_id") for source, role in _ROLES.items()],
        *select_list(_MEASURES),
    )
    people = crosswalk.select(parse_long(F.col("mlbam_id")).alias("mlbam_id"), "person_id")
    roles = {f"{role}_mlbam_id": f"{role}_person_id" for role in _ROLES.values()}
    found = resolve_roles(typed, people, roles, "mlbam_id", "person_id", strategy)
    return found.select(
        surrogate_key("game_id", "game_plate_appearance", "pitch_number").alias("pitch_id"),
        *output_names(_SITUATION),
        *roles.values(),
        *output_names(_MEASURES),
    )
