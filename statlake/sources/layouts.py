"""Fixed file layouts: column names, file names, keys."""

from __future__ import annotations

# Lahman files whose headers are replaced by position.
BATTING_COLUMNS = """
playerID yearID stint teamID lgID G AB R H _2B _3B HR RBI SB CS BB SO IBB HBP SH SF GIDP
""".split()
BATTING_POST_COLUMNS = """
yearID round playerID teamID lgID G AB R H _2B _3B HR RBI SB CS BB SO IBB HBP SH SF GIDP
""".split()
TEAMS_COLUMNS = """
yearID lgID teamID franchID divID Rank G Ghome W L DivWin WCWin LgWin WSWin
R AB H _2B _3B HR BB SO SB CS HBP SF RA ER ERA CG SHO SV IPouts HA HRA BBA SOA E DP FP
name park attendance BPF PPF teamIDBR teamIDlahman45 teamIDretro
""".split()

# Lahman table -> file.
LAHMAN_FILES = {
    "all_star_full": "AllstarFull.csv",
    "appearances": "Appearances.csv",
    "awards_managers": "AwardsManagers.csv",
    "awards_players": "AwardsPlayers.csv",
    "award_shares_managers": "AwardsShareManagers.csv",
    "award_shares_players": "AwardsSharePlayers.csv",
    "batting": "Batting.csv",
    "batting_post": "BattingPost.csv",
    "college_playing": "CollegePlaying.csv",
    "fielding": "Fielding.csv",
    "fielding_of": "FieldingOF.csv",
    "fielding_of_split": "FieldingOFsplit.csv",
    "fielding_post": "FieldingPost.csv",
    "franchises": "TeamsFranchises.csv",
    "hall_of_fame": "HallOfFame.csv",
    "home_games": "HomeGames.csv",
    "managers": "Managers.csv",
    "managers_half": "ManagersHalf.csv",
    "parks": "Parks.csv",
    "people": "People.csv",
    "pitching": "Pitching.csv",
    "pitching_post": "PitchingPost.csv",
    "salaries": "Salaries.csv",
    "schools": "Schools.csv",
    "series_post": "SeriesPost.csv",
    "teams": "Teams.csv",
    "teams_half": "TeamsHalf.csv",
}
LAHMAN_OVERRIDES = {
    "batting": BATTING_COLUMNS,
    "batting_post": BATTING_POST_COLUMNS,
    "teams": TEAMS_COLUMNS,
}

# Game log parts, put together in file order by game_log_columns().
_LOG_HEAD = """
date game_num day_of_week visiting_team visiting_team_league visiting_team_game_num
home_team home_team_league home_team_game_num visiting_score home_score num_outs day_night
completion_info forfeit_info protest_info park_id attendance time_of_game_minutes
visiting_line_score home_line_score
""".split()
LOG_TEAM_STATS = """
abs hits doubles triples homeruns rbi sac_hits sac_flies hbp bb iw k sb cs gdp ci lob
pitchers_used individual_er er wp balks po assists errors pb dp tp
""".split()
_LOG_PEOPLE = """
ump_home ump_first ump_second ump_third ump_lf ump_rf visiting_manager home_manager
winning_pitcher losing_pitcher save_pitcher game_winning_rbi
visiting_starting_pitcher home_starting_pitcher
""".split()
SIDES = ("visiting", "home")
LINEUP_SLOTS = range(1, 10)


def game_log_columns() -> list[str]:
    """The 161 columns of a game log file, in file order."""
    stats = [f"{side}_{stat}" for side in SIDES for stat in LOG_TEAM_STATS]
    people = [f"{person}_{part}" for person in _LOG_PEOPLE for part in ("id", "name")]
    lineups = [
        f"{side}_{slot}_{part}" for side in SIDES for slot in LINEUP_SLOTS for part in ("id", "name", "pos")
    ]
    return [*_LOG_HEAD, *stats, *people, *lineups, "misc", "acquisition_info"]


# Remaining headerless layouts and renamed headers.
SEASON_SCHEDULE_COLUMNS = """
date game_num day_of_week visiting_team visiting_team_league visiting_team_game_num
home_team home_team_league home_team_game_num day_night location
postponement_cancellation date_of_makeup
""".split()
ROSTER_COLUMNS = "player_id last_name first_name bats throws team position".split()
UMPIRE_RENAMES = {"ID": "umpire_id", "last": "last_name", "first": "first_name"}
PITCH_RENAMES = {"pitcher.1": "pitcher_1", "fielder_2.1": "fielder_2_1"}
DRAFT_RENAMES = {"G.1": "GP", "Drafted Out of": "DraftedOutOf"}

# Playoff game log file suffix -> game type.
PLAYOFF_SUFFIXES = {
    "WS": "world_series",
    "AS": "all_star",
    "WC": "wild_card",
    "DV": "division_series",
    "LC": "league_championship_series",
}
# Loader label -> label of the game log model, where they differ.
MODEL_GAME_TYPES = {"all_star": "all_star_game", "wild_card": "wild_card_series"}

# Event file classes by extension letters.
EVENT_FILE_GLOBS = {
    "full": "*.[eE][vV][aAnNeErRfF]",
    "box": "*.[eE][bB][aAnNeErRfF]",
    "deduced": "*.[eE][dD][aAnNfF]",
}
