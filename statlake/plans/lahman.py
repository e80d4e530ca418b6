"""Season models of the Lahman tables.

Each model is a typed select over a raw text table (or a union of tables), enriched with the
person id of the lookup where the raw table names a player, and led by hash keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions import (
    code_map,
    extra_base_hits,
    flag_or_false,
    on_base_percentage,
    outs_made,
    outs_to_innings,
    pitching_rates,
    plate_appearances,
    surrogate_key,
    times_on_base,
    total_bases,
)
from statlake.operators.joins import left_enrich
from statlake.operators.ranking import number_rows
from statlake.operators.unions import union_all, union_labelled, union_padded
from statlake.plans.columns import cast_as, output_names, select_list


def _with_person(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    return left_enrich(raw, lookup, {"playerid": "lahman_id"}, ["person_id"])


def _keyed(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.select(*[surrogate_key(*parts).alias(name) for name, parts in keys.items()], "*")


# Hash keys shared by the player-season models.
_SEASON_KEYS = {
    "year_team_season_player_id": ("year_id", "team_id", "is_postseason", "person_id"),
    "year_season_player_id": ("year_id", "is_postseason", "person_id"),
    "year_team_player_id": ("year_id", "team_id", "person_id"),
    "year_player_id": ("year_id", "person_id"),
}


def all_star_appearances(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        *select_list(
            """
            yearid long year_id
            lgid league_id
            teamid team_id
            gameid game_id
            gamenum long game_number
            playerid lahman_id
            gp games_played
            startingpos long starting_position
            """
        )
    )
    game = ("year_id", "league_id", "team_id", "game_id")
    return _keyed(rows, {"all_star_appearance_id": (*game, "lahman_id"), "all_star_game_id": game})


# Fielding spot in the raw name -> in the model name.
_SPOTS = {
    "all": "games", "s": "games_started", "batting": "games_at_batter", "defense": "games_at_fielder",
    "p": "games_at_pitcher", "c": "games_at_catcher", "1b": "games_at_first_base",
    "2b": "games_at_second_base", "3b": "games_at_third_base", "ss": "games_at_shortstop",
    "lf": "games_at_left_field", "cf": "games_at_center_field", "rf": "games_at_right_field",
    "of": "games_at_outfielder", "dh": "games_at_designated_hitter", "ph": "games_at_pinch_hitter",
    "pr": "games_at_pinch_runner",
}


def appearances(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    games = [
        F.col("gs" if spot == "s" else f"g_{spot}").alias(output) for spot, output in _SPOTS.items()
    ]
    rows = _with_person(raw, lookup).select(
        "person_id",
        F.col("lgid").alias("league_id"),
        F.col("teamid").alias("team_id"),
        cast_as(F.col("yearid"), "int").alias("year_id"),
        F.lit(False).alias("is_postseason"),
        *games,
    )
    return _keyed(rows, _SEASON_KEYS)


def award_shares(players: DataFrame, managers: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(union_all([players, managers]), lookup).select(
        *select_list(
            """
            yearid long year_id
            lgid league_id
            awardid name
            person_id person_id
            pointswon long points
            votesfirst long first_place_votes
            pointsmax long max_points
            """
        )
    )
    award = ("year_id", "league_id", "name")
    return _keyed(rows, {"award_share_id": (*award, "person_id"), "award_id": award})


def awards(players: DataFrame, managers: DataFrame, lookup: DataFrame) -> DataFrame:
    """Award winners; joint winners are told apart by their position in id order.

    Winners that the lookup does not know come last. The raw id, the type and the notes settle
    what the known id leaves open, so that keys are stable.
    """
    unioned = union_labelled({"player": players, "manager": managers}, "type")
    found = left_enrich(unioned, lookup, {"playerid": "lahman_id"}, ["person_id", "lahman_id"])
    rows = found.select(
        *select_list(
            """
            yearid long year_id
            lgid league_id
            awardid name
            person_id person_id
            type type
            tie yes_no is_tie
            notes notes
            lahman_id lahman_id
            playerid playerid
            """
        )
    )
    award = ["year_id", "league_id", "name"]
    unknown = F.col("lahman_id").isNull()
    order = [unknown, *[F.col(c) for c in ("playerid", "type", "notes", "person_id", "is_tie")]]
    slices = [unknown, F.substring("playerid", 1, 5)]
    numbered = number_rows(rows, award, order, slices, "unique_id")
    keyed = _keyed(numbered, {"award_tie_id": (*award, "unique_id"), "award_id": award})
    return keyed.drop("unique_id", "lahman_id", "playerid")


# Counting columns of a batting line.
_BATTING_COUNTS = """
g count games
ab count at_bats
r count runs
h count hits
_2b count doubles
_3b count triples
hr count home_runs
rbi count runs_batted_in
sb count stolen_bases
cs count caught_stealing
bb count walks
so count strikeouts
ibb count intentional_walks
hbp count hit_by_pitches
sh count sacrifice_hits
sf count sacrifice_flies
gidp count ground_into_double_plays
"""


def _both_seasons(regular: DataFrame, postseason: DataFrame) -> DataFrame:
    """Regular and postseason rows by name; the postseason round takes the stint's place."""
    return union_padded(
        [
            regular.withColumn("is_postseason", F.lit(False)),
            postseason.withColumnRenamed("round", "stint").withColumn("is_postseason", F.lit(True)),
        ]
    )


def batting(regular: DataFrame, postseason: DataFrame, lookup: DataFrame) -> DataFrame:
    lines = _with_person(_both_seasons(regular, postseason), lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            stint stint
            person_id person_id
            is_postseason is_postseason
            """
        ),
        *select_list(_BATTING_COUNTS),
    )
    derived = {
        "plate_appearances": plate_appearances(),
        "times_on_base": times_on_base(),
        "on_base_percentage": on_base_percentage(),
        "outs_made": outs_made(),
        "extra_base_hits": extra_base_hits(),
        "total_bases": total_bases(),
    }
    # Model column order.
    order = """
    year_id league_id team_id stint person_id is_postseason games plate_appearances at_bats runs
    hits doubles triples home_runs times_on_base on_base_percentage outs_made extra_base_hits
    total_bases runs_batted_in stolen_bases caught_stealing walks strikeouts intentional_walks
    hit_by_pitches sacrifice_hits sacrifice_flies ground_into_double_plays
    """.split()
    keys = {"year_team_stint_player_id": ("year_id", "team_id", "stint", "person_id"), **_SEASON_KEYS}
    return _keyed(lines.withColumns(derived).select(*order), keys)


# Position -> number on a score sheet.
POSITION_NUMBERS = {"P": 1, "C": 2, "1B": 3, "2B": 4, "3B": 5, "SS": 6, "LF": 7, "CF": 8, "RF": 9}
# From this season on outfielders come from the table that splits them by field.
SPLIT_OUTFIELD_FROM = 1954

_FIELDING_COUNTS = """
g int games
gs int games_started
innouts int outs_at_position
po int putouts
a int assists
e int errors
dp int double_plays
tp int triple_plays
pb int passed_balls
wp int wild_pitches
sb int stolen_bases_allowed
cs int caught_stealing
zr numeric zone_rating
"""


def fielding(
    regular: DataFrame, outfield_split: DataFrame, postseason: DataFrame, lookup: DataFrame
) -> DataFrame:
    year = cast_as(F.col("yearid"), "int")
    kept = regular.where(~((year >= SPLIT_OUTFIELD_FROM) & (F.col("pos") == "OF")))
    seasons = _both_seasons(union_padded([kept, outfield_split]), postseason)
    lines = _with_person(seasons, lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            stint stint
            is_postseason is_postseason
            person_id person_id
            pos position
            """
        ),
        code_map(F.col("pos"), POSITION_NUMBERS).alias("position_number"),
        *select_list(_FIELDING_COUNTS),
    )
    stint = ("year_id", "team_id", "stint", "person_id")
    keys = {
        "year_team_stint_player_position_id": (*stint, "position"),
        "year_team_stint_player_id": stint,
        **_SEASON_KEYS,
    }
    return _keyed(lines, keys)


def fielding_outfield(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        *select_list(
            """
            yearid int year_id
            stint int stint
            person_id person_id
            glf int games_at_left_field
            gcf int games_at_center_field
            grf int games_at_right_field
            """
        )
    )
    keys = {
        "year_stint_player_id": ("year_id", "stint", "person_id"),
        "year_player_id": ("year_id", "person_id"),
    }
    return _keyed(rows, keys)


def franchises(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("franchid").alias("franchise_id"),
        F.col("franchname").alias("franchise_name"),
        flag_or_false(F.col("active"), "Y").alias("is_active"),
        F.col("naassoc").alias("national_association_team_id"),
    )


def hall_of_fame(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        *select_list(
            """
            person_id person_id
            yearid int year_id
            votedby voting_body
            ballots int total_ballots_cast
            needed int votes_needed
            votes int votes_received
            inducted yes_no was_inducted
            category category
            needed_note note
            """
        )
    )
    return _keyed(rows, {"hall_of_fame_voting_result_id": ("person_id", "year_id", "voting_body")})


def manager_seasons(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            inseason int order_in_season
            person_id person_id
            g int games
            w int wins
            l int losses
            rank int position_in_standings
            plyrmgr yes_no is_player_manager
            """
        )
    )
    keys = {
        "year_team_order_id": ("year_id", "team_id", "order_in_season"),
        "year_team_manager_id": ("year_id", "team_id", "person_id"),
    }
    return _keyed(rows, keys)


def manager_split_seasons(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            inseason order_in_season
            half season_half
            person_id person_id
            g int games
            w int wins
            l int losses
            rank int position_in_standings
            """
        )
    )
    keys = {
        "year_team_order_split_id": ("year_id", "team_id", "order_in_season", "season_half"),
        "year_team_manager_split_id": ("year_id", "team_id", "person_id", "season_half"),
    }
    return _keyed(rows, keys)


def parks(raw: DataFrame) -> DataFrame:
    return raw.select(
        *select_list(
            """
            parkkey park_id
            parkname name
            parkalias alias
            city city
            state state
            country country
            """
        )
    )


_PITCHING_COUNTS = """
w int wins
l int losses
g int games
gs int games_started
gf int games_finished
cg int complete_games
sho int shutouts
sv int saves
bfp int batters_faced
ipouts int outs_pitched
h int hits
r int runs
er int earned_runs
hr int home_runs
bb int walks
so int strikeouts
ibb int intentional_walks
hbp int hit_by_pitches
wp int wild_pitches
bk int balks
sh int sacrifice_hits
sf int sacrifice_flies
gidp int ground_into_double_plays
"""
# Counting column -> model column, where they differ.
_PITCHING_OUTPUT = {
    "games": "games_pitched",
    "hits": "hits_allowed",
    "runs": "runs_allowed",
    "earned_runs": "earned_runs_allowed",
    "home_runs": "home_runs_allowed",
    "walks": "walks_allowed",
    "strikeouts": "strikeouts_thrown",
    "intentional_walks": "intentional_walks_allowed",
    "hit_by_pitches": "hit_by_pitches_allowed",
    "wild_pitches": "wild_pitches_allowed",
    "sacrifice_hits": "sacrifice_hits_allowed",
    "sacrifice_flies": "sacrifice_flies_allowed",
    "ground_into_double_plays": "ground_into_double_plays_induced",
}


def pitching(regular: DataFrame, postseason: DataFrame, lookup: DataFrame) -> DataFrame:
    """Pitching lines with rates. ``person_id`` is the lookup's, ``lahman_id`` the raw player id."""
    lines = _with_person(_both_seasons(regular, postseason), lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            stint stint
            is_postseason is_postseason
            person_id person_id
            playerid lahman_id
            """
        ),
        *select_list(_PITCHING_COUNTS),
    )
    counts = output_names(_PITCHING_COUNTS)
    shown: list[Column] = [F.col(name).alias(_PITCHING_OUTPUT.get(name, name)) for name in counts]
    innings = outs_to_innings(F.col("outs_pitched")).alias("innings_pitched")
    shown.insert(counts.index("outs_pitched") + 1, innings)
    rates = [rate.alias(name) for name, rate in pitching_rates().items()]
    identity = ["year_id", "league_id", "team_id", "stint", "is_postseason", "person_id", "lahman_id"]
    stint_key = ("year_id", "team_id", "stint", "is_postseason", "person_id")
    return _keyed(
        lines.select(*identity, *shown, *rates),
        {"year_team_stint_season_player_id": stint_key, **_SEASON_KEYS},
    )


def player_college_seasons(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        "person_id", F.col("yearid").alias("year_id"), F.col("schoolid").alias("school_id")
    )
    return _keyed(rows, {"player_college_season_id": ("person_id", "year_id", "school_id")})


def postseason_series(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        *select_list(
            """
            yearid year_id
            round round
            teamidwinner winner_team_id
            lgidwinner winner_league_id
            teamidloser loser_team_id
            lgidloser loser_league_id
            wins int wins
            losses int losses
            ties int ties
            """
        )
    )
    return _keyed(rows, {"postseason_series_id": ("year_id", "round", "winner_team_id", "loser_team_id")})


def salaries(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = _with_person(raw, lookup).select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            teamid team_id
            person_id person_id
            salary int salary
            """
        )
    )
    return _keyed(rows, {"year_team_player_id": ("year_id", "team_id", "person_id")})


def schools(raw: DataFrame) -> DataFrame:
    return raw.select(
        *select_list(
            """
            schoolid school_id
            name_full name
            city city
            state state
            country country
            """
        )
    )


def team_home_games(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        *select_list(
            """
            yearkey int year_id
            leaguekey league_id
            teamkey team_id
            parkkey park_id
            spanfirst date first_game_date
            spanlast date last_game_date
            games int games
            openings int dates_played
            attendance int attendance
            """
        )
    )
    return _keyed(rows, {"team_home_games_id": ("year_id", "team_id", "park_id")})


def team_split_seasons(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        *select_list(
            """
            yearid int year_id
            lgid league_id
            divid division_id
            half season_half
            teamid team_id
            rank position_in_standings
            g int games
            w int wins
            l int losses
            divwin yes_no is_division_winner
            """
        )
    )
    key = ("year_id", "league_id", "division_id", "season_half", "team_id")
    return _keyed(rows, {"team_split_season_id": key})


def teams(raw: DataFrame) -> DataFrame:
    """Team seasons. Earned run average and fielding percentage keep their fraction."""
    return raw.select(
        *select_list(
            """
            teamid team_id
            franchid franchise_id
            divid division_id
            lgid league_id
            yearid int year_id
            teamidbr baseball_reference_id
            teamidretro retrosheet_id
            name name
            park park
            attendance int attendance
            rank int standings_rank
            g int games
            ghome int home_games
            w int wins
            l int losses
            divwin yes_no is_division_winner
            wcwin yes_no is_wild_card_winner
            lgwin yes_no is_league_champion
            wswin yes_no is_world_series_champion
            r int runs_scored
            ab int at_bats
            h int hits
            _2b int doubles
            _3b int triples
            hr int home_runs
            bb int walks
            so int strikeouts
            sb int stolen_bases
            cs int caught_stealing
            hbp int hit_by_pitch
            sf int sacrifice_flies
            ra int runs_allowed
            er int earned_runs_allowed
            era numeric earned_run_average
            cg int complete_games
            sho int shutouts
            sv int saves
            ipouts int outs_pitched
            ha int hits_allowed
            hra int home_runs_allowed
            bba int walks_allowed
            soa int strikeouts_pitched
            e int errors
            dp int double_plays
            fp numeric fielding_percentage
            bpf int batting_park_factor
            ppf int pitching_park_factor
            """
        )
    )
