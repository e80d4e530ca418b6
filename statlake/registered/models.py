"""Every model over season tables derived from the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from statlake.plans import comparison, game_logs, lahman, leaderboards, pitches, register, team_ids, war
from statlake.plans.columns import output_names
from statlake.registered.base import Registry, Tables, key_sql, typed_sql, with_inputs
from statlake.sources import layouts

REGISTRY = Registry()

# "Today" of the date guard: fixed, so that both engines agree on any day.
_TODAY = dt.date(2026, 1, 1)
_PERSON = "LEFT JOIN lookup ON playerid = lahman_id"

_SEASON_KEYS = (
    f"{key_sql('year_id', 'team_id', 'is_postseason', 'person_id')} AS year_team_season_player_id, "
    f"{key_sql('year_id', 'is_postseason', 'person_id')} AS year_season_player_id, "
    f"{key_sql('year_id', 'team_id', 'person_id')} AS year_team_player_id, "
    f"{key_sql('year_id', 'person_id')} AS year_player_id"
)


def _keyed(rows: str, *keys: str) -> str:
    return with_inputs(f"WITH rows_ AS ({rows}) SELECT {', '.join(keys)}, * FROM rows_")


def _key(name: str, *parts: str) -> str:
    return f"{key_sql(*parts)} AS {name}"


# ---- register and lookup ---------------------------------------------------------------

_SPANS = " ".join(
    f"TRY_CAST({level}_{role}_{edge} AS BIGINT) AS {edge}_{name}_game_{role},"
    for role in ("played", "managed", "umpired")
    for level, name in (("pro", "pro"), ("mlb", "mlb"), ("col", "college"))
    if (level, role) != ("col", "umpired")
    for edge in ("first", "last")
).rstrip(",")


def _life(event: str) -> str:
    y, m, d = (f"TRY_CAST({event}_{part} AS BIGINT)" for part in ("year", "month", "day"))
    return f"""
      CASE WHEN {y} BETWEEN 1800 AND 2026 AND {m} IS NOT NULL AND {d} IS NOT NULL
        THEN CAST(TRY_CAST({y} || '-' || {m} || '-' || {d} AS DATE) AS VARCHAR) END AS {event}_date,
      {y} AS {event}_year, {m} AS {event}_month, {d} AS {event}_day"""


@REGISTRY.add(
    "model_register",
    with_inputs(f"""
    SELECT {typed_sql(register._IDS)}, {typed_sql(register._NAMES)},
      strip_accents(name_last) AS last_name, strip_accents(name_first) AS first_name,
      strip_accents(name_given) AS given_name, {_life('birth')}, {_life('death')}, {_SPANS}
    FROM register_raw
    """),
)
def _(t: Tables):
    return register.register(t.register_raw, F.lit(_TODAY))


@REGISTRY.add("model_person_id_lookup", with_inputs("SELECT person_id, lahman_id FROM lookup"))
def _(t: Tables):
    return register.person_id_lookup(t.people, t.crosswalk)


# ---- flagship --------------------------------------------------------------------------

COMPARISON_SQL = with_inputs("""
    WITH bb AS (
      SELECT person_id, year_id, SUM(TRY_CAST(war AS DECIMAL(6,2))) AS war
      FROM raw_batting_war LEFT JOIN crosswalk ON player_id = baseball_reference_id GROUP BY ALL),
    bp AS (
      SELECT person_id, year_id, SUM(TRY_CAST(war AS DECIMAL(5,2))) AS war
      FROM raw_pitching_war LEFT JOIN crosswalk ON player_id = baseball_reference_id GROUP BY ALL),
    fb AS (
      SELECT person_id, season AS year_id, SUM(CAST(war AS DECIMAL(18,2))) AS war
      FROM raw_fg_batting JOIN crosswalk ON playerid = fangraphs_id GROUP BY ALL),
    fp AS (
      SELECT person_id, season AS year_id, SUM(CAST(war AS DECIMAL(18,2))) AS war
      FROM raw_fg_pitching JOIN crosswalk ON playerid = fangraphs_id GROUP BY ALL),
    one AS (
      SELECT COALESCE(bb.person_id, bp.person_id) AS person_id, COALESCE(bb.year_id, bp.year_id) AS year_id,
        COALESCE(bb.war, 0) + COALESCE(bp.war, 0) AS war
      FROM bb FULL JOIN bp ON bb.person_id = bp.person_id AND bb.year_id = bp.year_id),
    two AS (
      SELECT COALESCE(fb.person_id, fp.person_id) AS person_id, COALESCE(fb.year_id, fp.year_id) AS year_id,
        COALESCE(fb.war, 0) + COALESCE(fp.war, 0) AS war
      FROM fb FULL JOIN fp ON fb.person_id = fp.person_id AND fb.year_id = fp.year_id),
    matched AS (
      SELECT COALESCE(one.person_id, two.person_id) AS person_id, COALESCE(one.year_id, two.year_id) AS year_id,
        one.war AS w1, two.war AS w2
      FROM one FULL JOIN two ON one.person_id = two.person_id AND one.year_id = two.year_id)
    SELECT m.person_id, first_name, last_name, m.year_id, CAST(w1 AS DOUBLE) AS bbref_war,
      CAST(w2 AS DOUBLE) AS fangraphs_war, CAST(w1 + w2 AS DOUBLE) / 2 AS average_war,
      CAST(ABS(w1 - w2) AS DOUBLE) AS war_difference
    FROM matched m LEFT JOIN crosswalk c ON m.person_id = c.person_id
""")


def comparison_query(t: Tables):
    batting = war.batting_war(t.raw_batting_war, t.crosswalk)
    pitching = war.pitching_war(t.raw_pitching_war, t.crosswalk)
    boards = [
        leaderboards.loaded_leaderboard(raw).withColumn("war", F.col("war").cast("decimal(18,2)"))
        for raw in (t.raw_fg_batting, t.raw_fg_pitching)
    ]
    return comparison.war_comparison(batting, pitching, *boards, t.crosswalk)


REGISTRY.add("comparison_full_outer", COMPARISON_SQL)(comparison_query)


# ---- wins above replacement, draft -----------------------------------------------------

_WAR_KEYS = ", ".join(
    [
        _key("player_stint_year_id", "person_id", "stint_id", "team_id", "year_id", "FALSE"),
        _key("player_year_team_id", "person_id", "team_id", "year_id"),
        _key("player_year_id", "person_id", "year_id"),
    ]
)
_WAR_IDENTITY = f"person_id, {typed_sql(war._IDENTITY)}, FALSE AS is_postseason"
_LOADED = {plain: loaded for loaded, plain in war._LOADED_NAMES.items()}


def _war_sql(raw: str, table: str, mlbam: str, first: str = "") -> str:
    return with_inputs(f"""
    SELECT {_WAR_KEYS}, {_WAR_IDENTITY}, {mlbam} AS mlbam_id, {first} {typed_sql(table)}
    FROM {raw} LEFT JOIN (SELECT person_id, baseball_reference_id AS ref_id FROM crosswalk) c ON player_id = ref_id
    """)


def _loaded_names(table: str) -> str:
    lines = [line.split() for line in table.strip().splitlines()]
    return "\n".join(" ".join([_LOADED.get(words[0], words[0]), *words[1:]]) for words in lines)


_IS_PITCHER = "CASE pitcher WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_pitcher,"


@REGISTRY.add("model_batting_war", _war_sql("raw_batting_war", war._BATTING, "mlb_id", _IS_PITCHER))
def _(t: Tables):
    return war.batting_war(t.raw_batting_war, t.crosswalk)


@REGISTRY.add(
    "model_batting_war_loaded",
    _war_sql("raw_batting_war_loaded", _loaded_names(war._BATTING), "CAST(mlb_id AS BIGINT)", _IS_PITCHER),
)
def _(t: Tables):
    return war.batting_war_loaded(t.raw_batting_war_loaded, t.crosswalk)


@REGISTRY.add("model_pitching_war", _war_sql("raw_pitching_war", war._PITCHING, "mlb_id"))
def _(t: Tables):
    return war.pitching_war(t.raw_pitching_war, t.crosswalk)


@REGISTRY.add(
    "model_pitching_war_loaded",
    _war_sql("raw_pitching_war_loaded", _loaded_names(war._PITCHING), "CAST(mlb_id AS BIGINT)"),
)
def _(t: Tables):
    return war.pitching_war_loaded(t.raw_pitching_war_loaded, t.crosswalk)


@REGISTRY.add(
    "model_draft_results",
    _keyed(
        """
        SELECT year AS year_id, COALESCE(dt, '6rg') AS draft_type, rnd AS round, rdpck AS round_pick,
          ovpck AS overall_pick, team_id, tm AS team_name, person_id,
          replace(replace(name, chr(160) || '(minors)', ''), '*', '') AS name,
          TRY_CAST(regexp_replace(bonus, '[$,]', '', 'g') AS INTEGER) AS bonus, pos AS position,
          draftedoutof AS school, type AS school_type,
          CASE WHEN notes NOT IN ('NA', 'nan', 'None') THEN notes END AS notes
        FROM raw_draft LEFT JOIN crosswalk ON player_id = CASE id_type
          WHEN 'baseball_reference_id' THEN baseball_reference_id
          WHEN 'baseball_reference_minor_league_id' THEN baseball_reference_minor_league_id END
        """,
        _key("draft_result_id", "year_id", "draft_type", "overall_pick"),
    ),
)
def _(t: Tables):
    return war.draft_results(t.raw_draft, t.crosswalk)


# ---- leaderboards ----------------------------------------------------------------------

_JSON_SQL = with_inputs("""
    SELECT TRY_CAST(record_content::JSON ->> 'playerid' AS INTEGER) AS fangraphs_id,
      TRY_CAST(record_content::JSON ->> 'Season' AS INTEGER) AS year_id, record_content, extracted_at
    FROM raw_fg_json
""")


def _json_query(t: Tables):
    return leaderboards.json_leaderboard(t.raw_fg_json)


for _name in ("batting", "pitching", "fielding"):
    REGISTRY.add(f"model_json_{_name}", _JSON_SQL)(_json_query)
for _name in ("batting", "pitching"):
    REGISTRY.add(
        f"model_loaded_{_name}",
        with_inputs(f"""
        SELECT playerid AS fangraphs_id, mlbamid AS mlbam_id, season AS year_id, war, team FROM raw_fg_{_name}
        """),
    )(lambda t, name=_name: leaderboards.loaded_leaderboard(getattr(t, f"raw_fg_{name}")))


@REGISTRY.add(
    "model_loaded_fielding",
    with_inputs("SELECT playerid AS fangraphs_id, season AS year_id, team FROM raw_fg_fielding"),
)
def _(t: Tables):
    return leaderboards.loaded_leaderboard(t.raw_fg_fielding)


# A sample record: its keys give the fields, its values the types.
_DICTIONARY = leaderboards.Dictionary.from_rows(
    [
        {"group": "context", "raw_name": "playerid", "column_name": "fangraphs_id", "type": "int64"},
        {"group": "context", "raw_name": "Season", "column_name": "year_id", "type": "int64"},
        {"group": "context", "raw_name": "teamid", "column_name": "team_id", "type": "varchar"},
        {"group": "standard_and_advanced", "raw_name": "1B", "column_name": "singles", "type": "int64"},
        {"group": "standard_and_advanced", "raw_name": "BB%", "column_name": "walk_percentage", "type": "numeric"},
        {"group": "value", "raw_name": "wRC+", "column_name": "weighted_runs_created_plus", "type": "int64"},
    ]
)


@REGISTRY.add(
    "model_batting_records",
    with_inputs("""
    WITH parsed AS (SELECT record_content::JSON AS j FROM raw_fg_json),
    typed AS (
      SELECT TRY_CAST(j ->> 'playerid' AS INTEGER) AS playerid, TRY_CAST(j ->> 'Season' AS INTEGER) AS season,
        TRY_CAST(j ->> '1B' AS INTEGER) AS _1b, TRY_CAST(j ->> 'BB%' AS DOUBLE) AS bb_pct,
        j ->> 'Name' AS name, TRY_CAST(j ->> 'teamid' AS INTEGER) AS teamid,
        TRY_CAST(j ->> 'wRC+' AS DOUBLE) AS wrc_plus
      FROM parsed)
    SELECT playerid, playerid AS fangraphs_id, season, season AS year_id, _1b, _1b AS singles, bb_pct,
      bb_pct AS walk_percentage, name, typed.teamid, typed.teamid AS team_id, wrc_plus,
      wrc_plus AS weighted_runs_created_plus, c.person_id, c.mlbam_id, c.baseball_reference_id,
      c.baseball_reference_minor_league_id, c.fangraphs_id AS register_fangraphs_id, c.first_name, c.last_name,
      i.yearID AS team_year_id, i.lgID AS league_id, i.teamID AS team_team_id, i.franchID AS franchise_id,
      i.teamIDfg AS fangraphs_team_id, i.teamIDBR AS baseball_reference_team_id,
      i.teamIDretro AS retrosheet_team_id,
      CASE WHEN i.teamID IS NOT NULL THEN """ + key_sql("i.yearID", "i.teamID") + """ END AS year_team_id
    FROM typed LEFT JOIN crosswalk c ON playerid = c.fangraphs_id
    LEFT JOIN raw_team_ids i ON CAST(typed.teamid AS VARCHAR) = i.teamIDfg AND CAST(season AS VARCHAR) = i.yearID
    """),
)
def _(t: Tables):
    ids = team_ids.fangraphs_team_ids(t.raw_team_ids)
    typed = leaderboards.record_schema_of(t.raw_fg_json)
    return leaderboards.batting_records(t.raw_fg_json, typed, _DICTIONARY, t.crosswalk, ids)


@REGISTRY.add(
    "model_fangraphs_team_ids",
    _keyed(f"SELECT {typed_sql(team_ids._TEAM_IDS)} FROM raw_team_ids", _key("year_team_id", "year_id", "team_id")),
)
def _(t: Tables):
    return team_ids.fangraphs_team_ids(t.raw_team_ids)


# ---- Lahman ----------------------------------------------------------------------------

@REGISTRY.add(
    "model_all_star_appearances",
    _keyed(
        """
        SELECT TRY_CAST(yearid AS BIGINT) AS year_id, lgid AS league_id, teamid AS team_id, gameid AS game_id,
          TRY_CAST(gamenum AS BIGINT) AS game_number, playerid AS lahman_id, gp AS games_played,
          TRY_CAST(startingpos AS BIGINT) AS starting_position
        FROM raw_all_star
        """,
        _key("all_star_appearance_id", "year_id", "league_id", "team_id", "game_id", "lahman_id"),
        _key("all_star_game_id", "year_id", "league_id", "team_id", "game_id"),
    ),
)
def _(t: Tables):
    return lahman.all_star_appearances(t.raw_all_star)


_SPOTS = ", ".join(
    f"{'gs' if spot == 's' else 'g_' + spot} AS {output}" for spot, output in lahman._SPOTS.items()
)


@REGISTRY.add(
    "model_appearances",
    _keyed(
        f"""
        SELECT person_id, lgid AS league_id, teamid AS team_id, CAST(yearid AS INTEGER) AS year_id,
          FALSE AS is_postseason, {_SPOTS} FROM raw_appearances {_PERSON}
        """,
        _SEASON_KEYS,
    ),
)
def _(t: Tables):
    return lahman.appearances(t.raw_appearances, t.lookup)


@REGISTRY.add(
    "model_award_shares",
    _keyed(
        f"""
        SELECT CAST(yearid AS BIGINT) AS year_id, lgid AS league_id, awardid AS name, person_id,
          CAST(pointswon AS BIGINT) AS points, CAST(votesfirst AS BIGINT) AS first_place_votes,
          CAST(pointsmax AS BIGINT) AS max_points
        FROM (SELECT * FROM raw_shares_players UNION ALL SELECT * FROM raw_shares_managers) {_PERSON}
        """,
        _key("award_share_id", "year_id", "league_id", "name", "person_id"),
        _key("award_id", "year_id", "league_id", "name"),
    ),
)
def _(t: Tables):
    return lahman.award_shares(t.raw_shares_players, t.raw_shares_managers, t.lookup)


@REGISTRY.add(
    "model_awards",
    with_inputs(f"""
    WITH both_ AS (
      SELECT *, 'player' AS type FROM raw_awards_players
      UNION ALL SELECT *, 'manager' AS type FROM raw_awards_managers),
    named AS (
      SELECT CAST(yearid AS BIGINT) AS year_id, lgid AS league_id, awardid AS name, person_id, type,
        CASE tie WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_tie, notes, playerid, lahman_id
      FROM both_ {_PERSON}),
    placed AS (
      SELECT *, row_number() OVER (
        PARTITION BY year_id, league_id, name ORDER BY lahman_id NULLS LAST, playerid, type, notes) AS place
      FROM named)
    SELECT {key_sql('year_id', 'league_id', 'name', 'place')} AS award_tie_id,
      {key_sql('year_id', 'league_id', 'name')} AS award_id, year_id, league_id, name, person_id, type, is_tie, notes
    FROM placed
    """),
)
def _(t: Tables):
    return lahman.awards(t.raw_awards_players, t.raw_awards_managers, t.lookup)


def _both(regular: str, post: str) -> str:
    return (
        f"(SELECT *, FALSE AS is_postseason FROM {regular} UNION ALL BY NAME "
        f"SELECT * RENAME (round AS stint), TRUE AS is_postseason FROM {post})"
    )


def _ratio(top: str, bottom: str, digits: int) -> str:
    # The last term turns a negative zero into zero.
    return f"CASE WHEN ({bottom}) = 0 THEN 0.0 ELSE round(CAST({top} AS DOUBLE) / ({bottom}), {digits}) + 0.0 END"


@REGISTRY.add(
    "model_batting",
    _keyed(
        f"""
        SELECT *, at_bats + walks + hit_by_pitches + sacrifice_hits + sacrifice_flies AS plate_appearances,
          hits + walks + hit_by_pitches AS times_on_base,
          {_ratio('(hits + walks + hit_by_pitches)', 'at_bats + walks + hit_by_pitches + sacrifice_flies', 3)}
            AS on_base_percentage,
          at_bats - hits + sacrifice_hits + sacrifice_flies + ground_into_double_plays + caught_stealing AS outs_made,
          doubles + triples + home_runs AS extra_base_hits,
          hits + doubles + 2 * triples + 3 * home_runs AS total_bases
        FROM (
          SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id, stint, person_id,
            is_postseason, {typed_sql(lahman._BATTING_COUNTS)}
          FROM {_both('raw_batting', 'raw_batting_post')} {_PERSON})
        """,
        _key("year_team_stint_player_id", "year_id", "team_id", "stint", "person_id"),
        _SEASON_KEYS,
    ),
)
def _(t: Tables):
    return lahman.batting(t.raw_batting, t.raw_batting_post, t.lookup)


@REGISTRY.add(
    "model_fielding",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id, stint, is_postseason,
          person_id, pos AS position,
          CASE pos WHEN 'P' THEN 1 WHEN 'C' THEN 2 WHEN '1B' THEN 3 WHEN '2B' THEN 4 WHEN '3B' THEN 5
            WHEN 'SS' THEN 6 WHEN 'LF' THEN 7 WHEN 'CF' THEN 8 WHEN 'RF' THEN 9 END AS position_number,
          {typed_sql(lahman._FIELDING_COUNTS)}
        FROM (
          SELECT *, FALSE AS is_postseason FROM raw_fielding WHERE NOT (CAST(yearid AS INT) >= 1954 AND pos = 'OF')
          UNION ALL BY NAME SELECT *, FALSE AS is_postseason FROM raw_fielding_split
          UNION ALL BY NAME SELECT * RENAME (round AS stint), TRUE AS is_postseason FROM raw_fielding_post) {_PERSON}
        """,
        _key("year_team_stint_player_position_id", "year_id", "team_id", "stint", "person_id", "position"),
        _key("year_team_stint_player_id", "year_id", "team_id", "stint", "person_id"),
        _SEASON_KEYS,
    ),
)
def _(t: Tables):
    return lahman.fielding(t.raw_fielding, t.raw_fielding_split, t.raw_fielding_post, t.lookup)


@REGISTRY.add(
    "model_fielding_outfield",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, CAST(stint AS INTEGER) AS stint, person_id,
          TRY_CAST(glf AS INTEGER) AS games_at_left_field, TRY_CAST(gcf AS INTEGER) AS games_at_center_field,
          TRY_CAST(grf AS INTEGER) AS games_at_right_field
        FROM raw_fielding_of {_PERSON}
        """,
        _key("year_stint_player_id", "year_id", "stint", "person_id"),
        _key("year_player_id", "year_id", "person_id"),
    ),
)
def _(t: Tables):
    return lahman.fielding_outfield(t.raw_fielding_of, t.lookup)


@REGISTRY.add(
    "model_franchises",
    with_inputs("""
    SELECT franchid AS franchise_id, franchname AS franchise_name, COALESCE(active = 'Y', FALSE) AS is_active,
      naassoc AS national_association_team_id FROM raw_franchises
    """),
)
def _(t: Tables):
    return lahman.franchises(t.raw_franchises)


@REGISTRY.add(
    "model_hall_of_fame",
    _keyed(
        f"""
        SELECT person_id, CAST(yearid AS INTEGER) AS year_id, votedby AS voting_body,
          TRY_CAST(ballots AS INTEGER) AS total_ballots_cast, TRY_CAST(needed AS INTEGER) AS votes_needed,
          TRY_CAST(votes AS INTEGER) AS votes_received,
          CASE inducted WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS was_inducted, category, needed_note AS note
        FROM raw_hall_of_fame {_PERSON}
        """,
        _key("hall_of_fame_voting_result_id", "person_id", "year_id", "voting_body"),
    ),
)
def _(t: Tables):
    return lahman.hall_of_fame(t.raw_hall_of_fame, t.lookup)


_STANDING = """
TRY_CAST(g AS INTEGER) AS games, TRY_CAST(w AS INTEGER) AS wins, TRY_CAST(l AS INTEGER) AS losses
"""


@REGISTRY.add(
    "model_manager_seasons",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id,
          CAST(inseason AS INTEGER) AS order_in_season, person_id, {_STANDING},
          CAST(rank AS INTEGER) AS position_in_standings,
          CASE plyrmgr WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_player_manager
        FROM raw_managers {_PERSON}
        """,
        _key("year_team_order_id", "year_id", "team_id", "order_in_season"),
        _key("year_team_manager_id", "year_id", "team_id", "person_id"),
    ),
)
def _(t: Tables):
    return lahman.manager_seasons(t.raw_managers, t.lookup)


@REGISTRY.add(
    "model_manager_split_seasons",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id,
          inseason AS order_in_season, half AS season_half, person_id, {_STANDING},
          CAST(rank AS INTEGER) AS position_in_standings
        FROM raw_managers_half {_PERSON}
        """,
        _key("year_team_order_split_id", "year_id", "team_id", "order_in_season", "season_half"),
        _key("year_team_manager_split_id", "year_id", "team_id", "person_id", "season_half"),
    ),
)
def _(t: Tables):
    return lahman.manager_split_seasons(t.raw_managers_half, t.lookup)


@REGISTRY.add(
    "model_parks",
    with_inputs("""
    SELECT parkkey AS park_id, parkname AS name, parkalias AS alias, city, state, country FROM raw_parks
    """),
)
def _(t: Tables):
    return lahman.parks(t.raw_parks)


def _nine(count: str, digits: int) -> str:
    return _ratio(f"({count} * 27)", "outs_pitched", digits)


_CHARGED = "batters_faced - walks - hit_by_pitches - sacrifice_hits"
_PITCHING_SHOWN = ", ".join(
    f"{name} AS {lahman._PITCHING_OUTPUT.get(name, name)}" for name in output_names(lahman._PITCHING_COUNTS)
)


@REGISTRY.add(
    "model_pitching",
    _keyed(
        f"""
        SELECT year_id, league_id, team_id, stint, is_postseason, person_id, lahman_id, {_PITCHING_SHOWN},
          CAST(outs_pitched // 3 AS VARCHAR) || '.' || CAST(outs_pitched % 3 AS VARCHAR) AS innings_pitched,
          {_ratio('hits', _CHARGED + ' - sacrifice_flies', 3)} AS batting_average_against,
          {_ratio('(hits - home_runs)', _CHARGED + ' - strikeouts - home_runs', 3)} AS batting_average_on_balls_in_play,
          {_nine('runs', 2)} AS runs_allowed_average, {_nine('earned_runs', 2)} AS earned_runs_allowed_average,
          {_ratio('((walks + hits) * 3)', 'outs_pitched', 3)} AS whip,
          {_nine('hits', 1)} AS hits_allowed_per_nine, {_nine('home_runs', 1)} AS home_runs_allowed_per_nine,
          {_nine('walks', 1)} AS walks_allowed_per_nine,
          {_ratio('walks', 'strikeouts', 2)} AS walks_allowed_per_strikeout_thrown,
          {_ratio('strikeouts', 'batters_faced', 3)} AS strikeouts_thrown_rate,
          {_ratio('walks', 'batters_faced', 3)} AS walks_allowed_rate,
          {_ratio('home_runs', 'batters_faced', 3)} AS home_runs_allowed_rate
        FROM (
          SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id, stint, is_postseason,
            person_id, playerid AS lahman_id, {typed_sql(lahman._PITCHING_COUNTS)}
          FROM {_both('raw_pitching', 'raw_pitching_post')}
          LEFT JOIN (SELECT person_id, lahman_id AS known_id FROM lookup) k ON playerid = known_id)
        """,
        _key("year_team_stint_season_player_id", "year_id", "team_id", "stint", "is_postseason", "person_id"),
        _SEASON_KEYS,
    ),
)
def _(t: Tables):
    return lahman.pitching(t.raw_pitching, t.raw_pitching_post, t.lookup)


@REGISTRY.add(
    "model_player_college_seasons",
    _keyed(
        f"SELECT person_id, yearid AS year_id, schoolid AS school_id FROM raw_college_playing {_PERSON}",
        _key("player_college_season_id", "person_id", "year_id", "school_id"),
    ),
)
def _(t: Tables):
    return lahman.player_college_seasons(t.raw_college_playing, t.lookup)


@REGISTRY.add(
    "model_postseason_series",
    _keyed(
        """
        SELECT yearid AS year_id, round, teamidwinner AS winner_team_id, lgidwinner AS winner_league_id,
          teamidloser AS loser_team_id, lgidloser AS loser_league_id, CAST(wins AS INTEGER) AS wins,
          CAST(losses AS INTEGER) AS losses, CAST(ties AS INTEGER) AS ties FROM raw_series_post
        """,
        _key("postseason_series_id", "year_id", "round", "winner_team_id", "loser_team_id"),
    ),
)
def _(t: Tables):
    return lahman.postseason_series(t.raw_series_post)


@REGISTRY.add(
    "model_salaries",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, teamid AS team_id, person_id,
          TRY_CAST(salary AS INTEGER) AS salary FROM raw_salaries {_PERSON}
        """,
        _key("year_team_player_id", "year_id", "team_id", "person_id"),
    ),
)
def _(t: Tables):
    return lahman.salaries(t.raw_salaries, t.lookup)


@REGISTRY.add(
    "model_schools",
    with_inputs("SELECT schoolid AS school_id, name_full AS name, city, state, country FROM raw_schools"),
)
def _(t: Tables):
    return lahman.schools(t.raw_schools)


@REGISTRY.add(
    "model_team_home_games",
    _keyed(
        """
        SELECT CAST(yearkey AS INTEGER) AS year_id, leaguekey AS league_id, teamkey AS team_id, parkkey AS park_id,
          CAST(TRY_CAST(spanfirst AS DATE) AS VARCHAR) AS first_game_date,
          CAST(TRY_CAST(spanlast AS DATE) AS VARCHAR) AS last_game_date, CAST(games AS INTEGER) AS games,
          CAST(openings AS INTEGER) AS dates_played, CAST(attendance AS INTEGER) AS attendance FROM raw_home_games
        """,
        _key("team_home_games_id", "year_id", "team_id", "park_id"),
    ),
)
def _(t: Tables):
    return lahman.team_home_games(t.raw_home_games)


@REGISTRY.add(
    "model_team_split_seasons",
    _keyed(
        f"""
        SELECT CAST(yearid AS INTEGER) AS year_id, lgid AS league_id, divid AS division_id, half AS season_half,
          teamid AS team_id, rank AS position_in_standings, {_STANDING},
          CASE divwin WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_division_winner FROM raw_teams_half
        """,
        _key("team_split_season_id", "year_id", "league_id", "division_id", "season_half", "team_id"),
    ),
)
def _(t: Tables):
    return lahman.team_split_seasons(t.raw_teams_half)


_TEAM_COUNTS = """
attendance attendance, rank standings_rank, g games, ghome home_games, w wins, l losses, r runs_scored,
ab at_bats, h hits, _2b doubles, _3b triples, hr home_runs, bb walks, so strikeouts, sb stolen_bases,
cs caught_stealing, hbp hit_by_pitch, sf sacrifice_flies, ra runs_allowed, er earned_runs_allowed,
cg complete_games, sho shutouts, sv saves, ipouts outs_pitched, ha hits_allowed, hra home_runs_allowed,
bba walks_allowed, soa strikeouts_pitched, e errors, dp double_plays, bpf batting_park_factor,
ppf pitching_park_factor
"""
_TEAM_FLAGS = {
    "divwin": "is_division_winner", "wcwin": "is_wild_card_winner", "lgwin": "is_league_champion",
    "wswin": "is_world_series_champion",
}
_TEAM_ITEMS = [
    *[f"TRY_CAST({a} AS INTEGER) AS {b}" for a, b in (item.split() for item in _TEAM_COUNTS.split(","))],
    *[f"CASE {a} WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS {b}" for a, b in _TEAM_FLAGS.items()],
]


@REGISTRY.add(
    "model_teams",
    with_inputs(f"""
    SELECT teamid AS team_id, franchid AS franchise_id, divid AS division_id, lgid AS league_id,
      CAST(yearid AS INTEGER) AS year_id, teamidbr AS baseball_reference_id, teamidretro AS retrosheet_id,
      name, park, {', '.join(_TEAM_ITEMS)}, CAST(CAST(era AS DECIMAL(18,3)) AS DOUBLE) AS earned_run_average,
      CAST(CAST(fp AS DECIMAL(18,3)) AS DOUBLE) AS fielding_percentage FROM raw_teams
    """),
)
def _(t: Tables):
    return lahman.teams(t.raw_teams)


# ---- game logs, pitches ----------------------------------------------------------------

_LOG_STATUS = {
    "P": ("regular_season", "all_star_game", "division_series"),
    "F": ("league_championship_series", "wild_card_series", "world_series"),
}


def _log_columns() -> dict[str, str]:
    """Raw game log columns as SQL over orders, for both engines."""
    fixed = {
        "date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
        "game_num": "CAST(o_orderkey % 3 AS STRING)",
        "visiting_team": "CASE WHEN o_orderkey % 7 <> 0 THEN 'V' || CAST(o_custkey % 30 AS STRING) END",
        "home_team": "'H' || CAST(o_custkey % 29 AS STRING)",
        "day_night": "CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'N' END",
    }
    columns = {}
    for i, name in enumerate(layouts.game_log_columns(), start=2):
        if name in fixed:
            columns[name] = fixed[name]
        elif name.endswith(("_id", "_pos")):
            columns[name] = f"'i' || CAST((o_custkey + {i}) % 90 AS STRING)"
        elif name.endswith("_name"):
            columns[name] = f"CASE WHEN (o_orderkey + {i}) % 4 = 0 THEN '(none)' ELSE 'n' || CAST(o_custkey % 50 AS STRING) END"
        else:
            columns[name] = f"CASE WHEN (o_orderkey + {i}) % 11 = 0 THEN '' ELSE CAST((o_orderkey * {i}) % 60 AS STRING) END"
    return columns


_LOG_ITEMS = ", ".join(f"{sql} AS {name}" for name, sql in _log_columns().items())


def _log_sources() -> dict[str, str]:
    kinds = [kind for group in _LOG_STATUS.values() for kind in group]
    return {kind: f"SELECT {_LOG_ITEMS} FROM orders WHERE o_orderkey % 6 = {i}" for i, kind in enumerate(kinds)}


def _log_scan() -> str:
    """All six types in one scan, as the files' reader gives them."""
    whens = " ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(_log_sources()))
    return f"SELECT {_LOG_ITEMS}, CASE o_orderkey % 6 {whens} END AS game_type FROM orders"


def _game_log_sql() -> str:
    unioned = " UNION ALL ".join(f"SELECT *, '{kind}' AS game_type FROM ({sql})" for kind, sql in _log_sources().items())
    stats = ", ".join(
        f"TRY_CAST({side}_{stat} AS BIGINT) AS {side}_{game_logs._STAT_NAMES.get(stat, stat)}"
        for side in layouts.SIDES
        for stat in layouts.LOG_TEAM_STATS
    )
    people = []
    for source, output in game_logs._PEOPLE.items():
        name = f"NULLIF({source}_name, '(none)')" if source in game_logs._NONE_FOR else f"{source}_name"
        people += [f"{source}_id AS {output}_retrosheet_id", f"{name} AS {output}"]
    slots = ", ".join(
        f"{s}_{i}_id AS {s}_batter_{i}_retrosheet_id, {s}_{i}_name AS {s}_batter_{i}, {s}_{i}_pos AS {s}_batter_{i}_position"
        for s in layouts.SIDES
        for i in layouts.LINEUP_SLOTS
    )
    return with_inputs(f"""
    WITH logs AS ({unioned})
    SELECT md5(concat(date, visiting_team, home_team, game_num)) AS retrosheet_game_id, {typed_sql(game_logs._HEAD)},
      COALESCE(day_night = 'D', FALSE) AS is_day_game, {typed_sql(game_logs._VENUE)}, {stats}, {', '.join(people)},
      {slots}, misc AS game_notes, acquisition_info
    FROM logs
    """)


@REGISTRY.add("model_game_logs", _game_log_sql())
def _(t: Tables):
    return game_logs.game_logs(t.sql(_log_scan()))


_PITCH_FIXED = {
    "game_pk": "l_orderkey", "game_date": "CAST(l_shipdate AS DATE)", "game_year": "year(l_shipdate)",
    "at_bat_number": "l_linenumber", "pitch_number": "l_partkey % 10",
}


def _pitch_items() -> str:
    items = []
    for i, line in enumerate((pitches._SITUATION + pitches._MEASURES.strip()).strip().splitlines(), start=2):
        source, kind, _ = line.split()
        sql = _PITCH_FIXED.get(source)
        if sql is None and kind == "long":
            sql = f"(l_orderkey * {i} + l_linenumber) % 97"
        elif sql is None and kind == "numeric":
            sql = f"CAST(((l_orderkey * {i} + l_partkey) % 90001) / 1000.0 AS DECIMAL(10,4))"
        elif sql is None:
            sql = f"CASE WHEN (l_orderkey + {i}) % 5 = 0 THEN NULL ELSE l_returnflag END"
        items.append(f"CAST({sql} AS STRING) AS {source}")
    for i, role in enumerate(pitches._ROLES, start=1):
        value = f"CAST(100000 + (l_partkey * {i}) % 1700 AS STRING)"
        items.append(f"CASE WHEN (l_orderkey + {i}) % 6 = 0 THEN NULL ELSE {value} END AS {role}")
    return ", ".join(items)


_PITCH_ITEMS = _pitch_items()


def _pitch_sql() -> str:
    people = ", ".join(f"CAST({s} AS BIGINT) AS {r}_mlbam" for s, r in pitches._ROLES.items())
    joins = " ".join(f"LEFT JOIN crosswalk {r} ON {r}_mlbam = {r}.mlbam_id" for r in pitches._ROLES.values())
    found = ", ".join(f"{r}.person_id AS {r}_person_id" for r in pitches._ROLES.values())
    return with_inputs(f"""
    WITH raw AS (SELECT {_PITCH_ITEMS} FROM lineitem),
    typed AS (SELECT {typed_sql(pitches._SITUATION)}, {typed_sql(pitches._MEASURES)}, {people} FROM raw)
    SELECT {key_sql('game_id', 'game_plate_appearance', 'pitch_number')} AS pitch_id,
      {', '.join(output_names(pitches._SITUATION))}, {found}, {', '.join(output_names(pitches._MEASURES))}
    FROM typed {joins}
    """)


@REGISTRY.add("model_pitches", _pitch_sql())
def _(t: Tables):
    return pitches.pitches(t.sql(f"SELECT {_PITCH_ITEMS} FROM lineitem"), t.crosswalk)


# The same model with every lookup sorted, as for a register too large to broadcast.
@REGISTRY.add("model_pitches_large_register", _pitch_sql())
def _(t: Tables):
    return pitches.pitches(t.sql(f"SELECT {_PITCH_ITEMS} FROM lineitem"), t.crosswalk, strategy="merge")
