"""Raw season tables derived from the driver tables.

The texts run in Spark SQL and in DuckDB alike. Customers stand for people, line items for
season lines; every derived row comes from one driver row, so the work grows with the data.
"""

from __future__ import annotations

DERIVED: dict[str, str] = {}


def _texts(names: str, formula: str, null_every: int = 13) -> str:
    """Count-like text columns: ``{i}`` is the position of the column."""
    items = []
    for i, name in enumerate(names.split(), start=3):
        value = formula.format(i=i)
        value = value if "STRING" in value else f"CAST({value} AS STRING)"
        items.append(
            f"CASE WHEN (l_orderkey + {i}) % {null_every} = 0 THEN NULL ELSE {value} END AS {name}"
        )
    return ", ".join(items)


_PLAYER = "'p' || lpad(CAST(l_partkey AS STRING), 9, '0')"
_SEASON = (
    f"{_PLAYER} AS playerid, CAST(year(l_shipdate) AS STRING) AS yearid, l_returnflag AS lgid, "
    "'T' || CAST(l_suppkey % 30 AS STRING) AS teamid"
)
_SMALL = "(l_orderkey * {i} + l_linenumber) % 40"

DERIVED["people"] = """
SELECT 'p' || lpad(CAST(c_custkey AS STRING), 9, '0') AS playerid,
  CASE WHEN c_custkey % 11 <> 0 THEN 'b' || CAST(c_custkey AS STRING) END AS bbrefid
FROM customer
"""

_SPANS = ", ".join(
    f"CAST(1900 + (c_custkey + {i}) % 120 AS STRING) AS {level}_{role}_{edge}"
    for i, (level, role, edge) in enumerate(
        (level, role, edge)
        for role in ("played", "managed", "umpired")
        for level in ("pro", "mlb", "col")
        for edge in ("first", "last")
        if (level, role) != ("col", "umpired")
    )
)
DERIVED["register_raw"] = f"""
SELECT 'u' || CAST(c_custkey AS STRING) AS key_uuid,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(100000 + c_custkey AS STRING) END AS key_mlbam,
  'r' || CAST(c_custkey AS STRING) AS key_retro,
  CASE WHEN c_custkey % 7 <> 0 THEN 'b' || CAST(c_custkey AS STRING) END AS key_bbref,
  'm' || CAST(c_custkey AS STRING) AS key_bbref_minors,
  CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey AS STRING) END AS key_fangraphs,
  CAST(NULL AS STRING) AS key_npb, CAST(NULL AS STRING) AS key_sr_nfl,
  CAST(NULL AS STRING) AS key_sr_nba, CAST(NULL AS STRING) AS key_sr_nhl,
  replace(c_name, 'Customer', 'Çüstomér') AS name_last,
  CASE c_custkey % 4 WHEN 0 THEN 'José' WHEN 1 THEN 'Łukasz' WHEN 2 THEN 'Søren' ELSE 'Ann' END AS name_first,
  c_mktsegment || ' Ñ' AS name_given,
  CASE WHEN c_custkey % 9 = 0 THEN 'Jr.' END AS name_suffix,
  CAST(NULL AS STRING) AS name_matrilineal,
  CASE WHEN c_custkey % 17 <> 0 THEN CAST(1790 + c_custkey % 260 AS STRING) END AS birth_year,
  CAST(c_custkey % 14 AS STRING) AS birth_month,
  CAST(c_custkey % 33 AS STRING) AS birth_day,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(1850 + c_custkey % 200 AS STRING) END AS death_year,
  CAST(1 + c_custkey % 12 AS STRING) AS death_month,
  CAST(1 + c_custkey % 31 AS STRING) AS death_day,
  {_SPANS}
FROM customer
"""
# The register as the models see it, reduced to its ids.
DERIVED["crosswalk"] = """
SELECT key_uuid AS person_id, CAST(key_mlbam AS BIGINT) AS mlbam_id, key_bbref AS baseball_reference_id,
  key_bbref_minors AS baseball_reference_minor_league_id, CAST(key_fangraphs AS INT) AS fangraphs_id,
  name_first AS first_name, name_last AS last_name
FROM register_raw
"""
DERIVED["lookup"] = """
SELECT person_id, playerid AS lahman_id
FROM people LEFT JOIN crosswalk ON bbrefid = baseball_reference_id
"""

_BATTING = "g ab r h _2b _3b hr rbi sb cs bb so ibb hbp sh sf gidp"
DERIVED["raw_batting"] = f"""
SELECT {_SEASON}, CAST(l_linenumber AS STRING) AS stint, {_texts(_BATTING, _SMALL)}
FROM lineitem WHERE l_linestatus <> 'F' OR l_linenumber > 2
"""
DERIVED["raw_batting_post"] = f"""
SELECT {_texts(_BATTING, _SMALL)}, {_SEASON}, 'WS' AS round
FROM lineitem WHERE l_linestatus = 'F' AND l_linenumber <= 2
"""
_PITCHING = "w l g gs gf cg sho sv ipouts h r er hr bb so ibb wp hbp bk bfp sh sf gidp"
DERIVED["raw_pitching"] = f"""
SELECT {_SEASON}, CAST(l_linenumber AS STRING) AS stint, {_texts(_PITCHING, "(l_orderkey * {i} + l_partkey) % 90")}
FROM lineitem WHERE l_linestatus <> 'F' OR l_linenumber > 2
"""
DERIVED["raw_pitching_post"] = f"""
SELECT {_SEASON}, 'CS' AS round, {_texts(_PITCHING, "(l_orderkey * {i} + l_partkey) % 90")}
FROM lineitem WHERE l_linestatus = 'F' AND l_linenumber <= 2
"""
_POSITION = (
    "CASE (l_orderkey + l_linenumber) % 12 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN '1B' WHEN 3 THEN '2B' "
    "WHEN 4 THEN '3B' WHEN 5 THEN 'SS' WHEN 6 THEN 'LF' WHEN 7 THEN 'CF' WHEN 8 THEN 'RF' WHEN 9 THEN 'OF' "
    "WHEN 10 THEN 'DH' END AS pos"
)
_FIELDING = "g gs innouts po a e dp pb sb cs"
# Seasons on both sides of 1954.
_OLD_SEASON = _SEASON.replace("year(l_shipdate)", "year(l_shipdate) - 44")
DERIVED["raw_fielding"] = f"""
SELECT {_OLD_SEASON}, CAST(l_linenumber AS STRING) AS stint, {_POSITION}, {_texts(_FIELDING + ' wp', _SMALL)},
  CAST(round(l_tax * 10, 1) AS STRING) AS zr
FROM lineitem WHERE l_linenumber <= 4
"""
DERIVED["raw_fielding_split"] = f"""
SELECT {_OLD_SEASON}, CAST(l_linenumber AS STRING) AS stint, {_POSITION}, {_texts(_FIELDING + ' wp', _SMALL)},
  CAST(NULL AS STRING) AS zr
FROM lineitem WHERE l_linenumber = 5
"""
DERIVED["raw_fielding_post"] = f"""
SELECT {_OLD_SEASON}, 'WS' AS round, {_POSITION}, {_texts(_FIELDING + ' tp', _SMALL)}
FROM lineitem WHERE l_linenumber > 5
"""
DERIVED["raw_all_star"] = f"""
SELECT {_SEASON}, 'G' || CAST(l_orderkey AS STRING) AS gameid, CAST(l_linenumber AS STRING) AS gamenum,
  CAST(l_linenumber % 2 AS STRING) AS gp,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE CAST(l_linenumber AS STRING) END AS startingpos
FROM lineitem
"""
_APPEARANCES = "g_all gs g_batting g_defense g_p g_c g_1b g_2b g_3b g_ss g_lf g_cf g_rf g_of g_dh g_ph g_pr"
DERIVED["raw_appearances"] = f"SELECT {_SEASON}, {_texts(_APPEARANCES, _SMALL)} FROM lineitem"

_AWARD = (
    "'p' || lpad(CAST(o_custkey AS STRING), 9, '0') AS playerid, CAST(year(o_orderdate) AS STRING) AS yearid, "
    "o_orderstatus AS lgid, o_orderpriority AS awardid"
)
DERIVED["raw_awards_players"] = f"""
SELECT {_AWARD}, CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS tie,
  lpad(CAST(o_orderkey AS STRING), 9, '0') AS notes
FROM orders WHERE o_orderkey % 5 <> 0
"""
DERIVED["raw_awards_managers"] = f"""
SELECT {_AWARD}, CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS tie,
  lpad(CAST(o_orderkey AS STRING), 9, '0') AS notes
FROM orders WHERE o_orderkey % 5 = 0
"""
_SHARES = (
    "CAST(o_orderkey % 400 AS STRING) AS pointswon, CAST(o_custkey % 30 AS STRING) AS votesfirst, "
    "CAST(400 + o_orderkey % 20 AS STRING) AS pointsmax"
)
DERIVED["raw_shares_players"] = f"SELECT {_AWARD}, {_SHARES} FROM orders WHERE o_orderkey % 5 <> 0"
DERIVED["raw_shares_managers"] = f"SELECT {_AWARD}, {_SHARES} FROM orders WHERE o_orderkey % 5 = 0"
DERIVED["raw_fielding_of"] = f"""
SELECT {_SEASON}, CAST(l_linenumber AS STRING) AS stint, {_texts("glf gcf grf", _SMALL)} FROM lineitem
"""
DERIVED["raw_franchises"] = """
SELECT 'F' || CAST(s_suppkey AS STRING) AS franchid, s_name AS franchname,
  CASE s_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS active,
  CASE WHEN s_suppkey % 4 = 0 THEN 'NA' || CAST(s_nationkey AS STRING) END AS naassoc
FROM supplier
"""
DERIVED["raw_hall_of_fame"] = """
SELECT 'p' || lpad(CAST(o_custkey AS STRING), 9, '0') AS playerid, CAST(year(o_orderdate) AS STRING) AS yearid,
  o_orderpriority AS votedby, CAST(o_orderkey % 500 AS STRING) AS ballots, CAST(o_orderkey % 375 AS STRING) AS needed,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE CAST(o_orderkey % 450 AS STRING) END AS votes,
  CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS inducted,
  o_orderstatus AS category, CAST(NULL AS STRING) AS needed_note
FROM orders
"""
_MANAGER = (
    "'p' || lpad(CAST(o_custkey AS STRING), 9, '0') AS playerid, CAST(year(o_orderdate) AS STRING) AS yearid, "
    "o_orderstatus AS lgid, 'T' || CAST(o_custkey % 30 AS STRING) AS teamid, "
    "CAST(1 + o_orderkey % 3 AS STRING) AS inseason, CAST(o_orderkey % 162 AS STRING) AS g, "
    "CAST(o_orderkey % 100 AS STRING) AS w, CAST(o_orderkey % 62 AS STRING) AS l, "
    "CAST(1 + o_orderkey % 8 AS STRING) AS rank"
)
DERIVED["raw_managers"] = f"""
SELECT {_MANAGER}, CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS plyrmgr FROM orders
"""
DERIVED["raw_managers_half"] = f"SELECT {_MANAGER}, CAST(1 + o_orderkey % 2 AS STRING) AS half FROM orders"
DERIVED["raw_parks"] = """
SELECT 'PK' || CAST(s_suppkey AS STRING) AS parkkey, s_name AS parkname, CAST(NULL AS STRING) AS parkalias,
  n_name AS city, 'ST' AS state, r_name AS country
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
DERIVED["raw_college_playing"] = """
SELECT 'p' || lpad(CAST(o_custkey AS STRING), 9, '0') AS playerid, CAST(year(o_orderdate) AS STRING) AS yearid,
  'S' || CAST(o_orderkey % 50 AS STRING) AS schoolid
FROM orders
"""
DERIVED["raw_series_post"] = """
SELECT CAST(year(o_orderdate) AS STRING) AS yearid, o_orderpriority AS round,
  'T' || CAST(o_custkey % 30 AS STRING) AS teamidwinner, o_orderstatus AS lgidwinner,
  'T' || CAST(o_custkey % 29 AS STRING) AS teamidloser, 'N' AS lgidloser,
  '4' AS wins, CAST(o_orderkey % 4 AS STRING) AS losses, CAST(o_orderkey % 2 AS STRING) AS ties
FROM orders
"""
DERIVED["raw_salaries"] = f"""
SELECT {_SEASON}, CAST(CAST(floor(l_extendedprice) AS BIGINT) * 100 AS STRING) AS salary FROM lineitem
"""
DERIVED["raw_schools"] = """
SELECT 'S' || CAST(c_custkey AS STRING) AS schoolid, c_name AS name_full, n_name AS city,
  c_mktsegment AS state, 'USA' AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
DERIVED["raw_home_games"] = """
SELECT CAST(year(o_orderdate) AS STRING) AS yearkey, o_orderstatus AS leaguekey,
  'T' || CAST(o_custkey % 30 AS STRING) AS teamkey, 'PK' || CAST(o_custkey % 40 AS STRING) AS parkkey,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS spanfirst,
  CASE WHEN o_orderkey % 9 = 0 THEN '2020-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS spanlast,
  CAST(o_orderkey % 81 AS STRING) AS games, CAST(o_orderkey % 80 AS STRING) AS openings,
  CAST(o_custkey * 13 AS STRING) AS attendance
FROM orders
"""
_TEAM = (
    "CAST(year(o_orderdate) AS STRING) AS yearid, o_orderstatus AS lgid, "
    "'T' || CAST(o_custkey % 30 AS STRING) AS teamid, "
    "CASE o_orderkey % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'W' END AS divid, "
    "CAST(1 + o_orderkey % 6 AS STRING) AS rank, CASE o_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS divwin"
)
DERIVED["raw_teams_half"] = f"""
SELECT {_TEAM}, CAST(1 + o_orderkey % 2 AS STRING) AS half, CAST(o_orderkey % 81 AS STRING) AS g,
  CAST(o_orderkey % 50 AS STRING) AS w, CAST(o_orderkey % 31 AS STRING) AS l
FROM orders
"""
_TEAM_COUNTS = ", ".join(
    f"CAST((o_orderkey * {i} + o_custkey) % 900 AS STRING) AS {name}"
    for i, name in enumerate(
        """g ghome w l r ab h _2b _3b hr bb so sb cs hbp sf ra er cg sho sv ipouts ha hra bba soa e dp
        attendance bpf ppf""".split(),
        start=3,
    )
)
DERIVED["raw_teams"] = f"""
SELECT {_TEAM}, {_TEAM_COUNTS}, 'F' || CAST(o_custkey % 30 AS STRING) AS franchid,
  'Y' AS wcwin, CASE o_custkey % 2 WHEN 0 THEN 'N' END AS lgwin, 'x' AS wswin,
  CAST(CAST(o_totalprice / 100000 AS DECIMAL(6,2)) AS STRING) AS era, '0.981' AS fp,
  'Team ' || CAST(o_custkey % 30 AS STRING) AS name, 'Park' AS park,
  'B' || CAST(o_custkey % 30 AS STRING) AS teamidbr, 'R' || CAST(o_custkey % 30 AS STRING) AS teamidretro
FROM orders
"""

_WAR_IDENTITY = (
    "'b' || CAST(l_partkey AS STRING) AS player_id, l_linenumber AS stint_id, "
    "'T' || CAST(l_suppkey % 30 AS STRING) AS team_id, l_returnflag AS lg_id, "
    "CAST(year(l_shipdate) AS INT) AS year_id, CAST(100000 + l_partkey AS STRING) AS mlb_id"
)


def _war(names: str) -> str:
    """Numbers with two decimals as text, from whole numbers."""
    hundredths = "((l_orderkey * {i} + l_partkey) % 3001)"
    return _texts(
        names,
        f"CAST(floor({hundredths} / 100) AS BIGINT) || '.' || lpad(CAST({hundredths} % 100 AS STRING), 2, '0')",
        17,
    )


_BATTING_WAR = """
inn runs_bat runs_br runs_dp runs_field runs_infield runs_outfield runs_catcher runs_good_plays
runs_defense runs_position runs_position_p runs_replacement runs_above_rep runs_above_avg
runs_above_avg_off runs_above_avg_def waa waa_off waa_def war war_off war_def war_rep
{names} pyth_exponent pyth_exponent_rep waa_win_perc waa_win_perc_off waa_win_perc_def
waa_win_perc_rep ops_plus tob_lg tb_lg
"""
_PITCHING_WAR = """
{expected} bip_perc rs_def_total runs_above_avg runs_above_avg_adj runs_above_rep {replacement}
gr_leverage_index_avg war war_rep {names} pyth_exponent waa waa_adj waa_win_perc era_plus er_lg
"""
_FLAG = "CASE l_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS pitcher"
DERIVED["raw_batting_war"] = f"""
SELECT {_WAR_IDENTITY}, {_FLAG}, {_texts("age pa g salary", _SMALL)},
  {_war(_BATTING_WAR.format(names="teamrpg opprpg opprppa_rep opprpg_rep"))}
FROM lineitem
"""
DERIVED["raw_batting_war_loaded"] = f"""
SELECT {_WAR_IDENTITY}, {_FLAG}, {_texts("age pa g salary", _SMALL)},
  {_war(_BATTING_WAR.format(names="team_rp_g opp_rp_g opp_rp_pa_rep opp_rp_g_rep"))}
FROM lineitem
"""
DERIVED["raw_pitching_war"] = f"""
SELECT {_WAR_IDENTITY},
  {_texts("age g gs ipouts ipouts_start ipouts_relief ra ppf ppf_custom bip salary", _SMALL)},
  {_war(_PITCHING_WAR.format(expected="xra xra_sprp_adj xra_extras_adj xra_def_pitcher xra_final",
                             replacement="rpo_replacement", names="teamrpg opprpg opprpg_rep"))}
FROM lineitem
"""
DERIVED["raw_pitching_war_loaded"] = f"""
SELECT {_WAR_IDENTITY},
  {_texts("age g gs i_pouts i_pouts_start i_pouts_relief ra ppf ppf_custom bip salary", _SMALL)},
  {_war(_PITCHING_WAR.format(expected="x_ra x_ra_sprp_adj x_ra_extras_adj x_ra_def_pitcher x_ra_final",
                             replacement="rp_o_replacement", names="team_rp_g opp_rp_g opp_rp_g_rep"))}
FROM lineitem
"""
DERIVED["raw_draft"] = """
SELECT year(o_orderdate) AS year, CASE o_orderkey % 3 WHEN 0 THEN '2aug' END AS dt,
  CAST(1 + o_orderkey % 50 AS STRING) AS rnd, CAST(1 + o_orderkey % 30 AS STRING) AS rdpck,
  CAST(o_orderkey AS STRING) AS ovpck, 'T' || CAST(o_custkey % 30 AS STRING) AS team_id,
  'Team ' || CAST(o_custkey % 30 AS STRING) AS tm,
  CASE o_orderkey % 4 WHEN 0 THEN 'baseball_reference_id' WHEN 1 THEN 'baseball_reference_minor_league_id'
    ELSE 'NA' END AS id_type,
  CASE o_orderkey % 4 WHEN 0 THEN 'b' || CAST(o_custkey AS STRING) WHEN 1 THEN 'm' || CAST(o_custkey AS STRING)
    ELSE 'NA' END AS player_id,
  CASE o_orderkey % 2 WHEN 0 THEN 'Player*' ELSE 'Player' || chr(160) || '(minors)' END AS name,
  CASE o_orderkey % 5 WHEN 0 THEN '' ELSE '$' || CAST(o_custkey AS STRING) || ',000' END AS bonus,
  'SS' AS pos, 'School ' || CAST(o_custkey % 10 AS STRING) AS draftedoutof, 'HS' AS type,
  CASE o_orderkey % 3 WHEN 0 THEN 'NA' WHEN 1 THEN 'DNS' END AS notes
FROM orders
"""
DERIVED["raw_fg_batting"] = """
SELECT CAST(o_custkey AS INT) AS playerid, CAST(100000 + o_custkey AS BIGINT) AS mlbamid,
  CAST(year(o_orderdate) AS INT) AS season, CAST(floor(o_totalprice) AS BIGINT) % 997 AS war, o_orderstatus AS team
FROM orders WHERE o_orderkey % 2 = 0
"""
DERIVED["raw_fg_pitching"] = """
SELECT CAST(o_custkey AS INT) AS playerid, CAST(100000 + o_custkey AS BIGINT) AS mlbamid,
  CAST(year(o_orderdate) AS INT) AS season, CAST(floor(o_totalprice) AS BIGINT) % 499 AS war, o_orderstatus AS team
FROM orders WHERE o_orderkey % 2 = 1
"""
DERIVED["raw_fg_fielding"] = """
SELECT CAST(o_custkey AS INT) AS playerid, CAST(year(o_orderdate) AS INT) AS season, o_orderstatus AS team
FROM orders
"""
DERIVED["raw_fg_json"] = """
SELECT '{"playerid": ' || CAST(o_custkey AS STRING) || ', "Season": ' || CAST(year(o_orderdate) AS STRING)
  || ', "1B": ' || CAST(o_orderkey % 200 AS STRING) || ', "BB%": 0.' || CAST(10 + o_orderkey % 80 AS STRING)
  || ', "Name": "' || o_orderpriority || '", "teamid": ' || CAST(o_custkey % 30 AS STRING)
  || CASE WHEN o_orderkey % 3 = 0 THEN ', "wRC+": ' || CAST(o_orderkey % 150 AS STRING) ELSE '' END
  || '}' AS record_content, CAST(CAST(o_orderdate AS DATE) AS STRING) AS extracted_at
FROM orders
"""
DERIVED["raw_team_ids"] = """
SELECT DISTINCT CAST(year(o_orderdate) AS STRING) AS "yearID", 'AL' AS "lgID",
  'T' || CAST(o_custkey % 30 AS STRING) AS "teamID", 'F' || CAST(o_custkey % 30 AS STRING) AS "franchID",
  CAST(o_custkey % 30 AS STRING) AS "teamIDfg", 'B' || CAST(o_custkey % 30 AS STRING) AS "teamIDBR",
  'R' || CAST(o_custkey % 30 AS STRING) AS "teamIDretro"
FROM orders
""".replace('"', "")
