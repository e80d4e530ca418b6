"""Model rules that the registered queries do not show: hand-made rows, traps, plans."""

import datetime as dt

from pyspark.sql import functions as F

from statlake.plans import comparison, lahman, leaderboards, register, team_ids, war


def frame(spark, columns, *rows):
    """Text columns by default; ``name:type`` for others."""
    names = [c.split(":") for c in columns.split()]
    schema = ", ".join(f"{n[0]} {n[1] if len(n) > 1 else 'string'}" for n in names)
    return spark.createDataFrame(list(rows), schema)


def people(spark):
    return frame(spark, "person_id first_name last_name fangraphs_id:int baseball_reference_id",
                 ("p1", "Ann", "One", 1, "b1"), ("p2", "Bob", "Two", 2, "b2"), ("p3", "Cid", "Three", None, None))


def test_comparison_rows(spark):
    value = "person_id year_id:int wins_above_replacement:decimal(6,2)"
    from decimal import Decimal as D

    batting = frame(spark, value, ("p1", 2020, D("1.50")), ("p1", 2020, D("0.25")), ("p2", 2020, None), (None, 2020, D("9.00")))
    pitching = frame(spark, value, ("p1", 2020, D("0.25")), ("p3", 2021, D("3.00")), (None, 2020, D("1.00")))
    board = "fangraphs_id:int year_id:int war:double"
    other_b = frame(spark, board, (1, 2020, 4.0), (2, 2021, 1.0), (99, 2020, 7.0), (None, 2020, 7.0))
    other_p = frame(spark, board, (2, 2021, 0.5))
    df = comparison.war_comparison(batting, pitching, other_b, other_p, people(spark))
    got = {(r.person_id, r.year_id, None if r.bbref_war is None else float(r.bbref_war)):
           (r.last_name, r.fangraphs_war, r.average_war, r.war_difference) for r in df.collect()}
    assert got == {
        ("p1", 2020, 2.0): ("One", 4.0, 3.0, 2.0),
        ("p2", 2020, 0.0): ("Two", None, None, None),
        ("p2", 2021, None): ("Two", 1.5, None, None),
        ("p3", 2021, 3.0): ("Three", None, None, None),
        # Rows without a person match nothing, not even each other.
        (None, 2020, 9.0): (None, None, None, None),
        (None, 2020, 1.0): (None, None, None, None),
    }


def test_comparison_joins_nothing_to_match_the_halves(spark):
    value = "person_id year_id:int wins_above_replacement:double"
    empty, board = frame(spark, value, ("p", 1, 1.0)), frame(spark, "fangraphs_id:int year_id:int war:double", (1, 1, 1.0))
    df = comparison.war_comparison(empty, empty, board, board, people(spark))
    assert "FullOuter" not in df._jdf.queryExecution().toString()


def test_repeated_crosswalk_ids_multiply_rows(spark):
    raw = frame(spark, "playerid yearid schoolid", ("x", "1999", "S"))
    lookup = frame(spark, "person_id lahman_id", ("p1", "x"), ("p2", "x"))
    assert {r.person_id for r in lahman.player_college_seasons(raw, lookup).collect()} == {"p1", "p2"}


def test_awards_number_joint_winners(spark):
    columns = "playerid yearid lgid awardid tie notes"
    players = frame(spark, columns, ("b", "1979", "NL", "MVP", "Y", None), ("a", "1979", "NL", "MVP", "Y", None),
                    ("zz", "1979", "NL", "MVP", "", None))
    managers = frame(spark, columns, ("c", "1979", "NL", "MOY", "N", None))
    lookup = frame(spark, "person_id lahman_id", ("pa", "a"), ("pb", "b"), ("pc", "c"))
    got = lahman.awards(players, managers, lookup).collect()
    assert len({r.award_tie_id for r in got}) == 4 and len({r.award_id for r in got}) == 2
    assert {(r.person_id, r.type, r.is_tie) for r in got} == {
        ("pa", "player", True), ("pb", "player", True), (None, "player", None), ("pc", "manager", False)}
    import hashlib

    place = {r.award_tie_id: r.person_id for r in got}
    for person, n in (("pa", 1), ("pb", 2), (None, 3)):
        assert place[hashlib.md5(f"1979-NL-MVP-{n}".encode()).hexdigest()] == person


def test_fielding_takes_split_outfielders_from_1954(spark):
    columns = "playerid yearid stint teamid lgid pos g gs innouts po a e dp pb wp sb cs zr"
    fill = ["1"] * 11 + ["0.5"]
    regular = frame(spark, columns, ("a", "1953", "1", "T", "L", "OF", *fill), ("a", "1954", "1", "T", "L", "OF", *fill),
                    ("a", "1954", "1", "T", "L", "P", *fill), ("a", "1954", "1", "T", "L", None, *fill))
    split = frame(spark, columns, ("a", "1954", "1", "T", "L", "LF", *fill))
    post = frame(spark, "playerid yearid round teamid lgid pos g tp",
                 ("a", "1960", "WS", "T", "L", "SS", "7", "1"))
    for name in "gs innouts po a e dp pb sb cs".split():
        post = post.withColumn(name, F.lit("2"))
    lookup = frame(spark, "person_id lahman_id", ("pa", "a"))
    got = {(r.year_id, r.position, r.position_number, r.stint, r.triple_plays, r.is_postseason)
           for r in lahman.fielding(regular, split, post, lookup).collect()}
    assert got == {(1953, "OF", None, "1", None, False), (1954, "P", 1, "1", None, False),
                   (1954, "LF", 7, "1", None, False), (1960, "SS", 6, "WS", 1, True)}


def test_pitching_person_is_the_lookups(spark):
    names = "w l g gs gf cg sho sv ipouts h r er hr bb so ibb wp hbp bk bfp sh sf gidp".split()
    regular = frame(spark, "playerid yearid stint teamid lgid " + " ".join(names), ("a", "1999", "1", "T", "L", *["0"] * 23))
    post = frame(spark, "playerid yearid round teamid lgid " + " ".join(names), ("zz", "1999", "CS", "T", "L", *["3"] * 23))
    lookup = frame(spark, "person_id lahman_id", ("pa", "a"))
    got = {r.lahman_id: r for r in lahman.pitching(regular, post, lookup).collect()}
    assert (got["a"].person_id, got["zz"].person_id, got["zz"].stint) == ("pa", None, "CS")
    assert got["a"].earned_runs_allowed_average == 0.0 and got["a"].innings_pitched == "0.0"
    assert got["zz"].whip == 6.0


def test_rate_columns_of_teams_keep_their_fraction(spark):
    from statlake.sources.layouts import TEAMS_COLUMNS

    raw = frame(spark, " ".join(c.lower() for c in TEAMS_COLUMNS), tuple("3.85" for _ in TEAMS_COLUMNS))
    row = lahman.teams(raw).first()
    assert (str(row.earned_run_average), row.games) == ("3.850", 4)


def test_register(spark):
    spans = [f"{level}_{role}_{edge}" for level in ("pro", "mlb", "col") for role in ("played", "managed", "umpired")
             for edge in ("first", "last") if (level, role) != ("col", "umpired")]
    ids = "uuid mlbam retro bbref bbref_minors fangraphs npb sr_nfl sr_nba sr_nhl".split()
    columns = [f"key_{i}" for i in ids] + "name_last name_first name_given name_suffix name_matrilineal".split()
    columns += [f"{e}_{p}" for e in ("birth", "death") for p in ("year", "month", "day")] + spans
    values = dict.fromkeys(columns, "1999") | {"name_last": "Peña", "birth_month": "2", "birth_day": "30",
                                               "death_month": "12", "death_day": "31"}
    row = register.register(frame(spark, " ".join(columns), tuple(values.values())), F.lit(dt.date(2026, 1, 1))).first()
    assert (row.last_name, row.last_name_accented, row.birth_date, row.birth_day) == ("Pena", "Peña", None, 30)
    assert row.death_date == dt.date(1999, 12, 31) and row.first_college_game_managed == 1999
    assert len(row) == 42


def test_draft_results(spark):
    columns = "year:int dt rnd rdpck ovpck team_id tm id_type player_id name bonus pos draftedoutof type notes"
    raw = frame(spark, columns,
                (2020, None, "1", "1", "1", "T", "Team", "baseball_reference_id", "b1", "Ann One*", "$1,234", "P", "S", "HS", "NA"),
                (2020, "2a", "1", "2", "2", "T", "Team", "baseball_reference_minor_league_id", "m1", "Bob (minors)", "", "P", "S", "HS", "nan"),
                (2020, "2a", "1", "3", "3", "T", "Team", "NA", "NA", "Cid", None, "P", "S", "HS", "DNS"))
    crosswalk = frame(spark, "person_id baseball_reference_id baseball_reference_minor_league_id", ("p1", "b1", "m0"), ("p2", "b0", "m1"))
    got = {r.overall_pick: (r.draft_type, r.person_id, r.name, r.bonus, r.notes) for r in war.draft_results(raw, crosswalk).collect()}
    assert got == {"1": ("6rg", "p1", "Ann One", 1234, None), "2": ("2a", "p2", "Bob", None, None),
                   "3": ("2a", None, "Cid", None, "DNS")}


def test_team_id_match(spark, rows):
    teams = frame(spark, "yearID lgID teamID franchID teamIDBR teamIDretro place:int",
                  ("1900", "NL", "BOS", "ATL", "BSN", "BSN", 1), ("1900", "NL", "BRO", "LAD", "BRO", "BRO", 2),
                  ("1901", "AL", "BOSX", "BOS", "BOS", "BOS", 3))
    missing = frame(spark, "team_id team_name year_id",
                    ("1", "BOS", "1900"), ("2", "bos1", "1900"), ("3", "ZZZ", "1900"), ("4", "BRO", "1901"), ("5", "BO", "1900"))
    matched = team_ids.match_team_ids(missing, teams, "place")
    got = {r.teamIDfg: r.teamID for r in matched.collect()}
    # BO is as close to BOS as any; equal scores would go to the first team of the list.
    assert got == {"1": "BOS", "2": "BOS", "3": "", "4": "", "5": "BOS"}
    assert tuple(team_ids.match_summary(matched).first()) == (5, 3, 2)
    assert rows(team_ids.first_unmatched(matched, 1)) == [("1900", "3")]


def test_dictionary(spark):
    rows_ = [{"group": "a", "raw_name": "BB+", "column_name": "walk_percentage_plus", "type": "int64"},
             {"group": "a", "raw_name": "G", "column_name": "games", "type": "int64"},
             {"group": "b", "raw_name": "G", "column_name": "other", "type": "int64"}]
    d = leaderboards.Dictionary.from_rows(rows_)
    assert (d.long_name("G"), d.long_name("BB%+"), d.group("BB%+")) == ("games", "walk_percentage_plus", "a")
    assert d.long_name("pfxvFA") == "four_seam_fastball_average_velocity_sc"
    assert d.long_name("piXX-Z") == "unidentified_pitch_vertical_movement_pi"
    assert d.long_name("pfxFC-Z") == "cutter_average_vertical_movement_sc"
    assert (d.long_name("New%"), d.group("New%")) == ("new_pct", "unmapped")
    assert d.group_counts(["G", "New%", "piFA%", "pivFA"]) == {"a": 1, "unmapped": 1, "pitch_info": 2}
    assert leaderboards.record_schema({"G": 1, "AVG": 0.3, "Name": "x", "ok": True}) == {
        "G": "int", "AVG": "double", "Name": "string", "ok": "boolean"}


def test_legs(spark):
    legs = {r.leg: (r.label, r.is_postseason) for r in leaderboards.leg_dimension(spark).collect()}
    assert legs["REG"] == ("regular season", False) and legs["WC"] == ("Wild Card Series", True) and len(legs) == 6
    row = leaderboards.with_leg(frame(spark, "Name", ("x",)), "REG").first()
    assert (row.leg, row.is_postseason) == ("REG", False)
