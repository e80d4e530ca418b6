import datetime as dt

import pytest
from pyspark.sql import functions as F

from statlake import functions as S
from statlake.functions.naming import leaderboard_name, rename_by, short_name


def values(spark, column, kind, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [row.y for row in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, name",
    [
        ("1B", "_1b"), ("-WPA", "neg_wpa"), ("-RBI", "neg_rbi"), ("WAROld", "war_old"),
        ("C+SwStr%", "c_plus_sw_str_pct"), ("xMLBAMID", "mlbamid"), ("BB%", "bb_pct"), ("wRC+", "w_rc_plus"),
        ("K/9", "k_per_9"), ("IFFB-", "iffb_minus"), ("IFH%", "ifh_pct"), ("PlayerName", "player_name"),
        ("AVG", "avg"), ("pfxFA-X", "pfx_fa_x"), ("scFA-X", "sc_fa_x"), ("piFA-X", "pi_fa_x"),
        ("GB/FB", "gb_per_fb"), ("CHv", "ch_v"), ("O-Swing%", "o_swing_pct"), ("scH-Swing%", "sc_h_swing_pct"),
    ],
)
def test_leaderboard_names(raw, name):
    assert leaderboard_name(raw) == name


@pytest.mark.parametrize(
    "raw, name",
    [("+WPA", "pos_wpa"), ("-WPA", "neg_wpa"), ("wFA/C", "wfa_per_c"), ("1B", "_1b"), ("ERA-", "era_minus"),
     ("pfxFA-X", "pfxfa_x"), ("BB%+", "bb_pct_plus")],
)
def test_short_names(raw, name):
    assert short_name(raw) == name


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        rename_by(spark.createDataFrame([(1, 2)], ["BB%", "bb_pct"]), leaderboard_name)


def test_text_to_int_rounds_and_tolerates(spark):
    got = values(spark, S.parse_int, "string", "4.5", "-4.5", "7", "", "x", None, "4.49", "99999999999")
    assert got == [5, -5, 7, None, None, None, 4, None]
    assert values(spark, S.parse_int, "double", 4.5, 4.4) == [5, 4]


def test_counts_read_null_as_zero(spark):
    assert values(spark, S.parse_count, "string", None, "", "3") == [0, 0, 3]


def test_money(spark):
    assert values(spark, S.parse_money, "string", "$1,234", "", None) == [1234, None, None]


def test_decimal_is_parsed_without_a_double_step(spark):
    got = values(spark, lambda c: S.parse_decimal(c, 6, 2), "string", "1.005", "bad", "12345.6")
    assert [None if v is None else str(v) for v in got] == ["1.01", None, None]


def test_flags(spark):
    assert values(spark, S.yes_no, "string", "Y", "N", "", None) == [True, False, None, None]
    assert values(spark, lambda c: S.flag_or_false(c, "D"), "string", "D", "N", None) == [True, False, False]


def test_innings(spark):
    assert values(spark, S.outs_to_innings, "int", 16, 3, 0, None) == ["5.1", "1.0", "0.0", None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 3), (1, None), (201, 200), (-1, 8)], "a int, b int")
    got = [r.q for r in df.select(S.safe_divide(F.col("a"), F.col("b"), 2).alias("q")).collect()]
    assert got == [0.33, 0.0, None, None, 1.0, -0.13]


def test_whole_expressions_are_divided(spark):
    """On-base percentage and WHIP use the whole numerator and denominator."""
    line = dict(hits=3, walks=2, hit_by_pitches=1, at_bats=10, sacrifice_flies=1)
    df = spark.createDataFrame([line])
    assert df.select(S.on_base_percentage().alias("v")).first().v == round(6 / 14, 3)
    names = ["hits", "walks", "hit_by_pitches", "sacrifice_hits", "sacrifice_flies", "batters_faced",
             "strikeouts", "home_runs", "runs", "earned_runs", "outs_pitched"]
    pitched = spark.createDataFrame([dict.fromkeys(names, 1) | dict(hits=5, walks=2, outs_pitched=18)])
    assert pitched.select(S.pitching_rates()["whip"].alias("v")).first().v == round(7 * 3 / 18, 3)


def test_accents(spark):
    assert values(spark, S.strip_accents, "string", "José Peña", "Łódź", "Ø ß", "é", None) == [
        "Jose Pena", "Łodz", "Ø ß", "e", None]


def test_guarded_date(spark):
    parts = [("2020", "2", "29"), ("2020", "2", "30"), ("2020", "13", "1"), ("1799", "1", "1"),
             ("2027", "1", "1"), (None, "1", "1"), ("1999", "0", "5"), ("1999", "1", "32")]
    df = spark.createDataFrame(parts, "y string, m string, d string")
    today = F.lit(dt.date(2026, 6, 1))
    got = [r.v for r in df.select(S.guarded_date(F.col("y"), F.col("m"), F.col("d"), today).alias("v")).collect()]
    assert got == [dt.date(2020, 2, 29)] + [None] * 7


def test_link_cells(spark):
    cells = [
        ("John Doe", "/players/d/doejo01.shtml"),
        ("Jane Doe", "/register/player.fcgi?id=doe123"),
        ("John (DNS)", None),
        ("Plain", None),
    ]
    df = spark.createDataFrame(cells, "text string, link string")
    got = [
        tuple(r)
        for r in df.select(
            S.link_id_type(F.col("link")), S.link_player_id(F.col("link")), S.link_note(F.col("text"), F.col("link"))
        ).collect()
    ]
    assert got == [
        ("baseball_reference_id", "doejo01", "NA"),
        ("baseball_reference_minor_league_id", "doe123", "NA"),
        ("NA", "NA", "DNS"),
        ("NA", "NA", "NA"),
    ]
    team = "/draft/?team_ID=NYY&year_ID=2020&draft_type=junreg"
    assert values(spark, S.link_team_id, "string", team, None, "") == ["NYY", "NA", "NA"]


def test_keys(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "a")], "x int, y string, z string")
    row = df.select(S.surrogate_key("x", "y", F.lit(False)).alias("k"), S.joined_md5("x", "y", "z").alias("j")).first()
    assert row.k == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_-false").hexdigest()
    assert row.j == hashlib.md5(b"1a").hexdigest()


def test_display(spark):
    assert values(spark, lambda c: S.display_value(c, "count"), "bigint", 1234567, None) == ["1,234,567", "-"]
