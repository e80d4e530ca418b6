import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from statlake.operators.failures import parse_json_rows, with_errors
from statlake.plans import loads
from statlake.sources import tables
from statlake.sources.sinks import materialise, read_tagged, tagged, write_sorted_csv, write_tagged
from statlake.sources.tables import LoadedTable
from statlake.streaming import cursors, status
from statlake.streaming.incremental import follow_newest, landed_files, merge_stream, read_newest

NOW = dt.datetime(2024, 5, 1, 12, 0, 0)


def test_raw_table_inventory():
    assert len(loads.RAW_TABLES) == 67
    assert len({t.loader for t in loads.RAW_TABLES}) == 16
    assert loads.raw_table("statcast_pitching_leaderboards", "pitch_arsenals").key == ("pitcher", "year", "arsenal_type")
    assert "OF" in loads.positions_for("fielding_run_value") and "OF" not in loads.positions_for("outs_above_average")


@pytest.fixture
def schema(spark, tmp_path):
    """A schema of this test alone."""
    name = f"t{uuid.uuid4().hex[:12]}"
    tables.open_schema(spark, name, str(tmp_path / "schema"))
    yield name
    tables.drop_schema(spark, name)


@pytest.fixture
def prefix(spark):
    """A prefix of the schemas of loaders, dropped after the test."""
    mark = f"p{uuid.uuid4().hex[:12]}_"
    yield mark
    for row in spark.sql(f"SHOW SCHEMAS LIKE '{mark}*'").collect():
        tables.drop_schema(spark, row["namespace"])


def test_replace_keeps_only_the_new_rows(spark, schema, rows):
    table = LoadedTable(spark, schema, "t", ["k"])
    assert table.read() is None
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    assert table.replace(spark.createDataFrame([(3, "c")], "k int, v string"))["rows"] == 1
    assert rows(table.read()) == [(3, "c")]
    # A table may become a form of itself.
    table.replace(table.read().withColumn("v", F.upper("v")))
    assert rows(table.read()) == [(3, "C")]
    table.drop()
    assert table.read() is None and tables.control(spark, schema, tables.STATUS).count() == 0


def _files(df):
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


@pytest.mark.parametrize("partition_by", ["season", None])
def test_merge_by_key_and_repeated_batch(spark, schema, rows, partition_by):
    table = LoadedTable(spark, schema, "t", ["season", "k"], partition_by)
    table.merge(spark.createDataFrame([(2023, 1, "a"), (2024, 1, "b")], "season int, k int, v string"))
    batch = spark.createDataFrame([(2024, 1, "c"), (2024, 2, "d"), (2024, 2, "d")], "season int, k int, v string")
    old = _files(table.read().where("season = 2023"))
    for _ in range(2):
        assert table.merge(batch)["rows"] == 2
        assert rows(table.read()) == [(2023, 1, "a"), (2024, 1, "c"), (2024, 2, "d")]
    # Files of a partition that no batch had are those of the first load.
    assert partition_by is None or _files(table.read().where("season = 2023")) == old
    table.replace(spark.createDataFrame([(2025, 9, "z")], "season int, k int, v string"))
    assert rows(table.read()) == [(2025, 9, "z")]


def test_merge_reads_only_the_partitions_of_its_batch(spark, schema, rows):
    table = LoadedTable(spark, schema, "t", ["day", "k"], "substr(day, 1, 4)")
    table.merge(spark.createDataFrame([("1999-05-01", 1, "a"), ("2001-05-01", 1, "b")], "day string, k int, v string"))
    # A file of the other partition that cannot be read: the merge does not open it.
    for name in _files(table.read().where("day < '2000'")):
        path = name.removeprefix("file://")
        held = open(path, "rb").read()
        open(path, "wb").write(b"broken")
    table.merge(spark.createDataFrame([("2001-05-01", 1, "c", 5)], "day string, k int, v string, more int"))
    open(path, "wb").write(held)
    assert rows(table.read()) == sorted([("1999-05-01", 1, "a", None), ("2001-05-01", 1, "c", 5)], key=str)


def test_failed_write_leaves_the_table(spark, schema, rows):
    table = LoadedTable(spark, schema, "t", ["k"], "k")
    table.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    batch = spark.range(3).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise("x").alias("v"))
    with pytest.raises(Exception, match="lost"):
        table.merge(batch)
    assert rows(table.read()) == [(1, "a")]


def test_load_writes_table_status_and_ledger(spark, prefix, rows):
    table = loads.raw_table("mlb_statsapi_schedules", "schedules")
    for load, score, season in (("1", 3, "2023"), ("2", 10, "2024"), ("2", 10, "2024")):
        batch = spark.createDataFrame([(1, score, season)], "game_pk bigint, home_score int, season string")
        loads.load_table_batch(spark, table, batch, load, NOW, None, prefix)
    name = f"{prefix}mlb_statsapi_schedules"
    stored = loads.open_table(spark, table, prefix).read()
    assert rows(stored) == [(1, 10, "2024", "2")]
    ledger = tables.control(spark, name, tables.LEDGER)
    assert rows(ledger.select("load_id", "table_name", "rows", "watermark")) == [("1", "schedules", 1, "2023"), *[("2", "schedules", 1, "2024")] * 2]
    assert tuple(status.table_status(stored, ledger).first()) == (1, NOW, 1)
    found = status.status_of_schema(spark, name, ["schedules", "schedules_officials"])
    assert rows(found) == [("schedules", "2024", 1, NOW, 1), ("schedules_officials", None, 0, None, 0)]
    assert status.last_loads(ledger.withColumn("loader", F.lit("x"))).first()["load_count"] == 2


def test_status_scans_control_tables_alone(spark, prefix):
    table = loads.raw_table("mlb_statsapi_schedules", "schedules")
    loads.load_table_batch(spark, table, spark.createDataFrame([(1, "2023")], "game_pk bigint, season string"), "1", NOW, None, prefix)
    declared = {"mlb_statsapi_schedules": {"schedules": "season"}, "lahman": {"people": None}}
    found = status.status_of_loaders(spark, declared, prefix)
    assert {r.loader: (r.table_count, r.load_count, r.laggard) for r in found.collect()} == {
        "mlb_statsapi_schedules": (1, 1, "2023"), "lahman": (0, 0, None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    scanned = set(re.findall(r"Scan parquet \S*\.(\w+)", plan))
    assert scanned and scanned <= {"_status", "_loads"}


def test_full_refresh_drops_tables_and_cursors(spark, prefix, rows):
    name = f"{prefix}fangraphs"
    tables.open_schema(spark, name)
    tables.advance_cursor(spark, name, "batting", "2023")
    tables.advance_cursor(spark, name, "batting", "2024")
    tables.advance_cursor(spark, name, "pitching", "2022")
    assert rows(tables.read_cursors(spark, name)) == [("batting", "2024"), ("pitching", "2022")]
    batch = spark.createDataFrame([("1", "2024", "NYA", "r")], "playerid string, season string, team string, leg string")
    loads.load_table_batch(spark, loads.raw_table("fangraphs", "batting"), batch, "1", NOW, None, prefix)
    names = tables.catalog_names(spark, name)
    assert rows(names) == [("_cursors",), ("_loads",), ("_status",), ("batting",)]
    assert rows(status.data_tables(names)) == [("batting",)]
    loads.full_refresh(spark, "fangraphs", prefix)
    loads.full_refresh(spark, "fangraphs", prefix)
    assert tables.catalog_names(spark, name).count() == 0 and tables.read_cursors(spark, name).count() == 0


def test_load_goes_on_past_failed_slices(spark, prefix, rows):
    table = loads.raw_table("baseball_reference_draft", "draft_results")
    kind = "Year string, draft_type string, Rnd string, RdPck string"
    good = '{"Year": "%s", "draft_type": "%s", "Rnd": "%s", "RdPck": "%s"}'

    def load(pages, number):
        df = spark.createDataFrame(pages, "y int, t string, r int, text string")
        parsed = parse_json_rows(df, "text", kind)
        checked = with_errors(parsed, {"another year": F.col("Year") != F.col("y").cast("string")})
        loads.load_slices(spark, table, checked, ["y", "t", "r"], number, NOW, None, prefix)

    def state():
        failed = tables.control(spark, f"{prefix}baseball_reference_draft", tables.FAILURES)
        return rows(loads.open_table(spark, table, prefix).read().select("Year", "Rnd", "RdPck")), rows(failed.select("slice", "error", "bad_rows"))

    load([(2020, "j", 1, good % (2020, "j", 1, 1)), (2020, "j", 1, good % (2020, "j", 1, 2)), (2020, "j", 2, good % (2020, "j", 2, 3)),
          (2020, "j", 2, '{"Year": "20'), (2020, "j", 3, None), (2020, "j", 4, good % (1999, "j", 4, 9)), (2021, None, 1, "[")], "1")
    held, failed = state()
    assert held == [("2020", "1", "1"), ("2020", "1", "2")]
    assert [(s, e) for s, e, _ in failed] == [
        ('{"y":2020,"t":"j","r":2}', "bad json"), ('{"y":2020,"t":"j","r":3}', "no payload"),
        ('{"y":2020,"t":"j","r":4}', "another year"), ('{"y":2021,"t":null,"r":1}', "bad json")]
    load([(2020, "j", 2, good % (2020, "j", 2, 3)), (2020, "j", 4, "{")], "2")
    held, failed = state()
    assert held == [("2020", "1", "1"), ("2020", "1", "2"), ("2020", "2", "3")] and len(failed) == 3
    load([(2020, "j", 3, good % (2020, "j", 3, 1)), (2020, "j", 4, good % (2020, "j", 4, 1)), (2021, None, 1, good % (2021, "x", 1, 1))], "3")
    held, failed = state()
    assert len(held) == 6 and failed == []


def test_repeated_keys_keep_the_same_row(spark, rows):
    from statlake.operators.merge import newest_per_key

    batch = spark.createDataFrame([(1, f"v{i}", {"a": i}) for i in range(20)], "k int, v string, m map<string,int>")
    kept = {rows(newest_per_key(batch.repartition(n), ["k"]))[0][1] for n in (1, 3, 7)}
    assert len(kept) == 1


def test_null_key_fails_a_load(spark, prefix, rows):
    table = loads.raw_table("chadwick_register", "people")
    columns = "key_uuid string, name_first string"
    loads.load_table_batch(spark, table, spark.createDataFrame([("u", "x")], columns), "1", NOW, None, prefix)
    with pytest.raises(ValueError, match="null in key"):
        loads.load_table_batch(spark, table, spark.createDataFrame([(None, "x"), ("v", "y")], columns), "2", NOW, None, prefix)
    assert rows(loads.open_table(spark, table, prefix).read()) == [("u", "x", "1")]


def _landing(spark, folder, schema):
    return landed_files(spark, str(folder), "csv", spark.createDataFrame([], schema).schema)


def test_stream_merge_reads_each_file_once(spark, tmp_path, schema, rows):
    landing, table = tmp_path / "landing", LoadedTable(spark, schema, "t", ["k"])
    landing.mkdir()

    def run():
        merge_stream(_landing(spark, landing, "k int, v int"), table, str(tmp_path / "cp"), [F.col("v").desc()])

    (landing / "a.csv").write_text("1,1\n1,5\n2,2\n")
    run()
    assert rows(table.read()) == [(1, 5), (2, 2)]
    (landing / "b.csv").write_text("2,9\n3,3\n")
    run()
    run()
    assert rows(table.read()) == [(1, 5), (2, 9), (3, 3)]


def test_state_keeps_the_newest_row_through_late_files_and_replay(spark, tmp_path, rows):
    landing, path = tmp_path / "landing", str(tmp_path / "newest")
    landing.mkdir()
    kind = "k int, day int, v string"

    def run(checkpoint="cp"):
        follow_newest(_landing(spark, landing, kind), ["k"], ["day"], path, str(tmp_path / checkpoint))
        return rows(read_newest(spark, path, spark.createDataFrame([], kind).schema, ["k"]))

    (landing / "a.csv").write_text("1,5,a\n1,6,b\n2,1,c\n")
    assert run() == [(1, 6, "b"), (2, 1, "c")]
    # A late file: older for 1, newer for 2, first for 3.
    (landing / "b.csv").write_text("1,2,old\n2,4,d\n3,1,e\n")
    assert run() == run() == [(1, 6, "b"), (2, 4, "d"), (3, 1, "e")]
    # From an empty checkpoint everything is read again, into the folders of the same batches.
    assert run("other") == [(1, 6, "b"), (2, 4, "d"), (3, 1, "e")]


def test_joint_write_of_several_tables(spark, tmp_path, rows):
    games = spark.createDataFrame([(1, [(1, "a"), (2, "b")], ["x"]), (2, [], None)], "g int, innings array<struct<n:int,t:string>>, names array<string>")
    shapes = {
        "games": F.array(F.struct("g")),
        "innings": F.transform("innings", lambda i: F.struct(F.col("g").alias("g"), i["n"].alias("n"))),
        "names": F.transform("names", lambda n: F.struct(F.col("g").alias("g"), n.alias("name"))),
    }
    path = str(tmp_path / "joint")
    schema = games.select(F.explode(tagged(shapes)).alias("row")).select("row.*").schema
    write_tagged(games, shapes, path)
    assert rows(read_tagged(spark, path, schema, "games")) == [(1,), (2,)]
    assert rows(read_tagged(spark, path, schema, "innings")) == [(1, 1), (1, 2)]
    assert rows(read_tagged(spark, path, schema, "names")) == [(1, "x")]
    plan = read_tagged(spark, path, schema, "names")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "innings" not in plan.split("ReadSchema")[1]


def test_bucketed_tables_join_without_a_shuffle(spark, schema):
    facts = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    materialise(facts, f"{schema}.facts", True, ["k"], 4)
    materialise(spark.range(50).selectExpr("id AS k", "id * 2 AS w"), f"{schema}.dims", True, ["k"], 4)
    joined = spark.table(f"{schema}.facts").join(spark.table(f"{schema}.dims").hint("merge"), "k")
    assert joined.where("w <> 2 * k").count() == 0 and joined.count() == 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_materialise_and_csv(spark, tmp_path):
    materialise(spark.range(3), "three_rows", as_table=False)
    assert spark.table("three_rows").count() == 3
    materialise(spark.range(4), "four_rows", as_table=True)
    assert spark.table("four_rows").count() == 4
    path = str(tmp_path / "csv")
    write_sorted_csv(spark.createDataFrame([("2", "b"), ("1", "z")], "y string, id string"), path, ["y", "id"])
    assert [tuple(r) for r in spark.read.csv(path, header=True).collect()] == [("1", "z"), ("2", "b")]


# ---- cursors, watermarks, plan ---------------------------------------------------------

def test_cursor_wins_over_the_asked_start(spark):
    source = spark.range(2015, 2025).toDF("season")
    stored = spark.createDataFrame([("boards", "2020")], "resource string, cursor string")

    def seasons(resource, update=False):
        return sorted(r.season for r in cursors.rows_to_load(source, stored, resource, "season", 2018, 2022, update).collect())

    assert seasons("boards") == [2020, 2021, 2022]
    assert seasons("boards", update=True) == [2018, 2019, 2020, 2021, 2022]
    assert seasons("new") == [2018, 2019, 2020, 2021, 2022]
    moved = cursors.advance(stored, "boards", F.lit("2022"))
    assert [tuple(r) for r in moved.collect()] == [("boards", "2022")]


def test_type_cursor_is_clamped(spark):
    df = spark.createDataFrame([(None, 1965, 1950), (1980, 1965, 1990), (1980, 1965, 1970)], "c int, t int, s int")
    got = [r.v for r in df.select(cursors.resume_from_type(F.col("c"), F.col("t"), F.col("s")).alias("v")).collect()]
    assert got == [1965, 1990, 1980]


@pytest.mark.parametrize(
    "marks, laggard", [(["2024", "2022"], "2022"), (["2024", None], None), (["2024-04-28"], "2024-04-28"), ([None], None)])
def test_laggard(spark, marks, laggard):
    df = spark.createDataFrame([("l", m) for m in marks], "loader string, watermark string")
    assert status.laggard_watermark(df).first().laggard == laggard


def test_watermarks_of_tables(spark):
    games = spark.createDataFrame([("ANA202004020",), ("ANA201904020",)], "game_id string")
    got = status.table_watermarks(
        {"plays": games, "empty": games.where("false"), "absent": None},
        dict.fromkeys(("plays", "empty", "absent"), "substr(game_id, 4, 4)"))
    assert {r.table_name: r.watermark for r in got.collect()} == {"plays": "2020", "empty": None, "absent": None}
    none = status.table_watermarks({"a": None}, {"a": "season", "b": "season"})
    assert {r.table_name: r.watermark for r in none.collect()} == {"a": None, "b": None}
    assert status.table_watermarks({}, {}).count() == 0


@pytest.mark.parametrize(
    "text, year, day",
    [("1998", 1998, None), ("1998-12-31", 1998, "1998-12-31"), ("20000229", 2000, "2000-02-29"), ("n/a", None, None),
     ("7", None, None), ("", None, None), (None, None, None)])
def test_watermark_parse(spark, text, year, day):
    df = spark.createDataFrame([(text,)], "w string")
    assert tuple(df.select(cursors.watermark_year(F.col("w")), cursors.watermark_date(F.col("w"))).first()) == (year, day)


@pytest.mark.parametrize(
    "action, single, dates, laggard, plan",
    [("full", True, True, "1998", ("full_refresh", None, None)),
     ("full", False, True, None, ("full_refresh_history", None, None)),
     ("incremental", False, True, "2024-05-31", ("dates", "2024-05-31", "2024-06-01")),
     ("incremental", False, True, "20240601", ("dates", "2024-06-01", "2024-06-01")),
     ("incremental", False, True, "1998", ("seasons", "1998", "2024")),
     ("incremental", False, False, "2024-05-31", ("seasons", "2024", "2024")),
     ("incremental", False, False, None, ("full_history", None, None)),
     ("incremental", False, False, "n/a", ("full_history", None, None))])
def test_plan(spark, action, single, dates, laggard, plan):
    df = spark.createDataFrame([(laggard, single, dates)], "laggard string, full_refresh_only boolean, accepts_dates boolean")
    got = cursors.load_plan(df, action, F.lit(dt.date(2024, 6, 1))).first()
    assert (got.plan, got.plan_start, got.plan_end) == plan


def test_incremental_is_refused_for_single_shot_loaders(spark):
    df = spark.createDataFrame([(None, True, False)], "laggard string, full_refresh_only boolean, accepts_dates boolean")
    with pytest.raises(Exception, match="not valid"):
        cursors.load_plan(df, "incremental", F.current_date()).collect()
    with pytest.raises(ValueError):
        cursors.load_plan(df, "other", F.current_date())


def test_a_repeated_batch_is_not_written_again(spark, prefix, rows):
    table = loads.raw_table("statcast_pitches", "pitches")

    def load(load_id, *values):
        frame = spark.createDataFrame([(k, 1, 1, v, "2024-05-01") for k, v in values], "game_pk long, at_bat_number int, pitch_number int, v string, game_date string")
        loads.load_table_batch(spark, table, frame, load_id, NOW, [F.col("v").desc()], prefix)
        held = loads.open_table(spark, table, prefix).read()
        return _files(held), rows(held.select("game_pk", "v", "_load_id"))

    load("a", (1, "x"), (2, "y"), (9000, None))
    first = load("b", (2, "z"), (9000, None))
    assert first[1] == sorted([(1, "x", "a"), (2, "z", "b"), (9000, None, "b")], key=str)
    assert load("b", (2, "z"), (9000, None)) == first
    # As many rows of the same load with another value, or another key, are written.
    assert load("b", (2, "w"), (9000, None))[1] == sorted([(1, "x", "a"), (2, "w", "b"), (9000, None, "b")], key=str)
    assert load("b", (1, "w"), (9000, "n"))[1] == sorted([(1, "w", "b"), (2, "w", "b"), (9000, "n", "b")], key=str)


def test_partitions_of_games_do_not_grow_with_the_games(spark, prefix, rows):
    """However far game numbers reach, the driver has a bounded number of partitions to list; ranges that share one keep their rows."""
    part = loads.raw_table("statcast_pitches", "pitches").partition_by
    parts = spark.range(0, 60_000_000, 2500).selectExpr("id AS game_pk").select(F.expr(part).alias("part"))
    assert parts.distinct().count() == loads.GAME_PARTITIONS
    near = spark.range(0, 1_000_000, 2500).selectExpr("id AS game_pk").selectExpr(f"{part} AS part", "game_pk div 5000 AS game_range")
    assert near.where("part <> game_range").count() == 0
    table, far = loads.raw_table("mlb_statsapi_schedules", "schedules"), 1 + 5000 * loads.GAME_PARTITIONS
    for load_id, values in (("1", [(1, "a"), (far, "b")]), ("2", [(far, "c"), (far + 1, "d")])):
        batch = spark.createDataFrame(values, "game_pk long, v string").withColumn("season", F.lit("2024"))
        loads.load_table_batch(spark, table, batch, load_id, NOW, None, prefix)
    held = loads.open_table(spark, table, prefix)
    assert rows(held.read().select("game_pk", "v", "_load_id")) == sorted([(1, "a", "1"), (far, "c", "2"), (far + 1, "d", "2")], key=str)
    assert spark.table(held.full).select(tables.PART).distinct().count() == 1
