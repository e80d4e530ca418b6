"""Plans of laid-out tables, and schemas found in records."""

import json

import pytest
from pyspark.sql import functions as F

from statlake.operators import scope
from statlake.plans import leaderboards
from statlake.sources import csv_files, payloads


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def seasons(spark, tmp_path):
    path = str(tmp_path / "seasons")
    scope.write_by_season(spark.range(700).selectExpr("id", "cast(1990 + id % 7 as int) AS season"), path)
    return spark.read.parquet(path)


def test_season_scope_opens_its_seasons_alone(seasons):
    found = seasons.where(scope.in_seasons(F.col("season"), (1991, 1992)))
    assert found.count() == 200
    plan = _plan(found)
    assert "PartitionFilters: [isnotnull(season" in plan and "season#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len({r["f"].rsplit("/", 2)[1] for r in found.select(F.input_file_name().alias("f")).collect()}) == 2


def test_grid_prunes_seasons_when_it_runs(spark, seasons):
    legs = leaderboards.leg_dimension(spark).where("is_postseason").select("leg")
    found = scope.rows_of_grid(seasons, scope.scope_grid(spark, (1995, 2000), legs)).groupBy("season", "leg").count()
    assert sorted({(r["season"], r["count"]) for r in found.collect()}) == [(1995, 100), (1996, 100)]
    assert "dynamicpruning" in _plan(found)


def test_record_types_from_all_records(spark):
    records = [{"playerid": 1, "1B": 2, "WAR": 1, "Name": "a"}] * 500
    records += [{"WAR": 1.5, "rare": True, "x": None}, {"Name": None, "x": 3, "mixed": 1, "deep": {"a": 1}}, {"mixed": "a", "list": [1], "flag": True}, {"flag": 2}]
    texts = [(json.dumps(r),) for r in records] + [("{bad",), (None,), ("[1]",), ("5",)]
    df = spark.createDataFrame(texts, "record_content string").repartition(7)
    assert leaderboards.record_schema_of(df) == {
        "playerid": "int", "1B": "int", "WAR": "double", "Name": "string", "rare": "boolean", "x": "double",
        "mixed": "string", "deep": "string", "list": "string", "flag": "string"}
    assert {r["name"]: r["records"] for r in leaderboards.record_fields(df).collect()}["playerid"] == 500
    assert leaderboards.record_schema_of(df.limit(0)) == {}


def test_dictionary_as_a_table(spark, rows):
    fields = spark.createDataFrame([("AVG",), ("wRC+",), ("new",)], "raw_name string")
    entries = [(3, "b", "AVG", "later", "numeric"), (1, "a", "AVG", "batting_average", "numeric"), (2, "a", "wRC+", "wrc", "int64"), (4, "c", "other", "o", "x")]
    table = spark.createDataFrame(entries, "position int, group string, raw_name string, column_name string, type string")
    mapped = leaderboards.mapped_fields(fields, table)
    assert rows(mapped.select("raw_name", "column_name", "group")) == sorted([("AVG", "batting_average", "a"), ("wRC+", "wrc", "a"), ("new", None, "unmapped")], key=str)
    assert rows(leaderboards.group_field_counts(mapped)) == [("a", 2), ("unmapped", 1)]


def test_one_pass_for_the_tables_of_a_schedule(spark, tmp_path):
    game = {"gamePk": 1, "linescore": {"innings": [{"num": 1, "home": {"runs": 2}}]}, "officials": [{"officialType": "HP", "official": {"id": 5}}]}
    lines = [json.dumps({"dates": [{"games": [game, {"gamePk": 2}]}]}), "{}"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "in"))
    games = payloads.games_of(payloads.read_schedule_payloads(spark, str(tmp_path / "in")))
    from statlake.sources.sinks import read_tagged, tagged

    schema = payloads.write_schedule_tables(games, str(tmp_path / "out"))
    for name, expected in payloads.schedule_tables(games).items():
        got = read_tagged(spark, str(tmp_path / "out"), schema, name)
        assert got.columns == expected.columns and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    plan = games.select(F.explode(tagged(payloads.schedule_shapes())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_landed_folder_of_parts_is_a_file(spark, tmp_path, rows):
    folder = f"{tmp_path}/seasons/2024"
    spark.range(4).selectExpr("concat('p', id)", "'l'", "'f'", "'R'", "'L'", "'NYA'", "'RF'").repartition(2).write.csv(f"{folder}/NYA2024.ROS")
    assert csv_files.read_rosters(spark, str(tmp_path)).groupBy("season").count().collect()[0].asDict() == {"season": "2024", "count": 4}
    spark.range(3).selectExpr("id AS ID", "'x' AS last", "'y' AS first").repartition(2).write.option("header", True).csv(f"{folder}/UMPIRES2024.txt")
    assert rows(csv_files.read_umpires(spark, str(tmp_path)).select("umpire_id", "season")) == [("0", "2024"), ("1", "2024"), ("2", "2024")]
