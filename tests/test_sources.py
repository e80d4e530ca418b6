import json
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from statlake.sources import csv_files, layouts, pages, payloads


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_lahman_tables_are_lower_case_text(spark, tmp_path, rows):
    head = ",".join(c.lstrip("_") for c in layouts.BATTING_COLUMNS)
    lines = ["doejo01,2023,1,NYA,AL,150,500,70,140,30,3,20,80,5,2,40,100,1,2,0,3,10",
             "doeja02,2023,1,BOS,AL,100,300,40,80,12,4,10,40,1,1,30,60,0,1,0,1,5"]
    put(tmp_path, "Batting.csv", "\n".join([head, *lines]) + "\n")
    put(tmp_path, "People.csv", "playerID,birthYear\ndoejo01,1990\n")
    batting = csv_files.read_lahman(spark, str(tmp_path), "batting")
    assert {f.dataType.simpleString() for f in batting.schema} == {"string"}
    assert rows(batting.select("playerid", "_2b", "_3b")) == [("doeja02", "12", "4"), ("doejo01", "30", "3")]
    assert csv_files.read_lahman(spark, str(tmp_path), "people").columns == ["playerid", "birthyear"]


def test_repositioned_width_is_checked(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="expected 3"):
        csv_files.read_repositioned(spark, path, ["x", "y", "z"])


def test_inventory(spark, tmp_path):
    for name in layouts.LAHMAN_FILES.values():
        put(tmp_path, name, "a\n1\n")
    csv_files.check_inventory(spark, str(tmp_path))
    put(tmp_path, "NewSabrTable.csv", "a,b\n1,2\n")
    with pytest.warns(UserWarning, match="NewSabrTable"):
        csv_files.check_inventory(spark, str(tmp_path))
    other = tmp_path / "other"
    put(other, "Batting.csv", "a\n1\n")
    with pytest.raises(FileNotFoundError, match="People.csv"):
        csv_files.check_inventory(spark, str(other))


def test_register_shards(spark, tmp_path):
    put(tmp_path, "people-0.csv", "key_uuid,name_first\nu1,A\nu2,B\n")
    put(tmp_path, "people-a.csv", "key_uuid,name_first\nu3,C\n")
    put(tmp_path, "names.csv", "last\nX\n")
    got = csv_files.read_register(spark, str(tmp_path)).orderBy("key_uuid").collect()
    assert [r.key_uuid for r in got] == ["u1", "u2", "u3"]


def test_game_logs_of_seasons_and_series(spark, tmp_path, rows):
    def line(date, home):
        cells = dict.fromkeys(layouts.game_log_columns(), "NA") | {"date": date, "home_team": home, "game_num": "0"}
        return ",".join(f'"{v}"' for v in cells.values()) + "\n"

    assert len(layouts.game_log_columns()) == 161
    put(tmp_path, "seasons/2024/GL2024.TXT", line("20240401", "NYA") + line("20240402", "BOS"))
    put(tmp_path, "seasons/2023/gl2023.txt", line("20230401", "SEA"))
    put(tmp_path, "gamelog/GLWS.TXT", line("20241025", "LAN"))
    put(tmp_path, "gamelog/GL2024.TXT", line("20240401", "NYA"))
    got = csv_files.read_game_logs(spark, str(tmp_path)).select("date", "home_team", "game_type")
    assert rows(got) == [
        ("20230401", "SEA", "regular_season"), ("20240401", "NYA", "regular_season"),
        ("20240402", "BOS", "regular_season"), ("20241025", "LAN", "world_series")]
    only = csv_files.read_game_logs(spark, str(tmp_path), playoffs="only")
    assert [r.game_type for r in only.collect()] == ["world_series"]
    with pytest.raises(ValueError):
        csv_files.read_game_logs(spark, str(tmp_path), playoffs="none")


def test_season_schedules_of_both_widths(spark, tmp_path, rows):
    old = '"19000419","0","Thu","BOS","NL",1,"PHI","NL",1,"d","",""\n'
    put(tmp_path, "seasons/1900/1900schedule.csv", old)
    head13 = "Date,Num,Day,Visitor,League,Game,Home,League,Game,Day/Night,Location,Postponed,Makeup\n"
    new = "20240328,0,Thu,LAN,NL,1,SDN,NL,1,n,NYC01,,\n"
    # A short row in a wide file stays aligned to the left.
    short = "20240329,0,Fri,LAN,NL,2,SDN,NL,2,n,LOS03,rain\n"
    put(tmp_path, "seasons/2024/2024schedule.csv", head13 + new + short)
    head12 = "Date,Num,Day,Visitor,League,Game,Home,League,Game,Day/Night,Postponed,Makeup\n"
    put(tmp_path, "seasons/2000/2000SCHEDULE.CSV", head12 + "20000403,0,Mon,NYA,AL,1,ANA,AL,1,n,Rain,20000404\n")
    df = csv_files.read_season_schedules(spark, str(tmp_path))
    assert df.columns == layouts.SEASON_SCHEDULE_COLUMNS
    assert rows(df.select("date", "home_team", "location", "postponement_cancellation", "date_of_makeup")) == sorted(
        [("19000419", "PHI", None, None, None), ("20240328", "SDN", "NYC01", None, None),
         ("20240329", "SDN", "LOS03", "rain", None), ("20000403", "ANA", None, "Rain", "20000404")], key=str)


def test_rosters_and_umpires_take_the_season_from_the_folder(spark, tmp_path, rows):
    put(tmp_path, "seasons/2024/NYA2024.ROS", "judga001,Judge,Aaron,R,R,NYA,RF\nsotoj001,Soto,Juan,L,L,NYA,LF\n")
    put(tmp_path, "seasons/2024/BOS2024.ROS", "dever001,Devers,Rafael,L,R,BOS,3B\n")
    put(tmp_path, "seasons/2024/UMPIRES2024.txt", "ID,last,first\nu1,A,B\nu2,C,D\n")
    rosters = csv_files.read_rosters(spark, str(tmp_path))
    assert rosters.count() == 3 and {r.season for r in rosters.collect()} == {"2024"}
    umpires = csv_files.read_umpires(spark, str(tmp_path))
    assert rows(umpires) == [("u1", "A", "B", "2024"), ("u2", "C", "D", "2024")]
    assert umpires.columns == ["umpire_id", "last_name", "first_name", "season"]


def test_event_files_by_class(spark, tmp_path):
    for name in ("2024ANA.EVA", "2024nyn.evn", "2024ANA.EBA", "readme.txt"):
        put(tmp_path, name, "x\n")
    counts = {kind: csv_files.event_files(spark, str(tmp_path), kind).count() for kind in layouts.EVENT_FILE_GLOBS}
    assert counts == {"full": 2, "box": 1, "deduced": 0}


def test_event_index_restarts_per_game_and_follows_the_file(spark, tmp_path):
    put(tmp_path, "events.csv", "GAME_ID,BAT_ID\n" + "".join(f"g{i // 3},b{99 - i}\n" for i in range(9)))
    got = csv_files.read_decoded_events(spark, str(tmp_path)).collect()
    assert {r.BAT_ID: r.EVENT_ID for r in got} == {f"b{99 - i}": str(i % 3) for i in range(9)}


def test_leaderboards(spark, tmp_path, rows):
    path = put(tmp_path, "board.csv", "player_id,abs\n100,500\n")
    assert rows(csv_files.read_leaderboard(spark, path, {"year": 2023})) == [("100", "500", "2023")]
    empty = put(tmp_path, "empty.csv", "player_id\n")
    assert csv_files.read_leaderboard(spark, empty, {"year": 2023}).count() == 0
    both = csv_files.read_label_files(spark, {"raw": path, "percent": path}, "split_type", {"year": 2023})
    assert rows(both) == [("100", "500", "2023", "percent"), ("100", "500", "2023", "raw")]


def test_pitch_columns_with_dots(spark, tmp_path):
    path = put(tmp_path, "p.csv", "game_pk,pitcher.1,fielder_2.1\n1,2,3\n")
    assert csv_files.read_pitches(spark, path).columns == ["game_pk", "pitcher_1", "fielder_2_1"]


GAME = {
    "gamePk": 1, "season": "2024", "teams": {"home": {"team": {"id": 10, "name": "H"}, "score": 3},
                                             "away": {"team": {"id": 20, "name": "A"}, "score": 2}},
    "decisions": {"winner": {"id": 5, "fullName": "W P"}},
    "linescore": {"currentInning": 9, "innings": [
        {"num": 1, "ordinalNum": "1st", "home": {"runs": 1, "hits": 2, "errors": 0, "leftOnBase": 3}, "away": {"runs": 0}},
        {"num": 2, "ordinalNum": "2nd", "home": {"runs": 2}, "away": {"runs": 2}}]},
    "officials": [{"official": {"id": i, "fullName": f"U{i}"}, "officialType": t}
                  for i, t in enumerate(["Home Plate", "First Base", "Second Base", "Third Base"])],
}


def test_schedule_payload_to_three_tables(spark, tmp_path):
    payload = {"dates": [{"date": "a", "games": [GAME, {"gamePk": 2}]}, {"date": "b", "games": [{"gamePk": 3}]}]}
    path = put(tmp_path, "payloads.json", json.dumps(payload) + "\n{}\n")
    games = payloads.games_of(payloads.read_schedule_payloads(spark, path))
    tables = payloads.schedule_tables(games)
    flat = {r.game_pk: r for r in tables["schedules"].collect()}
    assert sorted(flat) == [1, 2, 3] and len(flat[1]) == 95
    assert (flat[1].home_score, flat[1].away_team_name, flat[1].winning_pitcher_id) == (3, "A", 5)
    assert flat[2].home_score is None and flat[2].current_inning is None
    innings = tables["schedules_linescore_innings"].orderBy("inning_num").collect()
    assert [(r.game_pk, r.inning_num, r.home_runs, r.away_hits) for r in innings] == [(1, 1, 1, None), (1, 2, 2, None)]
    assert len(innings[0]) == 11
    assert tables["schedules_officials"].count() == 4


def test_leaderboard_payload(spark):
    df = spark.createDataFrame([('{"data": [{"playerid": "100", "WAR": 8.5}]}',), ("{}",)], "t string")
    got = payloads.leaderboard_rows(df, "t", "struct<playerid:string,WAR:double>").select("row.*").collect()
    assert [tuple(r) for r in got] == [("100", 8.5)]
    loose = payloads.leaderboard_rows(df, "t", "variant")
    assert loose.select(F.variant_get("row", "$.WAR", "double").alias("w")).first().w == 8.5


def test_python_literal_text_is_not_json(spark):
    df = spark.createDataFrame([("{'test': 'test', 'null': None}",)], "t string")
    assert df.select(payloads.json_value(F.col("t"), "$.x", "int").alias("v")).first().v is None


def test_draft_page(spark):
    cell = '<td><a href="{}">{}</a></td>'
    head = "<tr>" + "".join(f"<th>{h}</th>" for h in ("Year", "Rnd", "RdPck", "Name", "Tm", "G", "G")) + "</tr>"
    row = ("<tr><th>2020</th><td>1</td><td>5</td>" + cell.format("/players/d/doejo01.shtml", "John Doe")
           + cell.format("/d?team_ID=NYY&amp;year_ID=2020", "Yankees") + "<td>10</td><td></td></tr>")
    html = f"<table><thead>{head}</thead><tbody>{row}{head}</tbody></table>"
    df = spark.createDataFrame([(2020, "junreg", html), (2019, "junreg", html)], "y int, t string, html string")
    got = pages.draft_rows(df, "html", "y", "t", ["Rnd", "RdPck", "G", "G.1"]).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "Year": "2020", "Rnd": "1", "RdPck": "5", "G": "10", "GP": None, "Name": "John Doe", "Tm": "Yankees",
        "link": "/players/d/doejo01.shtml", "id_type": "baseball_reference_id", "player_id": "doejo01",
        "notes": "NA", "team_id": "NYY", "draft_type": "junreg"}


def test_rows_of_pages_without_end_tags(spark):
    page = "<table><tr><th>Year<th>Rnd<tr><td>2020<td>1<td>more<tr><td>2021<td>2</table><table><tr><td>x<td>y</table><table><tr><th>A<tr><td>last"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    got = [{k: v["text"] for k, v in r.cells.items()} for r in pages.table_rows(df, "html", ["id"]).orderBy("row_index").collect()]
    assert got == [
        {"Year": "2020", "Rnd": "1", "column_2": "more"}, {"Year": "2021", "Rnd": "2"}, {"column_0": "x", "column_1": "y"}, {"A": "last"}]


def test_seasons_without_rosters_or_umpires(spark, tmp_path):
    (tmp_path / "seasons" / "1999").mkdir(parents=True)
    for read in (csv_files.read_rosters, csv_files.read_umpires):
        with pytest.warns(UserWarning, match="no season"):
            df = read(spark, str(tmp_path))
        assert df.count() == 0 and df.columns[-1] == "season"


PLAIN_PAGES = [
    "",
    '<table><tr><th>A</th><th>A</th></tr><tr><td>1 \n 2</td><td><a href="/x?a=1&amp;b=2">T</a>&nbsp;&lt;</td></tr></table>',
    "<tr><td>open<tr><th>x</th><td><a>no link</a><a href=\"\">e</a></table>",
    "before<table>text</td><td>out of a row</table></table>",
    '<a href="/outside">x</a><table><thead><td>a</thead><tbody><th>b</tbody></table>',
]


@pytest.mark.parametrize("page", PLAIN_PAGES)
def test_plain_tags_give_the_parsers_events(page, monkeypatch):
    fed = []
    fast = pages._page_rows(page)
    monkeypatch.setattr(pages, "_PLAIN_PAGE", re.compile("(?!)"))
    monkeypatch.setattr(pages._TableRows, "feed", lambda self, text: (fed.append(text), HTMLParser.feed(self, text)))
    assert fast == pages._page_rows(page)
    assert fed == [page]


def test_a_page_of_plain_tags_is_not_given_to_the_slow_parser(monkeypatch):
    monkeypatch.setattr(pages._TableRows, "feed", lambda self, text: pytest.fail("fed"))
    assert pages._page_rows("<table><tr><th>A</th></tr><tr><td>1</td></tr></table>")[0]["cells"] == [{"name": "A", "text": "1", "link": None}]
