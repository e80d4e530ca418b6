"""JSON payloads: schedules, leaderboards, record columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.sources.sinks import tagged, write_tagged

_LINE = "struct<runs:int,hits:int,errors:int,leftOnBase:int>"
_PERSON = "struct<id:bigint,fullName:string>"
_SIDE = (
    "struct<team:struct<id:bigint,name:string>,"
    "leagueRecord:struct<wins:int,losses:int,pct:string>,"
    "score:int,isWinner:boolean,splitSquad:boolean,seriesNumber:int>"
)

# The schedule payload, one game.
GAME_TYPE = (
    "struct<gamePk:bigint,gameGuid:string,link:string,gameType:string,season:string,"
    "seasonDisplay:string,gameDate:string,officialDate:string,dayNight:string,"
    "scheduledInnings:int,gameNumber:int,doubleHeader:string,gamesInSeries:int,"
    "seriesGameNumber:int,seriesDescription:string,tiebreaker:string,ifNecessary:string,"
    "ifNecessaryDescription:string,gamedayType:string,recordSource:string,"
    "calendarEventID:string,publicFacing:boolean,reverseHomeAwayStatus:boolean,"
    "inningBreakLength:int,isTie:boolean,"
    "status:struct<abstractGameState:string,abstractGameCode:string,codedGameState:string,"
    "detailedState:string,statusCode:string,startTimeTBD:boolean>,"
    f"teams:struct<home:{_SIDE},away:{_SIDE}>,"
    "venue:struct<id:bigint,name:string>,content:struct<link:string>,"
    f"decisions:struct<winner:{_PERSON},loser:{_PERSON},save:{_PERSON}>,"
    "gameInfo:struct<attendance:int,firstPitch:string,gameDurationMinutes:int>,"
    "weather:struct<condition:string,temp:string,wind:string>,"
    "flags:struct<noHitter:boolean,perfectGame:boolean,awayTeamNoHitter:boolean,"
    "awayTeamPerfectGame:boolean,homeTeamNoHitter:boolean,homeTeamPerfectGame:boolean>,"
    "seriesStatus:struct<result:string,description:string,shortDescription:string,wins:int,"
    "losses:int,totalGames:int,gameNumber:int,isOver:boolean,isTied:boolean,"
    "winningTeam:struct<id:bigint>,losingTeam:struct<id:bigint>>,"
    "linescore:struct<currentInning:int,inningState:string,isTopInning:boolean,balls:int,"
    f"strikes:int,outs:int,innings:array<struct<num:int,ordinalNum:string,home:{_LINE},away:{_LINE}>>,"
    f"teams:struct<home:{_LINE},away:{_LINE}>>,"
    f"officials:array<struct<official:{_PERSON},officialType:string>>>"
)
PAYLOAD_SCHEMA = f"dates array<struct<date:string,games:array<{GAME_TYPE}>>>"

# Flat column -> path in the payload, in output order.
GAME_PATHS = """
game_pk gamePk
game_guid gameGuid
link link
season season
season_display seasonDisplay
game_type gameType
game_date gameDate
official_date officialDate
day_night dayNight
scheduled_innings scheduledInnings
game_number gameNumber
double_header doubleHeader
games_in_series gamesInSeries
series_game_number seriesGameNumber
series_description seriesDescription
tiebreaker tiebreaker
if_necessary ifNecessary
if_necessary_description ifNecessaryDescription
gameday_type gamedayType
record_source recordSource
calendar_event_id calendarEventID
public_facing publicFacing
reverse_home_away_status reverseHomeAwayStatus
inning_break_length inningBreakLength
is_tie isTie
status_abstract status.abstractGameState
status_abstract_code status.abstractGameCode
status_coded status.codedGameState
status_detailed status.detailedState
status_status_code status.statusCode
status_start_time_tbd status.startTimeTBD
home_team_id teams.home.team.id
home_team_name teams.home.team.name
away_team_id teams.away.team.id
away_team_name teams.away.team.name
home_score teams.home.score
away_score teams.away.score
home_is_winner teams.home.isWinner
away_is_winner teams.away.isWinner
home_split_squad teams.home.splitSquad
away_split_squad teams.away.splitSquad
home_series_number teams.home.seriesNumber
away_series_number teams.away.seriesNumber
home_record_wins teams.home.leagueRecord.wins
home_record_losses teams.home.leagueRecord.losses
home_record_pct teams.home.leagueRecord.pct
away_record_wins teams.away.leagueRecord.wins
away_record_losses teams.away.leagueRecord.losses
away_record_pct teams.away.leagueRecord.pct
venue_id venue.id
venue_name venue.name
content_link content.link
winning_pitcher_id decisions.winner.id
winning_pitcher_name decisions.winner.fullName
losing_pitcher_id decisions.loser.id
losing_pitcher_name decisions.loser.fullName
save_pitcher_id decisions.save.id
save_pitcher_name decisions.save.fullName
attendance gameInfo.attendance
first_pitch gameInfo.firstPitch
game_duration_minutes gameInfo.gameDurationMinutes
weather_condition weather.condition
weather_temp weather.temp
weather_wind weather.wind
no_hitter flags.noHitter
perfect_game flags.perfectGame
home_team_no_hitter flags.homeTeamNoHitter
home_team_perfect_game flags.homeTeamPerfectGame
away_team_no_hitter flags.awayTeamNoHitter
away_team_perfect_game flags.awayTeamPerfectGame
series_status_result seriesStatus.result
series_status_description seriesStatus.description
series_status_short_description seriesStatus.shortDescription
series_status_wins seriesStatus.wins
series_status_losses seriesStatus.losses
series_status_total_games seriesStatus.totalGames
series_status_game_number seriesStatus.gameNumber
series_status_is_over seriesStatus.isOver
series_status_is_tied seriesStatus.isTied
series_status_winning_team_id seriesStatus.winningTeam.id
series_status_losing_team_id seriesStatus.losingTeam.id
current_inning linescore.currentInning
inning_state linescore.inningState
is_top_inning linescore.isTopInning
balls linescore.balls
strikes linescore.strikes
outs linescore.outs
home_line_runs linescore.teams.home.runs
home_line_hits linescore.teams.home.hits
home_line_errors linescore.teams.home.errors
home_line_lob linescore.teams.home.leftOnBase
away_line_runs linescore.teams.away.runs
away_line_hits linescore.teams.away.hits
away_line_errors linescore.teams.away.errors
away_line_lob linescore.teams.away.leftOnBase
"""
INNING_PATHS = """
inning_num num
inning_ordinal ordinalNum
home_runs home.runs
home_hits home.hits
home_errors home.errors
home_left_on_base home.leftOnBase
away_runs away.runs
away_hits away.hits
away_errors away.errors
away_left_on_base away.leftOnBase
"""
OFFICIAL_PATHS = """
official_type officialType
official_id official.id
official_full_name official.fullName
"""


def _pick(root: str, paths: str) -> list[Column]:
    pairs = [line.split() for line in paths.strip().splitlines()]
    return [F.col(f"{root}.{path}").alias(name) for name, path in pairs]


def read_schedule_payloads(spark: SparkSession, path) -> DataFrame:
    """One row per payload. Land one payload per line: a multi-line file is one task."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def games_of(payloads: DataFrame) -> DataFrame:
    """``game`` structs of all dates; a payload without dates or games has no rows."""
    days = payloads.select(F.explode("dates").alias("day"))
    return days.select(F.explode("day.games").alias("game"))


def flat_games(games: DataFrame) -> DataFrame:
    """95 flat columns per game; an absent branch gives nulls."""
    return games.select(*_pick("game", GAME_PATHS))


def inning_rows(games: DataFrame) -> DataFrame:
    """One row per inning; a game without a line score has none."""
    rows = games.select(F.col("game.gamePk").alias("game_pk"), F.explode("game.linescore.innings").alias("inning"))
    return rows.select("game_pk", *_pick("inning", INNING_PATHS))


def official_rows(games: DataFrame) -> DataFrame:
    """One row per official."""
    rows = games.select(F.col("game.gamePk").alias("game_pk"), F.explode("game.officials").alias("entry"))
    return rows.select("game_pk", *_pick("entry", OFFICIAL_PATHS))


def schedule_tables(games: DataFrame) -> dict[str, DataFrame]:
    """The three tables of a schedule load, from one ``games`` frame. Persist ``games`` when
    more than one of them is written."""
    return {
        "schedules": flat_games(games),
        "schedules_linescore_innings": inning_rows(games),
        "schedules_officials": official_rows(games),
    }


def _pick_of(row: Column, paths: str) -> list[Column]:
    """The fields of a struct that is no column of a frame, as inside an array."""
    pairs = [line.split() for line in paths.strip().splitlines()]
    return [reduce(lambda value, step: value[step], path.split("."), row).alias(name) for name, path in pairs]


def schedule_shapes() -> dict[str, Column]:
    """The rows of the three tables that one ``game`` gives, as arrays."""
    key = F.col("game.gamePk").alias("game_pk")
    return {
        "schedules": F.array(F.struct(*_pick("game", GAME_PATHS))),
        "schedules_linescore_innings": F.transform("game.linescore.innings", lambda i: F.struct(key, *_pick_of(i, INNING_PATHS))),
        "schedules_officials": F.transform("game.officials", lambda o: F.struct(key, *_pick_of(o, OFFICIAL_PATHS))),
    }


def write_schedule_tables(games: DataFrame, path: str) -> T.StructType:
    """The three tables of a schedule load in one pass: each payload is read and parsed once.

    Returns the schema with which ``read_tagged`` reads one of them.
    """
    shapes = schedule_shapes()
    write_tagged(games, shapes, path)
    return games.select(F.explode(tagged(shapes)).alias("row")).select("row.*").schema


def leaderboard_rows(payloads: DataFrame, text: str, row_type: T.DataType | str) -> DataFrame:
    """Rows of ``{"data": [row, ...]}`` texts; a payload without ``data`` has no rows.

    Fields that ``row_type`` does not name are dropped; use ``variant`` as row type to keep
    rows whose keys differ.
    """
    kind = row_type if isinstance(row_type, str) else row_type.simpleString()
    data = F.from_json(F.col(text), f"data array<{kind}>")["data"]
    return payloads.select(*[c for c in payloads.columns if c != text], F.explode(data).alias("row"))


def json_value(text: Column, path: str, kind: str) -> Column:
    """Value at a path of a JSON text, null where the text or the cast is bad."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def json_record(text: Column, fields: Mapping[str, str]) -> Column:
    """JSON text to a struct of the named fields; an absent key is null."""
    schema = T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields.items()])
    return F.from_json(text, schema)
