"""Leaderboard models: record columns, loaded tables, column dictionaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.naming import short_name
from statlake.operators.joins import left_enrich
from statlake.operators.ranking import first_per_key
from statlake.sources.payloads import json_record, json_value

# Part of a season -> label, abbreviation, request code.
LEGS = [
    ("regular season", "REG", ""),
    ("Wild Card Series", "WC", "F"),
    ("Division Series", "DS", "D"),
    ("League Championship Series", "CS", "L"),
    ("World Series", "WS", "W"),
    ("postseason", "POST", "Y"),
]


def leg_dimension(spark: SparkSession) -> DataFrame:
    legs = spark.createDataFrame(LEGS, "label string, leg string, code string")
    return legs.withColumn("is_postseason", F.col("leg") != "REG")


def with_leg(rows: DataFrame, leg: str) -> DataFrame:
    """Rows of one request, marked with its leg."""
    if leg not in {abbreviation for _, abbreviation, _ in LEGS}:
        raise ValueError(f"unknown leg: {leg!r}")
    return rows.withColumns({"leg": F.lit(leg), "is_postseason": F.lit(leg != "REG")})


def json_leaderboard(raw: DataFrame) -> DataFrame:
    """Batting, pitching or fielding records kept as JSON text, with their two ids."""
    record = F.col("record_content")
    return raw.select(
        json_value(record, "$.playerid", "int").alias("fangraphs_id"),
        json_value(record, "$.Season", "int").alias("year_id"),
        "record_content",
        "extracted_at",
    )


def loaded_leaderboard(raw: DataFrame) -> DataFrame:
    """Batting or pitching table as loaded, ids first. Fielding has no mlbam id."""
    names = {"playerid": "fangraphs_id", "mlbamid": "mlbam_id", "season": "year_id"}
    ids = {old: new for old, new in names.items() if old in raw.columns}
    rest = [name for name in raw.columns if name not in ids]
    return raw.select(*[F.col(old).alias(new) for old, new in ids.items()], *rest)


@dataclass(frozen=True)
class Field:
    """One leaderboard field: its raw name, long name and type (int64, numeric, varchar, boolean)."""

    raw_name: str
    column_name: str
    type: str
    group: str = "unmapped"


# Fields that are integers in a record.
INTEGER_FIELDS = set(
    """
    xMLBAMID Season SeasonMin SeasonMax playerid teamid G AB PA H 1B 2B 3B HR R RBI BB IBB SO HBP
    SF SH GDP SB CS GB FB LD IFFB Pitches Balls Strikes IFH BU BUH Pull Cent Oppo Soft Med Hard
    bipCount TG TPA PH Events Barrels HardHit EBV ESV PPTV CPTV BPTV DSV DGV BTV
    """.split()
)

# Pitch code -> name, by measurement system.
_PITCH_NAMES = {
    "FA": "four_seam_fastball", "FT": "two_seam_fastball", "FC": "cutter", "FS": "splitter",
    "FO": "forkball", "SI": "sinker", "SL": "slider", "CU": "curveball", "KC": "knuckle_curve",
    "EP": "eephus", "CH": "changeup", "SC": "screwball", "KN": "knuckleball",
    "CS": "slow_curveball", "SB": "screwball", "XX": "unidentified_pitch", "UN": "unidentified_pitch",
}
_PITCH_INFO_CODES = "FA FC FS SI CH SL CU CS KN SB XX".split()
_STATCAST_CODES = "FA FT FC FS FO SI SL CU KC EP CH SC KN".split()
# Measure pattern -> long name pattern.
_PITCH_INFO_MEASURES = {
    "pi{}%": "{}_percentage_pi",
    "piv{}": "{}_velocity_pi",
    "pi{}-X": "{}_horizontal_movement_pi",
    "pi{}-Z": "{}_vertical_movement_pi",
    "piw{}": "{}_runs_above_average_pi",
    "piw{}/C": "{}_runs_above_average_per_100_pitches_pi",
}
_STATCAST_MEASURES = {
    "pfx{}%": "{}_percentage_sc",
    "pfxv{}%": "{}_average_velocity_sc",
    "pfx{}-X": "{}_average_horizontal_movement_inches_sc",
    "pfx{}-Z": "{}_average_vertical_movement_inches_sc",
    "pfxw{}": "{}_runs_above_average_sc",
    "pfxw{}/C": "{}_runs_above_average_per_100_pitches_sc",
}
# Plate discipline and pace, per system prefix and suffix.
_DISCIPLINE = {
    "Swing%": "swing_percentage",
    "O-Swing%": "outside_zone_swing_percentage",
    "Z-Swing%": "inside_zone_swing_percentage",
    "Contact%": "contact_percentage",
    "O-Contact%": "outside_zone_contact_percentage",
    "Z-Contact%": "inside_zone_contact_percentage",
    "Pace": "average_time_between_pitches_seconds",
}


def pitch_fields() -> list[Field]:
    """Fields that follow a rule: every pitch type by every measure, per measurement system."""
    fields = []
    for group, codes, measures in (
        ("pitch_info", _PITCH_INFO_CODES, _PITCH_INFO_MEASURES),
        ("statcast", _STATCAST_CODES, _STATCAST_MEASURES),
    ):
        for raw, long in measures.items():
            fields += [Field(raw.format(c), long.format(_PITCH_NAMES[c]), "numeric", group) for c in codes]
    fields.append(Field("pfxUN%", "unidentified_pitch_percentage_sc", "numeric", "statcast"))
    for raw, long in _DISCIPLINE.items():
        fields.append(Field(f"pi{raw}", f"{long}_pi", "numeric", "pitch_info"))
        fields.append(Field(f"pfx{raw}", f"{long}_sc", "numeric", "statcast"))
    fields.append(Field("pfxZone%", "pitches_seen_inside_zone_percentage_sc", "numeric", "statcast"))
    # The one name that breaks the pattern.
    renamed = {"pfxFC-Z": "cutter_average_vertical_movement_sc"}
    return [Field(f.raw_name, renamed.get(f.raw_name, f.column_name), f.type, f.group) for f in fields]


def override_fields(fields: Iterable[Field]) -> list[Field]:
    """Records name some fields differently from the dictionary; these follow its entries."""
    known = {field.raw_name: field for field in fields}
    # Record key -> dictionary key.
    aliases = {"BB%+": "BB+", "K%+": "K+", "position": "Position"}
    aliases |= {f"pfxv{code}": f"pfxv{code}%" for code in _STATCAST_CODES}
    return [
        Field(key, known[entry].column_name, known[entry].type, known[entry].group)
        for key, entry in aliases.items()
        if entry in known
    ]


class Dictionary:
    """Long names of raw fields. The first definition of a raw name wins."""

    def __init__(self, fields: Iterable[Field]):
        listed = list(fields)
        self._fields: dict[str, Field] = {}
        for field in [*listed, *override_fields(listed)]:
            self._fields.setdefault(field.raw_name, field)

    @classmethod
    def from_rows(cls, rows: Iterable[Mapping[str, str]]) -> "Dictionary":
        """From ``group, raw_name, column_name, type`` rows, in order of precedence, followed by
        the fields that follow a rule."""
        given = [Field(r["raw_name"], r["column_name"], r["type"], r["group"]) for r in rows]
        return cls([*given, *pitch_fields()])

    def long_name(self, raw_name: str) -> str:
        field = self._fields.get(raw_name)
        return field.column_name if field else short_name(raw_name)

    def group(self, raw_name: str) -> str:
        field = self._fields.get(raw_name)
        return field.group if field else "unmapped"

    def group_counts(self, raw_names: Iterable[str]) -> dict[str, int]:
        counts: dict[str, int] = {}
        for name in raw_names:
            counts[self.group(name)] = counts.get(self.group(name), 0) + 1
        return counts


def record_type(name: str, sample: object) -> str:
    """Spark type of a record field, from its name and a sample value."""
    if isinstance(sample, bool):
        return "boolean"
    if isinstance(sample, str):
        return "string"
    return "int" if name in INTEGER_FIELDS else "double"


def record_fields(raw: DataFrame, text: str = "record_content") -> DataFrame:
    """``name, type, records`` of every field that occurs in any record, by one aggregation.

    The types of all values of a field are merged; a field that is text in one record, or of several kinds,
    is text. Null says nothing about a type. A text that is no JSON object has no fields.
    """
    parsed = raw.select(F.try_parse_json(F.col(text)).alias("record")).where("record IS NOT NULL")
    seen = raw.sparkSession.sql(
        "SELECT key AS name, schema_of_variant_agg(value) AS kind, count(*) AS records"
        " FROM {parsed}, LATERAL variant_explode(record) WHERE schema_of_variant(record) LIKE 'OBJECT%' GROUP BY key",
        parsed=parsed,
    )
    kind, number = F.col("kind"), F.when(F.col("name").isin(*INTEGER_FIELDS), "int").otherwise("double")
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT", "VOID") | kind.startswith("DECIMAL")
    return seen.select("name", F.when(kind == "BOOLEAN", "boolean").when(numeric, number).otherwise("string").alias("type"), "records")


def record_schema_of(raw: DataFrame, text: str = "record_content") -> dict[str, str]:
    """The record schema for ``batting_records`` from all records: one row a field reaches the driver."""
    return {row["name"]: row["type"] for row in record_fields(raw, text).orderBy("name").collect()}


def mapped_fields(fields: DataFrame, entries: DataFrame) -> DataFrame:
    """``raw_name, column_name, type, group`` of record fields by a dictionary kept as a table.

    ``entries``: ``position, group, raw_name, column_name, type``; of several entries of a raw name the one of
    least position counts. A field without an entry is in the group ``unmapped``, without column name.
    """
    first = first_per_key(entries, ["raw_name"], [F.col("position"), F.col("group"), F.col("column_name")])
    found = left_enrich(fields.select("raw_name"), first, {"raw_name": "raw_name"}, ["column_name", "type", "group"])
    return found.withColumn("group", F.coalesce("group", F.lit("unmapped")))


def group_field_counts(mapped: DataFrame) -> DataFrame:
    """Number of fields in each group of a schema."""
    return mapped.groupBy("group").agg(F.count(F.lit(1)).alias("fields"))


def record_schema(sample: Mapping[str, object]) -> dict[str, str]:
    return {name: record_type(name, value) for name, value in sample.items()}


def select_dictionary(df: DataFrame, fields: Iterable[str], dictionary: Dictionary, root: str | None = None) -> DataFrame:
    """Every field under its short name and, where different, its long name."""
    columns = []
    for field in fields:
        source = F.col(f"`{field}`") if root is None else F.col(root)[field]
        names = dict.fromkeys([short_name(field), dictionary.long_name(field)])
        columns += [source.alias(name) for name in names]
    return df.select(*columns)


def batting_records(
    raw: DataFrame, schema: Mapping[str, str], dictionary: Dictionary, crosswalk: DataFrame, team_ids: DataFrame
) -> DataFrame:
    """JSON batting records as columns, with the person and the team ids of the season.

    Columns of the two dimensions that a record already has get the prefix ``register_`` or
    ``team_``.
    """
    parsed = raw.select(json_record(F.col("record_content"), schema).alias("record"))
    renamed = select_dictionary(parsed, schema, dictionary, "record")

    def added(side: DataFrame, prefix: str, taken: list[str]) -> dict[str, str]:
        return {name: f"{prefix}_{name}" if name in taken else name for name in side.columns}

    people = added(crosswalk, "register", renamed.columns)
    found = left_enrich(renamed, crosswalk, {"playerid": "fangraphs_id"}, people)
    teams = added(team_ids, "team", found.columns)
    keys = {"teamid": "fangraphs_team_id", "season": "year_id"}
    return left_enrich(found, team_ids, keys, teams)
