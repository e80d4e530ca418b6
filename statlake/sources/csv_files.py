"""CSV sources. Every column is read as text: typing is the models' job, and inference
would cost one more pass over the files. A file of a known name may also be a folder of that name
with parts, as a job lands it."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.operators.unions import label_if_absent, long_labels, names_missing
from statlake.sources import layouts


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def list_files(spark: SparkSession, folder: str, name_glob: str = "*", recursive: bool = False) -> DataFrame:
    """Files of a folder as rows ``path, name``; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(folder).select("path")
    return files.withColumn("name", F.substring_index("path", "/", -1))


def read_headed(
    spark: SparkSession, path, lower: bool = True, null_text: str | None = None, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header, all text, names lower-cased; a header-only file gives no rows."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    df = reader.csv(path)
    if renames:
        df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    return df.toDF(*[name.lower() for name in df.columns]) if lower else df


def read_repositioned(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    """CSV with a header whose names are replaced by position."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if len(df.columns) != len(columns):
        raise ValueError(f"{path}: {len(df.columns)} columns, expected {len(columns)}")
    return df.toDF(*[name.lower() for name in columns])


def read_headerless(spark: SparkSession, path, columns: Sequence[str], name_glob: str | None = None) -> DataFrame:
    """CSV without a header under a fixed text schema; missing files are tolerated at run time."""
    reader = spark.read.schema(text_schema(columns)).option("ignoreMissingFiles", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.csv(path)


def read_typed_headed(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header and typed columns. Give the schema; without one Spark reads the files twice."""
    reader = spark.read.option("header", True).option("nullValue", "")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_lahman(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table of the annual release; its file must exist."""
    path = f"{folder}/{layouts.LAHMAN_FILES[table]}"
    if table in layouts.LAHMAN_OVERRIDES:
        return read_repositioned(spark, path, layouts.LAHMAN_OVERRIDES[table])
    return read_headed(spark, path)


def inventory_gaps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(expected files that are absent, CSV files that no table maps to)."""
    listed = spark.read.format("binaryFile").load(f"{folder}/*.[cC][sS][vV]").select("path")
    found = listed.select(F.regexp_extract("path", r"([^/]+\.[cC][sS][vV])(/[^/]*)?$", 1).alias("name")).distinct()
    expected = spark.createDataFrame([(name,) for name in layouts.LAHMAN_FILES.values()], "name string")
    return names_missing(expected, found, "name"), names_missing(found, expected, "name")


def check_inventory(spark: SparkSession, folder: str) -> None:
    """Error for an absent file, warning for one that is not mapped. The lists are file names."""
    absent, extra = inventory_gaps(spark, folder)
    unmapped = [row["name"] for row in extra.orderBy("name").collect()]
    if unmapped:
        warnings.warn(f"CSV files not mapped to a table: {unmapped}", stacklevel=2)
    lost = [row["name"] for row in absent.orderBy("name").collect()]
    if lost:
        raise FileNotFoundError(f"expected files not found in {folder}: {lost}")


def read_register(spark: SparkSession, folder: str) -> DataFrame:
    """All shards ``people-0.csv`` .. ``people-z.csv`` as one table."""
    return spark.read.option("header", True).csv(f"{folder}/people-[0-9a-z].csv")


def _season_from_path(pattern: str):
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def _or_empty(read: Callable[[], DataFrame], pattern: str, columns: Sequence[str]) -> DataFrame:
    """What ``read`` gives; an empty text table and a warning if no season has a file."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    warnings.warn(f"no season has a file {pattern}", stacklevel=3)
    return _no_rows(columns)


def _no_rows(columns: Sequence[str]) -> DataFrame:
    return SparkSession.active().createDataFrame([], text_schema([*columns, "season"]))


def read_rosters(spark: SparkSession, root: str) -> DataFrame:
    """``seasons/<season>/<TEAM><season>.ROS``; the season label comes from the folder.

    Seasons without files have no rows; without any there is a warning and an empty table.
    """
    pattern = f"{root}/seasons/*/*.ROS"

    def read() -> DataFrame:
        df = spark.read.schema(text_schema(layouts.ROSTER_COLUMNS)).csv(pattern)
        return df.withColumn("season", _season_from_path(r"/seasons/([^/]+)/"))

    return _or_empty(read, pattern, layouts.ROSTER_COLUMNS)


def read_umpires(spark: SparkSession, root: str) -> DataFrame:
    """``seasons/<season>/UMPIRES<season>.txt`` with a header; absent files as for rosters."""
    pattern = f"{root}/seasons/*/UMPIRES*.txt"

    def read() -> DataFrame:
        df = spark.read.option("header", True).csv(pattern)
        labelled = df.withColumn("season", _season_from_path(r"/seasons/([^/]+)/"))
        return labelled.withColumnsRenamed(layouts.UMPIRE_RENAMES)

    return _or_empty(read, pattern, list(layouts.UMPIRE_RENAMES.values()))


def read_game_logs(spark: SparkSession, root: str, playoffs: str = "include") -> DataFrame:
    """Season logs and playoff logs under one schema, labelled with the game type.

    ``playoffs`` is ``include`` or ``only``. File names may be in either case; a season or
    series without a file simply has no rows.
    """
    if playoffs not in ("include", "only"):
        raise ValueError(f"playoffs must be include or only, not {playoffs!r}")
    columns = layouts.game_log_columns()
    places = "gamelog" if playoffs == "only" else "{seasons/*,gamelog}"
    df = spark.read.schema(text_schema(columns)).csv(f"{root}/{places}/[gG][lL]*.[tT][xX][tT]")
    path = F.col("_metadata.file_path")
    stem = F.upper(F.regexp_extract(path, r"(?i)/gamelog/GL([^/.]+)\.TXT(/[^/]+)?$", 1))
    labelled = df.withColumn("__stem", stem).withColumn("__regular", path.rlike("/seasons/[^/]+/[^/]+(/[^/]+)?$"))
    game_type = F.when(F.col("__regular"), "regular_season")
    for suffix, label in layouts.PLAYOFF_SUFFIXES.items():
        game_type = game_type.when(F.col("__stem") == suffix, label)
    labelled = labelled.withColumn("game_type", game_type).where(F.col("game_type").isNotNull())
    return labelled.drop("__stem", "__regular")


def read_season_schedules(spark: SparkSession, root: str) -> DataFrame:
    """Headerless schedules of two widths. Files of 12 columns lack ``location``.

    The width belongs to the file, not to the row, so it is decided per file: a row that fills
    all 13 columns parses without a complaint. Header rows that leaked into the data go.
    """
    columns = layouts.SEASON_SCHEDULE_COLUMNS
    schema = text_schema([*columns, "__short_row"])
    raw = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", "__short_row")
        .option("columnPruning", "false")
        .csv(f"{root}/seasons/*/[0-9]*[sS][cC][hH][eE][dD][uU][lL][eE].[cC][sS][vV]")
        .withColumn("__file", F.regexp_extract(F.col("_metadata.file_path"), r"(?i)^(.*schedule\.csv)", 1))
    )
    # Spark does not answer from the complaint column alone; a row that counts has a date.
    full = F.col("__short_row").isNull() & F.col(columns[0]).isNotNull()
    widths = raw.groupBy("__file").agg(F.max(full).alias("__full"))
    rows = raw.where(F.col(columns[0]) != "Date").join(widths, "__file")
    at = columns.index("location")
    shifted = [
        F.when(F.col("__full"), F.col(name)).otherwise(
            F.lit(None).cast("string") if i == at else F.col(columns[i - 1])
        ).alias(name)
        if i >= at
        else F.col(name)
        for i, name in enumerate(columns)
    ]
    return rows.select(*shifted)


def read_decoded_events(spark: SparkSession, path, event_class: str | None = None) -> DataFrame:
    """Decoded play-by-play CSV with an ``EVENT_ID``: the 0-based position of a row in its game.

    The order of a file is carried by (file, block of the file, row number inside the block),
    taken at the scan. A block bounds the number of rows numbered together.
    """
    from statlake.operators.ranking import running_index

    df = spark.read.option("header", True).csv(f"{path}/{layouts.EVENT_FILE_GLOBS[event_class]}" if event_class else path)
    columns = df.columns
    placed = df.select(
        *columns,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    order = [F.col("__file"), F.col("__block"), F.col("__row")]
    numbered = running_index(placed, "GAME_ID", order, order[:2], "EVENT_ID")
    return numbered.select(*columns, "EVENT_ID")


def event_files(spark: SparkSession, folder: str, event_class: str) -> DataFrame:
    """Event files of a class, whatever the case of their extension."""
    return list_files(spark, folder, layouts.EVENT_FILE_GLOBS[event_class], recursive=True)


def read_leaderboard(spark: SparkSession, path, labels: Mapping[str, object]) -> DataFrame:
    """Leaderboard CSV, all text, with its label columns added where the file has none."""
    return label_if_absent(read_headed(spark, path, lower=False), labels)


def read_label_files(
    spark: SparkSession, paths: Mapping[str, str], label: str, common: Mapping[str, object]
) -> DataFrame:
    """One row set per label value in one table (arsenal type, spin type, position, split)."""
    frames = {value: read_headed(spark, path, lower=False) for value, path in paths.items()}
    return long_labels(frames, label, common)


def read_pitches(spark: SparkSession, path) -> DataFrame:
    """Pitch CSV; dotted duplicate names are renamed."""
    return read_headed(spark, path, lower=False, renames=layouts.PITCH_RENAMES)
