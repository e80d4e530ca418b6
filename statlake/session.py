"""Session defaults, table loading and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8000 bytes of code. A fused stage of a wide model
    # is larger and would be interpreted; below this limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Adaptive execution hashes the smaller side of a shuffled join where every partition of it is known to
    # be below this, so that a wide fact is moved but not sorted, which would spill it to disk.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app_name: str = "statlake", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive execution.

    On a cluster leave ``master`` unset and set ``spark.sql.shuffle.partitions`` to a
    multiple of the cores: adaptive execution merges partitions that turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> None:
    """Hold a session that was built elsewhere to the limits above; a lower method limit or a hash threshold of its own stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(_SETTINGS[name]):
        spark.conf.set(name, _SETTINGS[name])
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(name) in ("0", "0b"):
        spark.conf.set(name, _SETTINGS[name])


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    A session on one machine may leave the setting out and gets a temporary folder; on a cluster,
    whose machines do not share such a folder, that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="statlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: later uses do not compute it again."""
    path = os.path.join(work_dir(df.sparkSession, label), "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
