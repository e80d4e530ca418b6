"""Registration, table access and plain output types."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.session import compiled

TABLES = """
region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations
""".split()

Query = Callable[[SparkSession, str], DataFrame]


class Registry(dict):
    """Query name -> (query, SQL or None)."""

    def add(self, name: str, sql: str | None = None):
        def register(query: Query) -> Query:
            if name in self:
                raise ValueError(f"query registered twice: {name}")

            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                compiled(spark)
                return plain_types(query(Tables(spark, sf_dir)))

            self[name] = (run, sql)
            return query

        return register


class Tables:
    """Driver tables and tables derived from them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        from statlake.registered.inputs import DERIVED

        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in DERIVED:
            df = self.sql(DERIVED[name])
        else:
            raise AttributeError(name)
        # Kept for the query, which may name a table many times.
        self.__dict__[name] = df
        return df

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over driver and derived tables named in the text."""
        frames = {name: getattr(self, name) for name in names_in(text)}
        marked = text.replace("{", "{{").replace("}", "}}")
        for name in frames:
            marked = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", marked)
        return self.spark.sql(marked, **frames)


def names_in(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\b(?:FROM|JOIN) ([a-z_]+)\b", text)))


@lru_cache(maxsize=None)
def _closure(names: tuple[str, ...]) -> tuple[str, ...]:
    from statlake.registered.inputs import DERIVED

    ordered: list[str] = []
    for name in names:
        if name not in DERIVED:
            continue
        for needed in (*_closure(tuple(names_in(DERIVED[name]))), name):
            if needed not in ordered:
                ordered.append(needed)
    return tuple(ordered)


def with_inputs(body: str) -> str:
    """SQL body preceded by the derived tables it names."""
    from statlake.registered.inputs import DERIVED

    needed = _closure(tuple(names_in(body)))
    ctes = [f"{name} AS ({DERIVED[name]})" for name in needed]
    text = body.strip()
    if not ctes:
        return text
    if text.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {text[5:]}"
    return f"WITH {', '.join(ctes)} {text}"


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text: types that compare across engines."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def typed_sql(table: str) -> str:
    """Select items for a ``source kind output`` table, in DuckDB's dialect."""
    casts = {
        "text": "{}",
        "string": "CAST({} AS VARCHAR)",
        "int": "TRY_CAST({} AS INTEGER)",
        "long": "TRY_CAST({} AS BIGINT)",
        "count": "COALESCE(TRY_CAST({} AS INTEGER), 0)",
        "date": "CAST(TRY_CAST({} AS DATE) AS VARCHAR)",
        "yes_no": "CASE {} WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END",
        "numeric": "CAST(TRY_CAST({} AS DECIMAL(18,3)) AS DOUBLE)",
    }
    items = []
    for line in table.strip().splitlines():
        words = line.split()
        kind = words[1] if len(words) == 3 else "text"
        cast = casts.get(kind) or f"CAST(TRY_CAST({{}} AS DECIMAL({kind})) AS DOUBLE)"
        items.append(f"{cast.format(words[0])} AS {words[-1]}")
    return ", ".join(items)


def key_sql(*parts: str) -> str:
    """Surrogate key over columns, in DuckDB's dialect."""
    texts = [f"COALESCE(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return f"md5({' || chr(45) || '.join(texts)})"
