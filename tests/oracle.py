"""Compare every registered query with its SQL in DuckDB.

``python tests/oracle.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlake.registered.base import TABLES  # noqa: E402

DATA = os.environ.get("STATLAKE_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(value)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is not None, str(value)) for value in row))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows and column names agree, else the first difference."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    expected = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs or [type(a) for a in mine] != [type(b) for b in theirs]:
            ordered = sorted(names)
            cells = [(n, a, b) for n, a, b in zip(ordered, mine, theirs) if a != b or type(a) is not type(b)]
            return f"{cells[:3]}"
    return None


def main(sf: str, only: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from statlake.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con, sqls = connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None and not found.startswith("no SQL")
        print(f"{name:34} {time.time() - start:6.1f}s  {found or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.001", sys.argv[2:])
