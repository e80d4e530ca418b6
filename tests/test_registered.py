"""Every registered query against its SQL in DuckDB."""

import pytest
from oracle import DATA, connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF = f"{DATA}/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF), duck, SQL[name]) is None


def test_queries_without_sql_run(spark):
    for name in set(queries()) - set(SQL):
        assert queries()[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("limit, held", [("65535", "8000"), ("4000", "4000")])
def test_a_query_holds_any_session_to_methods_the_jvm_compiles(spark, limit, held):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, limit)
        queries()["flag_yn"](spark, SF)
        assert spark.conf.get(name) == held
    finally:
        spark.conf.set(name, before)


def test_war_texts_are_cast_before_the_join(spark):
    plan = queries()["model_batting_war"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "as decimal(6,2)" not in above and "as decimal(6,2)" in below
