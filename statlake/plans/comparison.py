"""Provider-against-provider value comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions import absolute_gap, half_sum
from statlake.operators.joins import inner_enrich, left_enrich
from statlake.operators.unions import union_padded


def _totals(df: DataFrame, person: str, value: str) -> DataFrame:
    return df.groupBy(person, "year_id").agg(F.sum(value).alias("war"))


def _by_crosswalk(leaderboard: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Totals per fangraphs id first, so that the join meets one row per player and year."""
    totals = _totals(leaderboard, "fangraphs_id", "war")
    found = inner_enrich(totals, crosswalk, {"fangraphs_id": "fangraphs_id"}, ["person_id"])
    return found.groupBy("person_id", "year_id").agg(F.sum("war").alias("war"))


def war_comparison(
    batting: DataFrame, pitching: DataFrame, other_batting: DataFrame, other_pitching: DataFrame, crosswalk: DataFrame
) -> DataFrame:
    """Value per person and year by both providers, with their mean and absolute gap.

    Inside a provider an absent half counts as 0; between providers an absent side leaves the
    mean and the gap null. The halves are matched by one aggregation over their union, which
    costs one shuffle where a chain of full outer joins costs one per join. Rows without a
    person or year match nothing: they keep the half they came from as part of their key.
    """
    halves = [
        (_totals(batting, "person_id", "wins_above_replacement"), "bbref_war"),
        (_totals(pitching, "person_id", "wins_above_replacement"), "bbref_war"),
        (_by_crosswalk(other_batting, crosswalk), "fangraphs_war"),
        (_by_crosswalk(other_pitching, crosswalk), "fangraphs_war"),
    ]
    unmatched = F.col("person_id").isNull() | F.col("year_id").isNull()
    rows = [
        totals.select(
            "person_id",
            "year_id",
            F.when(unmatched, position).otherwise(-1).alias("half"),
            F.coalesce("war", F.lit(0)).alias(provider),
        )
        for position, (totals, provider) in enumerate(halves)
    ]
    combined = (
        union_padded(rows)
        .groupBy("person_id", "year_id", "half")
        .agg(F.sum("bbref_war").alias("bbref_war"), F.sum("fangraphs_war").alias("fangraphs_war"))
    )
    named = left_enrich(combined, crosswalk, {"person_id": "person_id"}, ["first_name", "last_name"])
    return named.select(
        "person_id",
        "first_name",
        "last_name",
        "year_id",
        "bbref_war",
        "fangraphs_war",
        half_sum(F.col("bbref_war"), F.col("fangraphs_war")).alias("average_war"),
        absolute_gap(F.col("bbref_war"), F.col("fangraphs_war")).alias("war_difference"),
    )
