"""Derived counts and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double on its binary value: 1.005 to two digits is 1.0, not 1.01."""
    scale = float(10**digits)
    scaled = value * scale
    nearest = F.rint(scaled)
    # rint() sends ties to the even side; a tie goes away from zero here.
    whole = F.when(F.abs(scaled - nearest) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(nearest)
    # Adding zero turns a negative zero into zero.
    return (whole + 0.0) / scale


def safe_divide(dividend: Column, divisor: Column, digits: int = 0) -> Column:
    """Rounded ratio of the two whole expressions, 0 for a zero divisor, null for a null one."""
    ratio = F.try_divide(dividend.cast("double"), divisor.cast("double"))
    return F.when(divisor == 0, F.lit(0.0)).otherwise(round_half_away(ratio, digits))


def outs_to_innings(outs: Column) -> Column:
    """16 outs -> ``5.1``."""
    whole = F.floor(outs / 3).cast("string")
    return F.concat(whole, F.lit("."), (outs % 3).cast("string"))


def half_sum(left: Column, right: Column) -> Column:
    return (left + right).cast("double") / 2


def absolute_gap(left: Column, right: Column) -> Column:
    return F.abs(left - right)


def plate_appearances() -> Column:
    return (
        F.col("at_bats") + F.col("walks") + F.col("hit_by_pitches")
        + F.col("sacrifice_hits") + F.col("sacrifice_flies")
    )


def times_on_base() -> Column:
    return F.col("hits") + F.col("walks") + F.col("hit_by_pitches")


def on_base_percentage() -> Column:
    chances = F.col("at_bats") + F.col("walks") + F.col("hit_by_pitches") + F.col("sacrifice_flies")
    return safe_divide(times_on_base(), chances, 3)


def outs_made() -> Column:
    return (
        F.col("at_bats") - F.col("hits") + F.col("sacrifice_hits") + F.col("sacrifice_flies")
        + F.col("ground_into_double_plays") + F.col("caught_stealing")
    )


def extra_base_hits() -> Column:
    return F.col("doubles") + F.col("triples") + F.col("home_runs")


def total_bases() -> Column:
    return F.col("hits") + F.col("doubles") + 2 * F.col("triples") + 3 * F.col("home_runs")


def pitching_rates() -> dict[str, Column]:
    """Rate columns of a pitching line, by output name."""
    c = F.col
    charged = c("batters_faced") - c("walks") - c("hit_by_pitches") - c("sacrifice_hits")
    in_play = charged - c("strikeouts") - c("home_runs")
    outs, faced = c("outs_pitched"), c("batters_faced")

    def per_nine(count: Column, digits: int) -> Column:
        return safe_divide(count * 27, outs, digits)

    return {
        "batting_average_against": safe_divide(c("hits"), charged - c("sacrifice_flies"), 3),
        "batting_average_on_balls_in_play": safe_divide(c("hits") - c("home_runs"), in_play, 3),
        "runs_allowed_average": per_nine(c("runs"), 2),
        "earned_runs_allowed_average": per_nine(c("earned_runs"), 2),
        "whip": safe_divide((c("walks") + c("hits")) * 3, outs, 3),
        "hits_allowed_per_nine": per_nine(c("hits"), 1),
        "home_runs_allowed_per_nine": per_nine(c("home_runs"), 1),
        "walks_allowed_per_nine": per_nine(c("walks"), 1),
        "walks_allowed_per_strikeout_thrown": safe_divide(c("walks"), c("strikeouts"), 2),
        "strikeouts_thrown_rate": safe_divide(c("strikeouts"), faced, 3),
        "walks_allowed_rate": safe_divide(c("walks"), faced, 3),
        "home_runs_allowed_rate": safe_divide(c("home_runs"), faced, 3),
    }
