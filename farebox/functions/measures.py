"""Ratio helpers shared by analyses, measures and dashboards.

A ratio is always SUM(a) / SUM(b) over the rows in context, never a mean of
ratios. Sums are exact (DECIMAL money, integer seconds); the cast to double
happens once, right before the single division, so results do not depend on
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num: Column | str, den: Column | str) -> Column:
    """100 * num / den, NULL when den is 0 or NULL."""
    return F.try_divide(F.lit(100.0) * dbl(num), dbl(den))


def minutes(seconds: Column | str) -> Column:
    return dbl(seconds) / F.lit(60.0)


def per_minute(money: Column | str, seconds: Column | str) -> Column:
    return F.try_divide(dbl(money), minutes(seconds))


def mph(miles: Column | str, seconds: Column | str) -> Column:
    return F.try_divide(dbl(miles), minutes(seconds) / F.lit(60.0))


def n_rows() -> Column:
    return F.count(F.lit(1))


def trip_sums() -> list[Column]:
    """The additive components every trip analysis is computed from."""
    return [
        n_rows().alias("nb_trips"),
        F.sum("total_amount").alias("_rev"),
        F.sum("trip_duration_seconds").alias("_secs"),
        F.sum("trip_distance").alias("_dist"),
        F.sum("tip_amount").alias("_tip"),
        F.sum("fare_amount").alias("_fare"),
    ]


def cube_sums() -> list[Column]:
    """The same components read from the additive cube (one row per cell)."""
    return [
        F.sum("nb_trips").alias("nb_trips"),
        F.sum("total_amount").alias("_rev"),
        F.sum("duration_seconds").alias("_secs"),
        F.sum("distance_miles").alias("_dist"),
        F.sum("tip_amount").alias("_tip"),
        F.sum("fare_amount").alias("_fare"),
    ]
