"""Business rules as Spark Columns.

Every rule is a plain function returning a ``Column`` (one CASE expression),
so Catalyst folds it into the surrounding projection and whole-stage codegen
compiles it: no UDF, no per-row Python.

Column names follow the canonical trip schema (see ``sources.schemas``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..config import TripRules


def first_match(cases: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Ordered (predicate, label) pairs -> one CASE; the first true predicate wins.

    A NULL predicate counts as false, as in SQL, so a rule whose inputs are
    NULL is skipped unless the rule tests for NULL itself.
    """
    expr = None
    for pred, label in cases:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    if expr is None:
        return F.lit(otherwise)
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


def _null_or_not_positive(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) <= 0)


def reject_reason() -> Column:
    """First failed validity rule, NULL when the trip is valid."""
    return first_match([
        (F.col("pu_location_id").isNull() | F.col("do_location_id").isNull(), C.REJECT_ZONE_MISSING),
        (F.col("pickup_ts").isNull() | F.col("dropoff_ts").isNull(), C.REJECT_TIME_MISSING),
        (F.col("dropoff_ts") <= F.col("pickup_ts"), C.REJECT_DROPOFF_BEFORE_PICKUP),
        (_null_or_not_positive("trip_distance"), C.REJECT_DISTANCE),
        (_null_or_not_positive("fare_amount"), C.REJECT_FARE),
        (_null_or_not_positive("passenger_count"), C.REJECT_NO_PASSENGER),
    ])


def is_valid() -> Column:
    return reject_reason().isNull()


def trip_category(rules: TripRules) -> Column:
    """Airport if either end is an airport zone, else by the core borough."""
    airport, intra, cross, outside = rules.category_labels
    ids = list(rules.airport_zone_ids)
    is_airport = (F.col("pu_location_id").isin(ids) | F.col("do_location_id").isin(ids)) if ids else F.lit(False)
    pu_core = F.col("pickup_borough") == F.lit(rules.core_borough)
    do_core = F.col("dropoff_borough") == F.lit(rules.core_borough)
    return first_match([
        (is_airport, airport),
        (pu_core & do_core, intra),
        (pu_core | do_core, cross),
    ], otherwise=outside)


def distance_band(col: str = "trip_distance") -> Column:
    """Right-open distance bands; NULL falls into the last band."""
    d = F.col(col)
    labels = C.DISTANCE_BAND_LABELS
    return first_match(
        [(d < F.lit(edge), labels[i]) for i, edge in enumerate(C.DISTANCE_BAND_EDGES)],
        otherwise=labels[-1],
    )


def time_slot(hour_col: str = "hour") -> Column:
    """Right-open hour slots; NULL falls into the last slot."""
    h = F.col(hour_col)
    labels = C.TIME_SLOT_LABELS
    return first_match(
        [(h < F.lit(edge), labels[i]) for i, edge in enumerate(C.TIME_SLOT_EDGES)],
        otherwise=labels[-1],
    )


def trip_seconds() -> Column:
    """Whole seconds between pickup and dropoff (works on TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.timestamp_diff("SECOND", F.col("pickup_ts"), F.col("dropoff_ts"))


def anomaly_reason(rules: TripRules) -> Column:
    """First residual anomaly of a valid trip, NULL when the trip is analysable.

    Comparisons are exact: durations in integer seconds, speed as
    ``distance * 3600 > max_speed * seconds`` (no float quotient at the
    boundary), money as DECIMAL.
    """
    ts = F.col("pickup_ts")
    secs = F.col("trip_duration_seconds")
    start = F.lit(rules.period_start).cast("timestamp_ntz")
    end = F.lit(rules.period_end).cast("timestamp_ntz")
    return first_match([
        ((ts < start) | (ts >= end), C.ANOMALY_PERIOD),
        (F.col("total_amount") > F.lit(rules.max_total_amount), C.ANOMALY_AMOUNT),
        ((secs > 0) & (F.col("trip_distance") * F.lit(3600.0) > F.lit(float(rules.max_speed_mph)) * secs),
         C.ANOMALY_SPEED),
        (secs > F.lit(rules.max_duration_min * 60), C.ANOMALY_LONG),
        (secs < F.lit(rules.min_duration_min * 60), C.ANOMALY_SHORT),
    ])


def date_id(col: str) -> Column:
    """yyyyMMdd integer key of a date or timestamp."""
    c = F.col(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def iso_day_of_week(col: str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(F.col(col)) + 1).cast("int")


def day_name(col: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in C.DAY_NAMES]), iso_day_of_week(col))


def january_holiday(col: str) -> Column:
    """New Year's Day or the third Monday of January, in any year."""
    c = F.col(col)
    day = F.dayofmonth(c)
    return (F.month(c) == 1) & ((day == 1) | ((iso_day_of_week(col) == 1) & day.between(15, 21)))
