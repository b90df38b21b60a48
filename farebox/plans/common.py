"""Shared inputs of the plan modules: the built lake, dims, SQL helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FIXTURE_RULES, TripRules
from ..operators import cube, star
from .lake import TripLake, fixture_lake

# Rules of the driver-table stand-in; the SQL oracles are written for these.
RULES = FIXTURE_RULES

_NAMED: dict[str, TripLake] = {}


def register_lake(name: str, trip_lake: TripLake) -> None:
    """Make every registered query run on ``trip_lake`` when called with ``name``
    in place of a table folder (e.g. a lake built from raw trip CSV files)."""
    _NAMED[name] = trip_lake


def lake(spark: SparkSession, sf_dir: str) -> TripLake:
    named = _NAMED.get(sf_dir)
    return named if named is not None else fixture_lake(spark, sf_dir, RULES)


def rules(spark: SparkSession, sf_dir: str) -> TripRules:
    named = _NAMED.get(sf_dir)
    return named.rules if named is not None else RULES


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).table("fact_trips")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed trips (the `trips` view): fact rows without an anomaly."""
    return cube.analysed(fact(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The additive cube of analysed trips. Any analysis whose keys are cube
    keys reads it instead of the trip-grain fact: same exact sums, far fewer rows."""
    return lake(spark, sf_dir).table("trip_cube")


_DIMS: dict[tuple, DataFrame] = {}


def _dim(spark: SparkSession, kind: str, r: TripRules, build) -> DataFrame:
    """Dimension DataFrames are immutable: build each once per session and rules
    (saves the eager analysis of a dozen projections on every query)."""
    k = (id(spark), kind, repr(r))
    df = _DIMS.get(k)
    if df is None:
        df = _DIMS[k] = build()
    return df


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rules(spark, sf_dir)
    return _dim(spark, "date", r, lambda: star.dim_date(spark, r))


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk, r = lake(spark, sf_dir), rules(spark, sf_dir)
    return _dim(spark, f"zone:{lk.root}", r, lambda: star.dim_zone(lk.zones(), r))


def dim_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rules(spark, sf_dir)
    return _dim(spark, "payment", r, lambda: star.dim_payment(spark, r))


def with_totals(df: DataFrame, *cols: str) -> DataFrame:
    """Add ``<col>_total`` = sum over all rows, for shares of an *aggregated* frame.

    Only ever applied after a groupBy whose key domain is bounded (categories,
    hours, zones, bands), so the single window partition holds a few hundred
    rows at most, at any data size; the detail is never re-scanned for totals.
    """
    w = Window.partitionBy()
    return df.withColumns({f"{c}_total": F.sum(c).over(w) for c in cols})


# --- SQL fragments for the oracles ------------------------------------------

def s_ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def s_pct(a: str, b: str) -> str:
    return f"100.0 * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def s_min(secs: str) -> str:
    return f"CAST({secs} AS DOUBLE) / 60.0"


def s_per_min(m: str, secs: str) -> str:
    return f"CAST({m} AS DOUBLE) / NULLIF({s_min(secs)}, 0)"


def s_mph(d: str, secs: str) -> str:
    return f"CAST({d} AS DOUBLE) / NULLIF({s_min(secs)} / 60.0, 0)"


def s_avg_min(secs: str, n: str) -> str:
    return f"{s_min(secs)} / NULLIF(CAST({n} AS DOUBLE), 0)"


#: Sums that a row set is reduced to, and every published ratio of them, as SQL over the aliases ``s`` (a row's sums),
#: ``card`` (the same sums over card payments) and ``whole`` (over all rows).
SQL_SUMS = {"k": "COUNT(*)", "money": "SUM(total_amount)", "secs": "SUM(trip_duration_seconds)", "miles": "SUM(trip_distance)",
            "tips": "SUM(tip_amount)", "fares": "SUM(fare_amount)"}
SQL_MEASURES = {
    "nb_trips": "s.k",
    "revenue": "CAST(s.money AS DOUBLE)",
    "trips_per_day": s_ratio("s.k", str(RULES.calendar_days)),
    "avg_basket": s_ratio("s.money", "s.k"),
    "avg_distance": s_ratio("s.miles", "s.k"),
    "avg_duration_min": s_avg_min("s.secs", "s.k"),
    "revenue_per_min": s_per_min("s.money", "s.secs"),
    "revenue_per_mile": s_ratio("s.money", "s.miles"),
    "avg_speed_mph": s_mph("s.miles", "s.secs"),
    "trips_share_pct": s_pct("s.k", "whole.k"),
    "revenue_share_pct": s_pct("s.money", "whole.money"),
    "card_share_pct": s_pct("card.k", "s.k"),
    "card_tip_rate_pct": s_pct("card.tips", "card.fares"),
}


def measures_sql(measures: list[str], key: str | None = None, source: str = "trips") -> str:
    """``measures`` by ``key`` (None: over all rows) of ``source``, as SELECT over a CTE list that is left open."""
    sums = ", ".join(f"{e} AS {a}" for a, e in SQL_SUMS.items())
    by = (f"{key}, ", f" GROUP BY {key}") if key else ("", "")
    card = f"(SELECT {sums} FROM {source} WHERE payment_type = {RULES.card_payment_type}) card"
    used = ", ".join(["sums s", *(["whole"] if any("whole." in SQL_MEASURES[m] for m in measures) else []),
                      *([card] if any("card." in SQL_MEASURES[m] for m in measures) else [])])
    return f"""
sums AS (SELECT {by[0]}{sums} FROM {source}{by[1]}),
whole AS (SELECT {sums} FROM {source})
SELECT {'s.' + by[0] if key else ''}{', '.join(f'{SQL_MEASURES[m]} AS {m}' for m in measures)} FROM {used}"""
