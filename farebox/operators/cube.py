"""Additive measure cube (the BI rollup) and its reconciliation with the detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUBE_GRAIN = ("date_id", "hour", "pickup_location_id", "payment_type", "trip_category", "distance_band")


def analysed(fact: DataFrame) -> DataFrame:
    """The ``trips`` view of the analyses: fact rows without an anomaly."""
    return fact.filter(F.col("anomaly_reason").isNull())


def cube_measures() -> list:
    """Nine additive measures. Money stays DECIMAL and durations integer seconds,
    so any regrouping of the cube equals the same aggregate over the detail."""
    return [
        F.count(F.lit(1)).alias("nb_trips"),
        F.sum(F.col("passenger_count").cast("bigint")).alias("nb_passengers"),
        F.sum("trip_distance").alias("distance_miles"),
        F.sum("trip_duration_seconds").alias("duration_seconds"),
        F.sum("fare_amount").alias("fare_amount"),
        F.sum("tip_amount").alias("tip_amount"),
        F.sum("tolls_amount").alias("tolls_amount"),
        F.sum(F.col("extra") + F.col("mta_tax") + F.col("improvement_surcharge")).alias("surcharges_amount"),
        F.sum("total_amount").alias("total_amount"),
    ]


def build_trip_cube(fact: DataFrame) -> DataFrame:
    """Group the analysed trips at the 6-key grain (partial + final hash aggregate)."""
    return (analysed(fact).groupBy(*CUBE_GRAIN).agg(*cube_measures())
            .withColumn("duration_minutes", F.col("duration_seconds") / F.lit(60.0)))


ADDITIVE = ("nb_trips", "nb_passengers", "distance_miles", "duration_seconds", "fare_amount",
            "tip_amount", "tolls_amount", "surcharges_amount", "total_amount")


def reconcile(cube: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per measure: cube total, detail total, difference (must be 0)."""
    cube_tot = cube.agg(*[F.sum(c).alias(c) for c in ADDITIVE])
    detail_tot = analysed(fact).agg(*cube_measures())
    stack = lambda df, side: df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias(side)) for c in ADDITIVE
    ])).alias("m")).select("m.*")
    return (stack(cube_tot, "cube_total").join(stack(detail_tot, "detail_total"), "measure")
            .withColumn("difference", F.col("cube_total") - F.col("detail_total")))


# ---- upkeep by difference --------------------------------------------------------------
# Cells are additive, so a changed month is the old cells plus a signed difference. A sum of only NULLs is NULL, which
# adding can't undo; each nullable sum so carries the number of values it has seen.

NULLABLE = tuple(c for c in ADDITIVE if c != "nb_trips")
_INPUT = {"nb_passengers": "passenger_count", "distance_miles": "trip_distance", "duration_seconds": "trip_duration_seconds",
          "fare_amount": "fare_amount", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount", "total_amount": "total_amount"}


def seen(measure: str) -> str:
    return f"seen_{measure}"


def build_cells(fact: DataFrame, *keep: str) -> DataFrame:
    """Cube cells in the form that can be added and retracted (``keep``: further columns that the grain determines)."""
    surcharges = F.col("extra") + F.col("mta_tax") + F.col("improvement_surcharge")
    value = lambda m: surcharges if m == "surcharges_amount" else F.col(_INPUT[m])
    return analysed(fact).groupBy(*keep, *CUBE_GRAIN).agg(*cube_measures(), *[F.count(value(m)).alias(seen(m)) for m in NULLABLE])


def _added(rows: DataFrame, keys: list[str], types: dict) -> DataFrame:
    """Sums by ``keys``, in the types of a single cell."""
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in _CELL])


_CELL = (*ADDITIVE, *map(seen, NULLABLE))


def difference(new: DataFrame, old: DataFrame, *keep: str) -> DataFrame:
    """Signed cells that turn ``old`` into ``new``: only cells with a measure or a count that differs."""
    keys, types = [*keep, *CUBE_GRAIN], {f.name: f.dataType for f in new.schema}
    signed = lambda df, sign: df.select(*keys, *[(F.coalesce(F.col(c), F.lit(0)) * sign).cast(types[c]).alias(c) for c in _CELL])
    delta = _added(signed(new, 1).unionByName(signed(old, -1)), keys, types)
    return delta.filter(F.greatest(*[F.abs(F.col(c)).cast("double") for c in _CELL]) > 0)


def merge_cells(parts: DataFrame, *keep: str) -> DataFrame:
    """One cell per grain from base cells and differences; cells without trips are gone."""
    keys, types = [*keep, *CUBE_GRAIN], {f.name: f.dataType for f in parts.schema}
    return _added(parts, keys, types).filter(F.col("nb_trips") != 0)


def as_cube(cells: DataFrame) -> DataFrame:
    """Cells as the published cube."""
    rows = cells.withColumns({m: F.when(F.col(seen(m)) != 0, F.col(m)) for m in NULLABLE})
    return rows.drop(*map(seen, NULLABLE)).withColumn("duration_minutes", F.col("duration_seconds") / F.lit(60.0))
