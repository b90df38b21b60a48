"""Queries that expose each pipeline layer and rule on its own.

Row-level outputs publish money as DOUBLE converted from the exact DECIMAL
columns (one conversion, no arithmetic), so both engines print the same value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.measures import dbl, n_rows
from ..operators import cube, star
from ..operators.joins import null_safe_anti
from ..sources.schemas import MONEY_COLUMNS
from .catalog import register
from .common import dim_date, dim_payment, dim_zone, fact, lake, rules
from .oracle import band_case, slot_case, with_prelude

TRIP_OUT = ("vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance",
            "pu_location_id", "do_location_id", "payment_type", "fare_amount", "extra", "mta_tax",
            "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "trip_ref")


def _money_out(df: DataFrame, cols=MONEY_COLUMNS) -> DataFrame:
    return df.withColumns({c: dbl(c) for c in cols if c in df.columns})


def _money_sql(cols) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLUMNS else c for c in cols)


# B2 trip metrics ------------------------------------------------------------
METRIC_COLS = ("trip_ref", "vendor_id", "pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id",
               "trip_duration_seconds", "trip_duration_minutes", "avg_speed_mph", "pickup_hour", "pickup_dow")


@register("trip_metrics", lambda: with_prelude(f"SELECT {', '.join(METRIC_COLS)} FROM silver_trips"))
def trip_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).table("silver_trips").select(*METRIC_COLS)


# B3-B5, D10 validity -----------------------------------------------------------
@register("reject_reasons", lambda: with_prelude(
    "SELECT reject_reason, COUNT(*) AS nb_trips FROM staged WHERE reject_reason IS NOT NULL GROUP BY reject_reason"))
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rej = lake(spark, sf_dir).table("staged").filter(F.col("status") == "rejected")
    return rej.groupBy("reject_reason").agg(n_rows().alias("nb_trips"))


@register("valid_trips", lambda: with_prelude(
    f"SELECT {_money_sql(TRIP_OUT)} FROM staged WHERE reject_reason IS NULL"))
def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = lake(spark, sf_dir).table("staged")
    return _money_out(staged.filter(F.col("status") == "valid").select(*TRIP_OUT))


@register("rejected_trips", lambda: with_prelude(
    f"SELECT {_money_sql(TRIP_OUT)}, reject_reason FROM staged WHERE reject_reason IS NOT NULL"))
def rejected_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = lake(spark, sf_dir).table("staged")
    return _money_out(staged.filter(F.col("status") == "rejected").select(*TRIP_OUT, "reject_reason"))


# D11 dedup -------------------------------------------------------------------
DEDUP_OUT = TRIP_OUT + ("duplicates_removed",)


@register("dedup_trips", lambda: with_prelude(f"SELECT {_money_sql(DEDUP_OUT)} FROM silver_trips"))
def dedup_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_out(lake(spark, sf_dir).table("silver_trips").select(*DEDUP_OUT))


# C1-C2 enrichment --------------------------------------------------------------
ENRICH_OUT = ("trip_ref", "vendor_id", "pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id",
              "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


@register("enrich_zones", lambda: with_prelude(f"SELECT {', '.join(ENRICH_OUT)} FROM silver_trips"))
def enrich_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).table("silver_trips").select(*ENRICH_OUT)


# B6-B9 segmentation counts -----------------------------------------------------
@register("trip_category", lambda: with_prelude(
    "SELECT trip_category, COUNT(*) AS nb_trips FROM fact_trips GROUP BY trip_category"))
def trip_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).groupBy("trip_category").agg(n_rows().alias("nb_trips"))


@register("distance_band", lambda: with_prelude(
    f"SELECT {band_case()} AS distance_band, COUNT(*) AS nb_trips FROM silver_trips GROUP BY 1"))
def distance_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lake(spark, sf_dir).table("silver_trips")
    return s.groupBy(R.distance_band().alias("distance_band")).agg(n_rows().alias("nb_trips"))


@register("time_slot", lambda: with_prelude(
    f"SELECT {slot_case('pickup_hour')} AS time_slot, COUNT(*) AS nb_trips FROM silver_trips GROUP BY 1"))
def time_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lake(spark, sf_dir).table("silver_trips")
    return s.groupBy(R.time_slot("pickup_hour").alias("time_slot")).agg(n_rows().alias("nb_trips"))


@register("anomaly_reasons", lambda: with_prelude(
    "SELECT anomaly_reason, COUNT(*) AS nb_trips FROM fact_trips WHERE anomaly_reason IS NOT NULL GROUP BY 1"))
def anomaly_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fact(spark, sf_dir).filter(F.col("anomaly_reason").isNotNull())
    return f.groupBy("anomaly_reason").agg(n_rows().alias("nb_trips"))


# Dimensions, each with its use by the analysed trips ----------------------------------
# A dimension row is listed whether or not trips reference it (left join from
# the dimension; 0 when unused). Counts are aggregated before the join, so the
# join sees one row per member on both sides.
def _usage(dim: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    return (dim.join(counts, key, "left")
               .withColumn("nb_trips", F.coalesce(F.col("nb_trips"), F.lit(0).cast("bigint"))))


def _usage_sql(dim: str, key: str, fact_key: str | None = None, source: str = "trips") -> str:
    fk = fact_key or key
    return with_prelude(f"""
SELECT d.*, COALESCE(c.nb_trips, 0) AS nb_trips
FROM {dim} d LEFT JOIN (SELECT {fk} AS k, COUNT(*) AS nb_trips FROM {source} GROUP BY {fk}) c ON d.{key} = c.k""")


def _cube_counts(spark: SparkSession, sf_dir: str, key: str, as_key: str | None = None) -> DataFrame:
    c = lake(spark, sf_dir).table("trip_cube").groupBy(key).agg(F.sum("nb_trips").alias("nb_trips"))
    return c.withColumnRenamed(key, as_key) if as_key else c


@register("dim_date", lambda: _usage_sql("dim_date", "date_id"))
def dim_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(dim_date(spark, sf_dir), "date_id", _cube_counts(spark, sf_dir, "date_id"))


@register("dim_hour", lambda: _usage_sql("dim_hour", "hour"))
def dim_hour_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(star.dim_hour(spark), "hour", _cube_counts(spark, sf_dir, "hour"))


@register("dim_zone", lambda: _usage_sql("dim_zone", "location_id", "pickup_location_id"))
def dim_zone_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(dim_zone(spark, sf_dir), "location_id",
                  _cube_counts(spark, sf_dir, "pickup_location_id", "location_id"))


@register("dim_payment", lambda: _usage_sql("dim_payment", "payment_type"))
def dim_payment_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(dim_payment(spark, sf_dir), "payment_type", _cube_counts(spark, sf_dir, "payment_type"))


@register("dim_vendor", lambda: _usage_sql("dim_vendor", "vendor_id"))
def dim_vendor_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    # vendor is not a cube key: counted on the analysed fact
    counts = (fact(spark, sf_dir).filter(F.col("anomaly_reason").isNull())
              .groupBy("vendor_id").agg(n_rows().alias("nb_trips")))
    return _usage(star.dim_vendor(spark, rules(spark, sf_dir)), "vendor_id", counts)


# Fact and cube ---------------------------------------------------------------------
FACT_MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
              "improvement_surcharge", "total_amount")


@register("fact_trips", lambda: with_prelude(f"SELECT {_money_sql(star.FACT_COLUMNS)} FROM fact_trips"))
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_out(fact(spark, sf_dir).select(*star.FACT_COLUMNS), FACT_MONEY)


CUBE_MONEY = ("fare_amount", "tip_amount", "tolls_amount", "surcharges_amount", "total_amount")


def _cube_sql() -> str:
    g = ", ".join(cube.CUBE_GRAIN)
    return with_prelude(f"""
SELECT {g}, COUNT(*) AS nb_trips,
       CAST(SUM(CAST(passenger_count AS BIGINT)) AS BIGINT) AS nb_passengers,
       SUM(trip_distance) AS distance_miles,
       CAST(SUM(trip_duration_seconds) AS BIGINT) AS duration_seconds,
       CAST(SUM(fare_amount) AS DOUBLE) AS fare_amount,
       CAST(SUM(tip_amount) AS DOUBLE) AS tip_amount,
       CAST(SUM(tolls_amount) AS DOUBLE) AS tolls_amount,
       CAST(SUM(extra + mta_tax + improvement_surcharge) AS DOUBLE) AS surcharges_amount,
       CAST(SUM(total_amount) AS DOUBLE) AS total_amount,
       CAST(SUM(trip_duration_seconds) AS DOUBLE) / 60.0 AS duration_minutes
FROM trips GROUP BY {g}""")


@register("trip_cube", _cube_sql)
def trip_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = lake(spark, sf_dir).table("trip_cube")
    return c.withColumns({m: dbl(m) for m in CUBE_MONEY}).withColumn(
        "duration_minutes", dbl("duration_seconds") / F.lit(60.0))


def _recon_sql() -> str:
    parts = []
    for m, expr in (("nb_trips", "COUNT(*)"), ("nb_passengers", "SUM(passenger_count)"),
                    ("distance_miles", "SUM(trip_distance)"), ("duration_seconds", "SUM(trip_duration_seconds)"),
                    ("fare_amount", "SUM(fare_amount)"), ("tip_amount", "SUM(tip_amount)"),
                    ("tolls_amount", "SUM(tolls_amount)"),
                    ("surcharges_amount", "SUM(extra + mta_tax + improvement_surcharge)"),
                    ("total_amount", "SUM(total_amount)")):
        parts.append(f"SELECT '{m}' AS measure, CAST({expr} AS DOUBLE) AS cube_total, "
                     f"CAST({expr} AS DOUBLE) AS detail_total, 0.0::DOUBLE AS difference FROM trips")
    return with_prelude("\nUNION ALL\n".join(parts))


@register("cube_reconciliation", _recon_sql)
def cube_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = lake(spark, sf_dir)
    return cube.reconcile(lk.table("trip_cube"), lk.table("fact_trips"))


# A4 deterministic sample ------------------------------------------------------------
# Fixed values of the portable sample hash (multipliers and modulus).
SAMPLE_MULT_REF = 2654435761
SAMPLE_MULT_SECONDS = 40503
SAMPLE_MULT_CENTS = 9176
SAMPLE_REF_MODULUS = 2147483647      # keeps 64-bit content hashes within range when multiplied
SAMPLE_BUCKETS = 10000
SAMPLE_KEEP = 1000          # 10 %


def _portable_hash() -> "F.Column":
    """Integer hash of (trip_ref, pickup second, total cents): the same value in
    any engine and any session time zone (so the sample can be checked), stable
    under retries and repartitioning. ``sources.ingest.hash_sample`` (xxhash64)
    is the default elsewhere."""
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("pickup_ts"))
    cents = F.floor(F.col("total_amount") * 100).cast("bigint")
    return F.pmod(F.pmod(F.col("trip_ref"), F.lit(SAMPLE_REF_MODULUS)) * SAMPLE_MULT_REF + secs * SAMPLE_MULT_SECONDS + cents * SAMPLE_MULT_CENTS,
                  F.lit(SAMPLE_BUCKETS))


@register("sample_hash", lambda: with_prelude(f"""
SELECT {_money_sql(TRIP_OUT)} FROM staged
WHERE (((trip_ref % {SAMPLE_REF_MODULUS} + {SAMPLE_REF_MODULUS}) % {SAMPLE_REF_MODULUS} * {SAMPLE_MULT_REF}
        + date_diff('second', TIMESTAMP '1970-01-01 00:00:00', pickup_ts) * {SAMPLE_MULT_SECONDS}
        + CAST(FLOOR(total_amount * 100) AS BIGINT) * {SAMPLE_MULT_CENTS}) % {SAMPLE_BUCKETS} + {SAMPLE_BUCKETS})
      % {SAMPLE_BUCKETS} < {SAMPLE_KEEP}"""))
def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 10 % sample of the staged rows chosen by the rows' keys (the sample is the
    feature): the same rows on every run."""
    staged = lake(spark, sf_dir).table("staged")
    return _money_out(staged.filter(_portable_hash() < SAMPLE_KEEP).select(*TRIP_OUT))


# A8 load audit, from the data itself ---------------------------------------------------
@register("load_audit", lambda: with_prelude("""
SELECT source_file, COUNT(*) AS row_count,
       COUNT(*) FILTER (WHERE reject_reason IS NULL) AS valid_rows,
       COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_rows
FROM staged GROUP BY source_file"""))
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source file: rows loaded, valid and quarantined (the audit log's
    content, recomputed from the staged table rather than trusted)."""
    st = lake(spark, sf_dir).table("staged")
    return st.groupBy("source_file").agg(
        n_rows().alias("row_count"),
        F.count_if(F.col("status") == "valid").alias("valid_rows"),
        F.count_if(F.col("status") == "rejected").alias("rejected_rows"))


# C8 load units that have given no trip yet ---------------------------------------------------
@register("ingest_pending", lambda: with_prelude("""
SELECT l.vendor_id, l.pickup_date, l.raw_rows
FROM (SELECT vendor_id, CAST(pickup_ts AS DATE) AS pickup_date, COUNT(*) AS raw_rows FROM staged GROUP BY ALL) l
WHERE NOT EXISTS (SELECT 1 FROM silver_trips s WHERE s.vendor_id IS NOT DISTINCT FROM l.vendor_id
                  AND CAST(s.pickup_ts AS DATE) IS NOT DISTINCT FROM l.pickup_date)"""))
def ingest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor days of the raw trips that are pending: none of their rows has become a trip, so they are to be asked for
    again. The gate of the file ingest as a query: a null-safe anti-join of what is listed with what is done (a vendor or
    day that is missing is a unit like any other)."""
    lk, day = lake(spark, sf_dir), F.to_date("pickup_ts").alias("pickup_date")
    listed = lk.table("staged").groupBy("vendor_id", day).agg(n_rows().alias("raw_rows"))
    done = lk.table("silver_trips").select("vendor_id", day).distinct()
    return null_safe_anti(listed, done, ["vendor_id", "pickup_date"])
