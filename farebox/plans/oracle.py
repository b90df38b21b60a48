"""Independent SQL statement of the same pipeline, for DuckDB.

The oracle re-derives everything from the driver tables with plain SQL
(window ``row_number`` for dedup where Spark uses an aggregate, CASE text for
the rules, ``generate_series`` for the calendar), so a bug in one engine's
plan does not hide in the other. Parameters come from the same ``TripRules``.
"""

from __future__ import annotations

from .. import config as C
from ..config import FIXTURE_RULES, TripRules
from ..sources import fixture as X


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(pairs, otherwise=None) -> str:
    body = " ".join(f"WHEN {p} THEN {_q(l)}" for p, l in pairs)
    tail = f" ELSE {_q(otherwise)}" if otherwise is not None else ""
    return f"CASE {body}{tail} END"


def _ids(xs) -> str:
    return ", ".join(str(int(x)) for x in xs) or "NULL"


def reject_case() -> str:
    return _case([
        ("pu_location_id IS NULL OR do_location_id IS NULL", C.REJECT_ZONE_MISSING),
        ("pickup_ts IS NULL OR dropoff_ts IS NULL", C.REJECT_TIME_MISSING),
        ("dropoff_ts <= pickup_ts", C.REJECT_DROPOFF_BEFORE_PICKUP),
        ("trip_distance IS NULL OR trip_distance <= 0", C.REJECT_DISTANCE),
        ("fare_amount IS NULL OR fare_amount <= 0", C.REJECT_FARE),
        ("passenger_count IS NULL OR passenger_count <= 0", C.REJECT_NO_PASSENGER),
    ])


def category_case(r: TripRules) -> str:
    a, intra, cross, out = r.category_labels
    core = _q(r.core_borough)
    return _case([
        (f"pu_location_id IN ({_ids(r.airport_zone_ids)}) OR do_location_id IN ({_ids(r.airport_zone_ids)})", a),
        (f"pickup_borough = {core} AND dropoff_borough = {core}", intra),
        (f"pickup_borough = {core} OR dropoff_borough = {core}", cross),
    ], out)


def band_case(col: str = "trip_distance") -> str:
    L = C.DISTANCE_BAND_LABELS
    return _case([(f"{col} < {e}", L[i]) for i, e in enumerate(C.DISTANCE_BAND_EDGES)], L[-1])


def slot_case(col: str = "hour") -> str:
    L = C.TIME_SLOT_LABELS
    return _case([(f"{col} < {e}", L[i]) for i, e in enumerate(C.TIME_SLOT_EDGES)], L[-1])


def anomaly_case(r: TripRules) -> str:
    return _case([
        (f"pickup_ts < TIMESTAMP '{r.period_start}' OR pickup_ts >= TIMESTAMP '{r.period_end}'", C.ANOMALY_PERIOD),
        (f"total_amount > {r.max_total_amount}", C.ANOMALY_AMOUNT),
        (f"trip_duration_seconds > 0 AND trip_distance * 3600.0 > CAST({r.max_speed_mph} AS DOUBLE) * trip_duration_seconds",
         C.ANOMALY_SPEED),
        (f"trip_duration_seconds > {r.max_duration_min * 60}", C.ANOMALY_LONG),
        (f"trip_duration_seconds < {r.min_duration_min * 60}", C.ANOMALY_SHORT),
    ])


def day_name_sql(col: str) -> str:
    names = ", ".join(_q(n) for n in C.DAY_NAMES)
    return f"([{names}])[isodow({col})]"


def date_id_sql(col: str) -> str:
    return f"CAST(year({col}) * 10000 + month({col}) * 100 + day({col}) AS INTEGER)"


def money(units: str) -> str:
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * CAST('{X.MICRO}' AS DECIMAL(7,6)) AS DECIMAL(18,6))"


def prelude(r: TripRules = FIXTURE_RULES) -> str:
    """CTEs: raw_trips, staged, silver_trips, fact_trips, trips, dims, data_quality."""
    holidays = r.holiday_rows()
    hol_case = _case([(f"d = DATE '{d}'", n) for d, n in holidays]) if holidays else "CAST(NULL AS VARCHAR)"
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in r.dedup_order)
    rest = ("rate_code_id", "store_and_fwd_flag", "extra", "mta_tax", "tolls_amount",
            "improvement_surcharge", "congestion_surcharge", "source_file")
    order_rest = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    keys = ", ".join(r.dedup_keys)
    pay_rows = ", ".join(f"({k}, {_q(v)})" for k, v in sorted(r.payment_labels.items()))
    ven_rows = ", ".join(f"({k}, {_q(v)})" for k, v in sorted(r.vendor_labels.items()))
    return f"""
base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_returnflag,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax,
         (l.l_partkey * {X.PICKUP_OFFSET_PART_MULT} + l.l_orderkey * {X.PICKUP_OFFSET_ORDER_MULT}) % {X.SECONDS_PER_DAY} AS off,
         (l.l_orderkey * {X.DURATION_ORDER_MULT} + l.l_partkey * {X.DURATION_PART_MULT}) % {X.DURATION_MODULUS} - {X.DURATION_SHIFT} AS dur,
         o.o_orderdate, o.o_orderpriority, s.s_nationkey, c.c_nationkey
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
trips0 AS (
  SELECT CAST(l_suppkey % {X.VENDOR_MODULUS} + 1 AS INTEGER) AS vendor_id,
         o_orderdate + to_seconds(off) AS pickup_ts,
         o_orderdate + to_seconds(off + dur) AS dropoff_ts,
         CAST((l_orderkey + l_partkey) % {X.PASSENGER_MODULUS} AS INTEGER) AS passenger_count,
         (l_quantity - 1) / 2 AS trip_distance,
         CAST(1 AS INTEGER) AS rate_code_id,
         'N' AS store_and_fwd_flag,
         CAST(s_nationkey AS INTEGER) AS pu_location_id,
         CAST(c_nationkey AS INTEGER) AS do_location_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         {money(f"CASE WHEN l_returnflag = 'R' AND l_quantity > {X.REFUND_MIN_QUANTITY} THEN -cents * 100 ELSE cents * 100 END")} AS fare_amount,
         CAST(0 AS DECIMAL(18,6)) AS extra,
         {money("cents * tax")} AS mta_tax,
         {money("cents * disc")} AS tip_amount,
         CAST(0 AS DECIMAL(18,6)) AS tolls_amount,
         CAST(0 AS DECIMAL(18,6)) AS improvement_surcharge,
         {money("cents * (100 + disc + tax)")} AS total_amount,
         CAST(0 AS DECIMAL(18,6)) AS congestion_surcharge,
         l_orderkey AS trip_ref
  FROM base
),
raw_trips AS (
  SELECT *, 'fixture' AS source_file FROM (
    SELECT * FROM trips0
    UNION ALL SELECT * FROM trips0 WHERE trip_ref % {X.COPY_MODULUS} = 0
    UNION ALL SELECT * REPLACE (CAST(tip_amount + 1 AS DECIMAL(18,6)) AS tip_amount,
                                CAST(total_amount + 1 AS DECIMAL(18,6)) AS total_amount)
              FROM trips0 WHERE trip_ref % {X.COPY_MODULUS} = 0
    UNION ALL SELECT * REPLACE (CAST(NULL AS INTEGER) AS pu_location_id)
              FROM trips0 WHERE trip_ref % {X.MISSING_ZONE_MODULUS} = 0
    UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS pickup_ts)
              FROM trips0 WHERE trip_ref % {X.MISSING_TIME_MODULUS} = 0
  )
),
staged AS (
  SELECT *, {reject_case()} AS reject_reason FROM raw_trips
),
ranked AS (
  SELECT * EXCLUDE (reject_reason),
         row_number() OVER (PARTITION BY {keys} ORDER BY {order}, {order_rest}) AS rn,
         count(*) OVER (PARTITION BY {keys}) - 1 AS duplicates_removed
  FROM staged WHERE reject_reason IS NULL
),
zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, r.r_name AS borough, n.n_name AS zone,
         CASE WHEN n.n_nationkey IN ({_ids(r.airport_zone_ids)}) THEN 'Airports'
              WHEN r.r_name = {_q(r.core_borough)} THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
deduped AS (
  SELECT * EXCLUDE (rn), date_diff('second', pickup_ts, dropoff_ts) AS trip_duration_seconds
  FROM ranked WHERE rn = 1
),
silver_trips AS (
  SELECT d.*,
         d.trip_duration_seconds / CAST(60.0 AS DOUBLE) AS trip_duration_minutes,
         CASE WHEN d.trip_duration_seconds > 0
              THEN d.trip_distance / ((d.trip_duration_seconds / CAST(60.0 AS DOUBLE)) / CAST(60.0 AS DOUBLE)) END AS avg_speed_mph,
         CAST(hour(d.pickup_ts) AS INTEGER) AS pickup_hour,
         CAST(isodow(d.pickup_ts) AS INTEGER) AS pickup_dow,
         pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
  FROM deduped d
  LEFT JOIN zones pz ON d.pu_location_id = pz.location_id
  LEFT JOIN zones dz ON d.do_location_id = dz.location_id
),
fact_trips AS (
  SELECT {date_id_sql("pickup_ts")} AS date_id,
         pickup_hour AS hour,
         pickup_ts AS pickup_datetime, dropoff_ts AS dropoff_datetime,
         pu_location_id AS pickup_location_id, do_location_id AS dropoff_location_id,
         vendor_id, payment_type, passenger_count, trip_distance,
         trip_duration_minutes, avg_speed_mph, fare_amount, extra, mta_tax, tip_amount,
         tolls_amount, improvement_surcharge, total_amount,
         {category_case(r)} AS trip_category,
         {band_case()} AS distance_band,
         {anomaly_case(r)} AS anomaly_reason,
         trip_duration_seconds, pickup_dow AS day_of_week, duplicates_removed, trip_ref
  FROM silver_trips
),
trips AS (
  SELECT * FROM fact_trips WHERE anomaly_reason IS NULL
),
dim_date AS (
  SELECT {date_id_sql("d")} AS date_id, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         CAST(isodow(d) AS INTEGER) AS day_of_week, {day_name_sql("d")} AS day_name,
         isodow(d) >= 6 AS is_weekend,
         ({hol_case}) IS NOT NULL AS is_holiday,
         {hol_case} AS holiday_name,
         CAST(weekofyear(d) AS INTEGER) AS iso_week
  FROM (SELECT CAST(g AS DATE) AS d
        FROM generate_series(DATE '{r.period_start}', DATE '{r.period_end}' - INTERVAL 1 DAY, INTERVAL 1 DAY) t(g))
),
dim_hour AS (
  SELECT CAST(h AS INTEGER) AS hour, printf('%02dh', h) AS hour_label, {slot_case("h")} AS time_slot
  FROM range(24) t(h)
),
dim_zone AS (
  SELECT location_id, borough, zone, service_zone,
         location_id IN ({_ids(r.airport_zone_ids)}) AS is_airport
  FROM zones
),
dim_payment AS (
  SELECT CAST(payment_type AS INTEGER) AS payment_type, payment_label
  FROM (VALUES {pay_rows}) t(payment_type, payment_label)
),
dim_vendor AS (
  SELECT CAST(vendor_id AS INTEGER) AS vendor_id, vendor_name
  FROM (VALUES {ven_rows}) t(vendor_id, vendor_name)
),
funnel_rows AS (
  SELECT 1 AS step_order, {_q(C.FUNNEL_STEP_INPUT)} AS step, {_q(C.FUNNEL_CAT_INPUT)} AS category,
         {_q(C.FUNNEL_REASON_INPUT)} AS reason, COUNT(*) AS nb_trips FROM staged
  UNION ALL
  SELECT 2, {_q(C.FUNNEL_STEP_CLEAN)}, {_q(C.FUNNEL_CAT_REJECT)}, reject_reason, COUNT(*)
  FROM staged WHERE reject_reason IS NOT NULL GROUP BY reject_reason
  UNION ALL
  SELECT 2, {_q(C.FUNNEL_STEP_CLEAN)}, {_q(C.FUNNEL_CAT_REJECT)}, {_q(C.FUNNEL_REASON_DUPLICATE)},
         (SELECT COUNT(*) FROM staged WHERE reject_reason IS NULL) - (SELECT COUNT(*) FROM fact_trips)
  UNION ALL
  SELECT 3, {_q(C.FUNNEL_STEP_QUALITY)}, {_q(C.FUNNEL_CAT_ANOMALY)}, anomaly_reason, COUNT(*)
  FROM fact_trips WHERE anomaly_reason IS NOT NULL GROUP BY anomaly_reason
  UNION ALL
  SELECT 4, {_q(C.FUNNEL_STEP_OUTPUT)}, {_q(C.FUNNEL_CAT_OUTPUT)}, {_q(C.FUNNEL_REASON_OUTPUT)}, COUNT(*)
  FROM trips
),
data_quality AS (
  SELECT CAST(step_order AS INTEGER) AS step_order, step, category, reason,
         CAST(nb_trips AS BIGINT) AS nb_trips,
         CAST(nb_trips AS DOUBLE) / CAST((SELECT COUNT(*) FROM staged) AS DOUBLE) AS pct_of_raw
  FROM funnel_rows
)"""


def event_prelude() -> str:
    hol = ("(month(pickup_ts) = 1 AND (day(pickup_ts) = 1 "
           "OR (isodow(pickup_ts) = 1 AND day(pickup_ts) >= 15 AND day(pickup_ts) < 22)))")
    return f"""
event_trips AS (
  SELECT event_id, ts AS pickup_ts, user_id AS location_id, event_type AS category,
         CAST(CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS amount
  FROM events
),
event_days AS (
  SELECT *, CAST(pickup_ts AS DATE) AS d, ({hol}) AS is_holiday FROM event_trips
)"""


def with_prelude(body: str, r: TripRules = FIXTURE_RULES, extra: str = "") -> str:
    """Prefix a query with the pipeline CTEs (and optional extra CTE text)."""
    ctes = prelude(r).strip() + ("," + extra.strip().rstrip(",") if extra.strip() else "")
    body = body.strip()
    if body.upper().startswith("SELECT") or body.upper().startswith("("):
        return f"WITH {ctes}\n{body}"
    return f"WITH {ctes},\n{body}"
