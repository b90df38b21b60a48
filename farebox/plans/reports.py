"""Reported findings as queries (the numbers quoted in the written synthesis).

All start from the analysed trips, aggregate first, and derive the headline
ratio from the aggregated rows (a handful of rows per report).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.measures import dbl, minutes, n_rows, per_minute, ratio, trip_sums
from .analyses import demand_by_hour_day, productivity, trips_by_date
from ..operators.joins import broadcast_if_small
from .catalog import register
from .common import RULES, cells, dim_date, dim_zone, lake, rules, s_min, s_per_min, s_ratio, trips
from .measures import gap_sql, gap_vs_selection_df, sliced_star
from .oracle import _ids, _q, with_prelude

AIRPORT, INTRA = RULES.category_labels[0], RULES.category_labels[1]
AIRPORTS = list(RULES.airport_zone_ids)
SQL_RPM = s_per_min("SUM(total_amount)", "SUM(trip_duration_seconds)")
# Candidate thresholds for calibrating the "amount" anomaly rule.
AMOUNT_THRESHOLDS = (250, 500, 750, 1000, 1250, 1500)


# R1 -------------------------------------------------------------------------
@register("core_productivity_by_hour", lambda: with_prelude(f"""
SELECT hour, COUNT(*) AS nb_trips, {SQL_RPM} AS revenue_per_min,
       CAST(SUM(trip_distance) AS DOUBLE) / NULLIF(CAST(SUM(trip_duration_seconds) AS DOUBLE) / 60.0 / 60.0, 0)
         AS avg_speed_mph,
       {s_ratio("SUM(total_amount)", "COUNT(*)")} AS avg_basket
FROM trips WHERE trip_category = {_q(INTRA)} GROUP BY hour"""))
def core_productivity_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Productivity by hour inside the core borough only (removes the mix effect)."""
    intra = rules(spark, sf_dir).category_labels[1]
    return productivity(cells(spark, sf_dir).filter(F.col("trip_category") == intra), "hour")


# R2 -------------------------------------------------------------------------
def _airport_detail_sql() -> str:
    return with_prelude(f"""
a AS (
  SELECT CASE WHEN pickup_location_id IN ({_ids(AIRPORTS)}) THEN pickup_location_id
              ELSE dropoff_location_id END AS airport_id, *
  FROM trips WHERE trip_category = {_q(AIRPORT)})
SELECT a.airport_id, z.zone AS airport_zone, COUNT(*) AS nb_trips,
       {s_ratio("SUM(a.total_amount)", "COUNT(*)")} AS avg_basket,
       {s_per_min("SUM(a.total_amount)", "SUM(a.trip_duration_seconds)")} AS revenue_per_min,
       {s_min("SUM(a.trip_duration_seconds)")} / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS avg_duration_min
FROM a LEFT JOIN dim_zone z ON a.airport_id = z.location_id
GROUP BY a.airport_id, z.zone""")


@register("airport_detail", _airport_detail_sql)
def airport_detail(spark: SparkSession, sf_dir: str, attribution: str = "either") -> DataFrame:
    """Per airport. ``attribution="either"``: a trip counts for its pickup airport,
    else its dropoff airport; ``"pickup"``: only trips picked up at an airport."""
    r = rules(spark, sf_dir)
    airports = list(r.airport_zone_ids)
    t = trips(spark, sf_dir).filter(F.col("trip_category") == r.category_labels[0])
    if attribution == "pickup":
        t = t.filter(F.col("pickup_location_id").isin(airports))
    elif attribution != "either":
        raise ValueError(f"attribution must be 'either' or 'pickup', not {attribution!r}")
    aid = F.when(F.col("pickup_location_id").isin(airports), F.col("pickup_location_id")) \
           .otherwise(F.col("dropoff_location_id"))
    g = t.groupBy(aid.alias("airport_id")).agg(*trip_sums())
    z = dim_zone(spark, sf_dir).select(F.col("location_id").alias("airport_id"), F.col("zone").alias("airport_zone"))
    return (g.join(broadcast_if_small(z), "airport_id", "left")
             .select("airport_id", "airport_zone", "nb_trips", ratio("_rev", "nb_trips").alias("avg_basket"),
                     per_minute("_rev", "_secs").alias("revenue_per_min"),
                     F.try_divide(minutes("_secs"), dbl("nb_trips")).alias("avg_duration_min")))


# R3 / R11: airport versus core -------------------------------------------------
def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: airport and core components side by side (one pass)."""
    cat = F.col("trip_category")
    labels = rules(spark, sf_dir).category_labels
    a = cat == labels[0]
    i = cat == labels[1]
    n = F.col("nb_trips")
    return cells(spark, sf_dir).agg(
        F.coalesce(F.sum(F.when(a, n)), F.lit(0)).alias("a_n"),
        F.sum(F.when(a, F.col("total_amount"))).alias("a_rev"),
        F.sum(F.when(a, F.col("duration_seconds"))).alias("a_secs"),
        F.coalesce(F.sum(F.when(i, n)), F.lit(0)).alias("c_n"),
        F.sum(F.when(i, F.col("total_amount"))).alias("c_rev"),
        F.sum(F.when(i, F.col("duration_seconds"))).alias("c_secs"))


SEG_SQL = f"""
seg AS (
  SELECT COUNT(*) FILTER (WHERE trip_category = {_q(AIRPORT)}) AS a_n,
         SUM(total_amount) FILTER (WHERE trip_category = {_q(AIRPORT)}) AS a_rev,
         SUM(trip_duration_seconds) FILTER (WHERE trip_category = {_q(AIRPORT)}) AS a_secs,
         COUNT(*) FILTER (WHERE trip_category = {_q(INTRA)}) AS c_n,
         SUM(total_amount) FILTER (WHERE trip_category = {_q(INTRA)}) AS c_rev,
         SUM(trip_duration_seconds) FILTER (WHERE trip_category = {_q(INTRA)}) AS c_secs
  FROM trips)"""


@register("airport_breakeven_wait", lambda: with_prelude(f"""{SEG_SQL}
SELECT {s_ratio("a_rev", "a_n")} AS airport_basket,
       {s_per_min("c_rev", "c_secs")} AS core_revenue_per_min,
       {s_min("a_secs")} / NULLIF(CAST(a_n AS DOUBLE), 0) AS airport_avg_duration_min,
       ({s_ratio("a_rev", "a_n")}) / NULLIF({s_per_min("c_rev", "c_secs")}, 0)
         - {s_min("a_secs")} / NULLIF(CAST(a_n AS DOUBLE), 0) AS breakeven_wait_min
FROM seg"""))
def airport_breakeven_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of waiting after which an airport trip earns less per minute than core work."""
    s = _segments(spark, sf_dir)
    basket = ratio("a_rev", "a_n")
    core_rpm = per_minute("c_rev", "c_secs")
    dur = F.try_divide(minutes("a_secs"), dbl("a_n"))
    return s.select(basket.alias("airport_basket"), core_rpm.alias("core_revenue_per_min"),
                    dur.alias("airport_avg_duration_min"),
                    (F.try_divide(basket, core_rpm) - dur).alias("breakeven_wait_min"))


@register("segment_gap", lambda: with_prelude(f"""{SEG_SQL}
SELECT {s_per_min("a_rev", "a_secs")} AS airport_revenue_per_min,
       {s_per_min("c_rev", "c_secs")} AS core_revenue_per_min,
       ({s_per_min("a_rev", "a_secs")}) / NULLIF({s_per_min("c_rev", "c_secs")}, 0) - 1 AS segment_gap
FROM seg"""))
def segment_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _segments(spark, sf_dir)
    a, c = per_minute("a_rev", "a_secs"), per_minute("c_rev", "c_secs")
    return s.select(a.alias("airport_revenue_per_min"), c.alias("core_revenue_per_min"),
                    (F.try_divide(a, c) - F.lit(1)).alias("segment_gap"))


# R4 -------------------------------------------------------------------------
NIGHT_END_HOUR = 3
WEEKEND_DAYS = (6, 7)
WEEKNIGHT_DAYS = (1, 2, 3, 4)


@register("weekend_night_ratio", lambda: with_prelude(f"""
n AS (
  SELECT d.day_of_week, t.date_id FROM trips t JOIN dim_date d ON t.date_id = d.date_id
  WHERE NOT d.is_holiday AND t.hour < {NIGHT_END_HOUR}),
s AS (
  SELECT CAST(COUNT(*) FILTER (WHERE day_of_week IN ({_ids(WEEKEND_DAYS)})) AS DOUBLE)
           / NULLIF(CAST(COUNT(DISTINCT date_id) FILTER (WHERE day_of_week IN ({_ids(WEEKEND_DAYS)})) AS DOUBLE), 0) AS we,
         CAST(COUNT(*) FILTER (WHERE day_of_week IN ({_ids(WEEKNIGHT_DAYS)})) AS DOUBLE)
           / NULLIF(CAST(COUNT(DISTINCT date_id) FILTER (WHERE day_of_week IN ({_ids(WEEKNIGHT_DAYS)})) AS DOUBLE), 0) AS wk
  FROM n)
SELECT we AS weekend_night_trips_per_day, wk AS weeknight_trips_per_day, we / NULLIF(wk, 0) AS weekend_night_ratio
FROM s"""))
def weekend_night_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Night trips (0h to 3h) per ordinary day: Saturday/Sunday over Monday-Thursday."""
    cal = dim_date(spark, sf_dir).filter(~F.col("is_holiday")).select("date_id", "day_of_week")
    night = cells(spark, sf_dir).filter(F.col("hour") < NIGHT_END_HOUR)
    per_date = night.groupBy("date_id").agg(F.sum("nb_trips").alias("n")).join(F.broadcast(cal), "date_id")
    we = F.col("day_of_week").isin(list(WEEKEND_DAYS))
    wk = F.col("day_of_week").isin(list(WEEKNIGHT_DAYS))
    a = per_date.agg(F.sum(F.when(we, F.col("n"))).alias("we_n"), F.count_if(we).alias("we_d"),
                     F.sum(F.when(wk, F.col("n"))).alias("wk_n"), F.count_if(wk).alias("wk_d"))
    we_v, wk_v = ratio("we_n", "we_d"), ratio("wk_n", "wk_d")
    return a.select(we_v.alias("weekend_night_trips_per_day"), wk_v.alias("weeknight_trips_per_day"),
                    F.try_divide(we_v, wk_v).alias("weekend_night_ratio"))


# R5 -------------------------------------------------------------------------
@register("peak_trough", lambda: with_prelude(f"""
cell AS (
  SELECT d.day_of_week, d.day_name, t.hour,
         CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT d.date_id) AS DOUBLE), 0) AS avg_trips
  FROM trips t JOIN dim_date d ON t.date_id = d.date_id WHERE NOT d.is_holiday
  GROUP BY d.day_of_week, d.day_name, t.hour),
pk AS (SELECT * FROM cell ORDER BY avg_trips DESC, day_of_week, hour LIMIT 1),
tr AS (SELECT * FROM cell ORDER BY avg_trips ASC, day_of_week, hour LIMIT 1)
SELECT pk.day_of_week AS peak_day_of_week, pk.day_name AS peak_day_name, pk.hour AS peak_hour,
       pk.avg_trips AS peak_avg_trips, tr.day_of_week AS trough_day_of_week, tr.day_name AS trough_day_name,
       tr.hour AS trough_hour, tr.avg_trips AS trough_avg_trips,
       pk.avg_trips / NULLIF(tr.avg_trips, 0) AS peak_to_trough
FROM pk, tr"""))
def peak_trough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busiest and quietest weekday x hour cells (ties: earliest day, then hour)."""
    cells = demand_by_hour_day(spark, sf_dir)
    dow, hr = F.col("day_of_week"), F.col("hour")
    rec = F.struct("day_of_week", "day_name", "hour", "avg_trips")
    a = cells.agg(F.max_by(rec, F.struct(F.col("avg_trips"), -dow, -hr)).alias("pk"),
                  F.min_by(rec, F.struct(F.col("avg_trips"), dow, hr)).alias("tr"))
    return a.select(
        F.col("pk.day_of_week").alias("peak_day_of_week"), F.col("pk.day_name").alias("peak_day_name"),
        F.col("pk.hour").alias("peak_hour"), F.col("pk.avg_trips").alias("peak_avg_trips"),
        F.col("tr.day_of_week").alias("trough_day_of_week"), F.col("tr.day_name").alias("trough_day_name"),
        F.col("tr.hour").alias("trough_hour"), F.col("tr.avg_trips").alias("trough_avg_trips"),
        F.try_divide(F.col("pk.avg_trips"), F.col("tr.avg_trips")).alias("peak_to_trough"))


# R6 -------------------------------------------------------------------------
@register("holiday_effect", lambda: with_prelude("""
daily AS (
  SELECT d.date, d.day_of_week, d.day_name, d.is_holiday, d.holiday_name, COUNT(*) AS n
  FROM trips t JOIN dim_date d ON t.date_id = d.date_id
  GROUP BY d.date, d.day_of_week, d.day_name, d.is_holiday, d.holiday_name),
ordinary AS (
  SELECT day_of_week, CAST(SUM(n) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS mean_trips
  FROM daily WHERE NOT is_holiday GROUP BY day_of_week)
SELECT h.date, h.holiday_name, h.day_name, h.n AS holiday_trips, o.mean_trips AS same_weekday_mean_trips,
       CAST(h.n AS DOUBLE) / NULLIF(o.mean_trips, 0) - 1 AS holiday_effect
FROM daily h LEFT JOIN ordinary o ON h.day_of_week = o.day_of_week
WHERE h.is_holiday"""))
def holiday_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips on each holiday against the mean of ordinary days of the same weekday."""
    daily = trips_by_date(cells(spark, sf_dir)).join(F.broadcast(dim_date(spark, sf_dir)), "date_id")
    ordinary = (daily.filter(~F.col("is_holiday")).groupBy("day_of_week")
                     .agg(ratio(F.sum("n"), n_rows()).alias("same_weekday_mean_trips")))
    hol = daily.filter(F.col("is_holiday"))
    return (hol.join(F.broadcast(ordinary), "day_of_week", "left")
               .select("date", "holiday_name", "day_name", F.col("n").alias("holiday_trips"),
                       "same_weekday_mean_trips",
                       (F.try_divide(dbl("n"), F.col("same_weekday_mean_trips")) - F.lit(1)).alias("holiday_effect")))


# R7 -------------------------------------------------------------------------
@register("weekday_gap", lambda: with_prelude("""
w AS (
  SELECT d.day_name, d.day_of_week,
         CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT d.date_id) AS DOUBLE), 0) AS trips_per_day
  FROM trips t JOIN dim_date d ON t.date_id = d.date_id WHERE NOT d.is_holiday
  GROUP BY d.day_name, d.day_of_week)
SELECT day_name, day_of_week, trips_per_day, trips_per_day / NULLIF(MAX(trips_per_day) OVER (), 0) - 1 AS gap_vs_busiest
FROM w"""))
def weekday_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .analyses import activity_by_weekday
    w = activity_by_weekday(spark, sf_dir)
    best = F.max("trips_per_day").over(Window.partitionBy())   # seven rows
    return w.select("day_name", "day_of_week", "trips_per_day",
                    (F.try_divide(F.col("trips_per_day"), best) - F.lit(1)).alias("gap_vs_busiest"))


# R8 -------------------------------------------------------------------------
@register("productivity_drop", lambda: with_prelude(f"""
h AS (SELECT hour, {SQL_RPM} AS rpm FROM trips GROUP BY hour),
b AS (SELECT hour, rpm FROM h ORDER BY rpm DESC, hour LIMIT 1),
w AS (SELECT hour, rpm FROM h ORDER BY rpm ASC, hour LIMIT 1)
SELECT b.hour AS best_hour, b.rpm AS best_revenue_per_min, w.hour AS worst_hour, w.rpm AS worst_revenue_per_min,
       1 - w.rpm / NULLIF(b.rpm, 0) AS productivity_drop
FROM b, w"""))
def productivity_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = productivity(cells(spark, sf_dir), "hour")
    rpm, hr = F.col("revenue_per_min"), F.col("hour")
    a = h.agg(F.max_by(F.struct("hour", "revenue_per_min"), F.struct(rpm, -hr)).alias("b"),
              F.min_by(F.struct("hour", "revenue_per_min"), F.struct(rpm, hr)).alias("w"))
    return a.select(F.col("b.hour").alias("best_hour"), F.col("b.revenue_per_min").alias("best_revenue_per_min"),
                    F.col("w.hour").alias("worst_hour"), F.col("w.revenue_per_min").alias("worst_revenue_per_min"),
                    (F.lit(1) - F.try_divide(F.col("w.revenue_per_min"), F.col("b.revenue_per_min")))
                    .alias("productivity_drop"))


# R9 -------------------------------------------------------------------------
@register("rejects_by_vendor", lambda: with_prelude("""
g AS (SELECT vendor_id, reject_reason, COUNT(*) AS n FROM staged GROUP BY vendor_id, reject_reason),
t AS (SELECT vendor_id, reject_reason, n,
             SUM(n) OVER (PARTITION BY vendor_id) AS vendor_raw,
             SUM(n) OVER (PARTITION BY reject_reason) AS reason_total
      FROM g)
SELECT vendor_id, reject_reason, n AS nb_rejected,
       CAST(n AS DOUBLE) / NULLIF(CAST(reason_total AS DOUBLE), 0) AS share_of_reason,
       CAST(n AS DOUBLE) / NULLIF(CAST(vendor_raw AS DOUBLE), 0) AS share_of_vendor_raw
FROM t WHERE reject_reason IS NOT NULL"""))
def rejects_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which vendor produces each reject reason, and how much of its own raw volume."""
    g = (lake(spark, sf_dir).table("staged").groupBy("vendor_id", "reject_reason")
         .agg(n_rows().alias("n")))          # vendors x reasons rows
    g = g.withColumns({"vendor_raw": F.sum("n").over(Window.partitionBy("vendor_id")),
                       "reason_total": F.sum("n").over(Window.partitionBy("reject_reason"))})
    return g.filter(F.col("reject_reason").isNotNull()).select(
        "vendor_id", "reject_reason", F.col("n").alias("nb_rejected"),
        ratio("n", "reason_total").alias("share_of_reason"),
        ratio("n", "vendor_raw").alias("share_of_vendor_raw"))


# R10 ------------------------------------------------------------------------
@register("airport_share_by_hour", lambda: with_prelude(f"""
SELECT hour, COUNT(*) AS nb_trips, COUNT(*) FILTER (WHERE trip_category = {_q(AIRPORT)}) AS airport_trips,
       {s_ratio(f"COUNT(*) FILTER (WHERE trip_category = {_q(AIRPORT)})", "COUNT(*)")} AS airport_share
FROM trips GROUP BY hour"""))
def airport_share_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("trip_category") == rules(spark, sf_dir).category_labels[0]
    g = sliced_star(spark, sf_dir).groupBy("hour").agg(
        F.sum("nb_trips").alias("nb_trips"), F.sum(F.when(a, F.col("nb_trips"))).alias("airport_trips"))
    return g.select("hour", "nb_trips", F.coalesce("airport_trips", F.lit(0)).alias("airport_trips"),
                    ratio(F.coalesce("airport_trips", F.lit(0)), "nb_trips").alias("airport_share"))


# R12 ------------------------------------------------------------------------
def _outliers_sql() -> str:
    th = ", ".join(f"({t})" for t in AMOUNT_THRESHOLDS)
    return with_prelude(f"""
th AS (SELECT CAST(t AS INTEGER) AS threshold FROM (VALUES {th}) v(t)),
s AS (SELECT total_amount, trip_distance FROM silver_trips)
SELECT th.threshold,
       COUNT(s.total_amount) AS nb_trips_above,
       CAST(COUNT(s.total_amount) AS DOUBLE) / NULLIF(CAST((SELECT COUNT(*) FROM silver_trips) AS DOUBLE), 0)
         AS share_above,
       CAST(SUM(s.trip_distance) AS DOUBLE) / NULLIF(CAST(COUNT(s.total_amount) AS DOUBLE), 0) AS avg_distance_above
FROM th LEFT JOIN s ON s.total_amount > th.threshold
GROUP BY th.threshold""")


@register("amount_outliers", _outliers_sql)
def amount_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of valid trips above each candidate amount threshold (one pass)."""
    s = lake(spark, sf_dir).table("silver_trips")
    aggs = [n_rows().alias("all")]
    for t in AMOUNT_THRESHOLDS:
        above = F.col("total_amount") > F.lit(t)
        aggs += [F.count_if(above).alias(f"n{t}"), F.sum(F.when(above, F.col("trip_distance"))).alias(f"d{t}")]
    a = s.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"n{t}").alias("nb_trips_above"),
                 ratio(f"n{t}", "all").alias("share_above"), ratio(f"d{t}", f"n{t}").alias("avg_distance_above"))
        for t in AMOUNT_THRESHOLDS]))
    return a.select(rows.alias("r")).select("r.*")


TOP_AMOUNTS = 20


@register("amount_top", lambda: with_prelude(f"""
SELECT trip_ref, vendor_id, pickup_ts, CAST(total_amount AS DOUBLE) AS total_amount, trip_distance,
       trip_duration_minutes
FROM silver_trips
ORDER BY total_amount DESC, trip_ref, pickup_ts, dropoff_ts, vendor_id, pu_location_id, do_location_id
LIMIT {TOP_AMOUNTS}"""))
def amount_top(spark: SparkSession, sf_dir: str, k: int = TOP_AMOUNTS) -> DataFrame:
    """The largest totals with their distance and duration (top-k is the feature)."""
    s = lake(spark, sf_dir).table("silver_trips")
    return (s.orderBy(F.col("total_amount").desc(), "trip_ref", "pickup_ts", "dropoff_ts", "vendor_id",
                      "pu_location_id", "do_location_id").limit(k)
             .select("trip_ref", "vendor_id", "pickup_ts", dbl("total_amount").alias("total_amount"),
                     "trip_distance", "trip_duration_minutes"))


# R13 ------------------------------------------------------------------------
@register("hour_gap_vs_mean", lambda: with_prelude(gap_sql("hour")))
def hour_gap_vs_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per minute of each hour against the whole selection (M11 by hour)."""
    return gap_vs_selection_df(sliced_star(spark, sf_dir), "hour", rules(spark, sf_dir))


