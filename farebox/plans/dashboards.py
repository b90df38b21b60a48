"""Dashboard visuals: each visual is one grouped query over the sliced star.

Visuals that reuse another query: KPI cards = ``measures_total``; category
bars = ``share_of_selection``; trips and revenue/min by hour =
``productivity_by_hour``; top-10 zones = ``top10_zone_revenue``; revenue/min
by category = ``trip_category_mix``; by band = ``distance_band_economics``;
card tip rate by category = ``card_tips_by_category``; quality cards =
``quality_measures``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.measures import dbl, per_minute, ratio
from ..operators.days import distinct_days
from .catalog import register
from .common import lake, rules, s_ratio, with_totals
from .measures import components, evaluate_by, grouped_star, sliced_star, sql_evaluate
from .oracle import _q, slot_case, with_prelude

HOURS = list(range(24))


# V2 revenue line ------------------------------------------------------------------
@register("revenue_by_date", lambda: with_prelude(
    "SELECT d.date, CAST(SUM(t.total_amount) AS DOUBLE) AS revenue "
    "FROM trips t JOIN dim_date d ON t.date_id = d.date_id GROUP BY d.date"))
def revenue_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = grouped_star(spark, sf_dir, ("date",), [F.sum("total_amount").alias("rev")])
    return s.select("date", dbl("rev").alias("revenue"))


# V4 pivot heatmap: weekday x hour of trips per ordinary day -------------------------
def _heatmap_sql() -> str:
    cells = ",\n       ".join(
        f"MAX(CASE WHEN hour = {h} THEN avg_trips END) AS h{h:02d}" for h in HOURS)
    return with_prelude(f"""
cell AS (
  SELECT d.day_of_week, d.day_name, t.hour,
         CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT t.date_id) AS DOUBLE), 0) AS avg_trips
  FROM trips t JOIN dim_date d ON t.date_id = d.date_id
  WHERE NOT d.is_holiday
  GROUP BY d.day_of_week, d.day_name, t.hour)
SELECT day_of_week, day_name,
       {cells}
FROM cell GROUP BY day_of_week, day_name""")


@register("demand_heatmap", _heatmap_sql)
def demand_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordinary = lake(spark, sf_dir).table("day_states").filter(~F.col("is_holiday"))
    cell = (ordinary.groupBy("day_of_week", "day_name", "hour")
                    .agg(F.sum("nb_trips").alias("n"), distinct_days(rules(spark, sf_dir)).alias("days"))
                    .withColumn("avg_trips", ratio("n", "days")))
    # explicit pivot values: no extra job to discover them, fixed 24 columns
    p = cell.groupBy("day_of_week", "day_name").pivot("hour", HOURS).agg(F.first("avg_trips"))
    return p.select("day_of_week", "day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


# V7 revenue per minute by time slot -------------------------------------------------
@register("revenue_per_min_by_slot", lambda: with_prelude(
    f"SELECT {slot_case('hour')} AS time_slot, "
    "CAST(SUM(total_amount) AS DOUBLE) / NULLIF(CAST(SUM(trip_duration_seconds) AS DOUBLE) / 60.0, 0) "
    "AS revenue_per_min FROM trips GROUP BY 1"))
def revenue_per_min_by_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_by(spark, sf_dir, ("time_slot",), ("revenue_per_min",))


# V9 zone scatter / V10 zone detail / V11 borough treemap ----------------------------
ZONE_SQL_SRC = "trips t JOIN dim_zone z ON t.pickup_location_id = z.location_id"


@register("zone_scatter", lambda: with_prelude(sql_evaluate(
    ("z.zone", "z.borough"), ("trips", "revenue_per_min", "revenue"), source=ZONE_SQL_SRC)))
def zone_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_by(spark, sf_dir, ("zone", "borough"), ("trips", "revenue_per_min", "revenue"))


@register("zone_detail", lambda: with_prelude(f"""
SELECT z.zone, z.borough, COUNT(*) AS trips, CAST(SUM(t.total_amount) AS DOUBLE) AS revenue,
       {s_ratio("SUM(t.total_amount)", "SUM(SUM(t.total_amount)) OVER ()")} AS revenue_share,
       {s_ratio("SUM(t.total_amount)", "COUNT(*)")} AS avg_basket,
       CAST(SUM(t.total_amount) AS DOUBLE) / NULLIF(CAST(SUM(t.trip_duration_seconds) AS DOUBLE) / 60.0, 0)
         AS revenue_per_min
FROM {ZONE_SQL_SRC} GROUP BY z.zone, z.borough"""))
def zone_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grouped_star(spark, sf_dir, ("zone", "borough"), components(rules(spark, sf_dir)))
    g = with_totals(g, "rev")
    return g.select("zone", "borough", F.col("n").alias("trips"), dbl("rev").alias("revenue"),
                    ratio("rev", "rev_total").alias("revenue_share"), ratio("rev", "n").alias("avg_basket"),
                    per_minute("rev", "secs").alias("revenue_per_min"))


@register("borough_revenue", lambda: with_prelude(sql_evaluate(("z.borough",), ("revenue",), source=ZONE_SQL_SRC)))
def borough_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_by(spark, sf_dir, ("borough",), ("revenue",))


# V15 payment mix -------------------------------------------------------------------
@register("payment_mix", lambda: with_prelude(
    "SELECT p.payment_label, COUNT(*) AS trips FROM trips t "
    "LEFT JOIN dim_payment p ON t.payment_type = p.payment_type GROUP BY p.payment_label"))
def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_by(spark, sf_dir, ("payment_label",), ("trips",))


# V17 exclusions by reason / V18 funnel detail ------------------------------------------
@register("exclusions_by_reason", lambda: with_prelude(
    "SELECT reason, category, CAST(SUM(nb_trips) AS BIGINT) AS rejects_and_anomalies FROM data_quality "
    f"WHERE category IN ({_q(C.FUNNEL_CAT_REJECT)}, {_q(C.FUNNEL_CAT_ANOMALY)}) GROUP BY reason, category"))
def exclusions_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lake(spark, sf_dir).table("data_quality").filter(
        F.col("category").isin(C.FUNNEL_CAT_REJECT, C.FUNNEL_CAT_ANOMALY))
    return q.groupBy("reason", "category").agg(F.sum("nb_trips").alias("rejects_and_anomalies"))


@register("funnel_detail", lambda: with_prelude(
    "SELECT step, reason, CAST(SUM(nb_trips) AS BIGINT) AS trips, "
    "CAST(SUM(nb_trips) AS DOUBLE) / NULLIF(CAST((SELECT SUM(nb_trips) FROM data_quality "
    f"WHERE category = {_q(C.FUNNEL_CAT_INPUT)}) AS DOUBLE), 0) AS pct_of_raw "
    "FROM data_quality GROUP BY step, reason"))
def funnel_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per step and reason with their share of the raw rows (share of the
    summed counts: exact whatever the number of rows per group)."""
    q = lake(spark, sf_dir).table("data_quality")
    raw = q.filter(F.col("category") == C.FUNNEL_CAT_INPUT).agg(F.sum("nb_trips")).scalar()
    return (q.groupBy("step", "reason").agg(F.sum("nb_trips").alias("trips"))
             .withColumn("pct_of_raw", ratio(F.col("trips"), raw)))


# Several visuals' cuts in one pass: grouping sets over the cube -------------------------
CUTS = ("hour", "trip_category", "distance_band", "payment_type", "pickup_location_id")


def _cuts_sql() -> str:
    cut = " ".join(f"WHEN GROUPING({c}) = 0 THEN '{c}'" for c in CUTS)
    sets = ", ".join(f"({c})" for c in CUTS)
    return with_prelude(f"""
SELECT CASE {cut} END AS cut, {", ".join(CUTS)},
       COUNT(*) AS trips, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(total_amount) AS DOUBLE) / NULLIF(CAST(SUM(trip_duration_seconds) AS DOUBLE) / 60.0, 0)
         AS revenue_per_min
FROM trips GROUP BY GROUPING SETS ({sets})""")


@register("dashboard_cuts", _cuts_sql)
def dashboard_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, revenue and revenue/minute by hour, category, band, payment and zone:
    one scan of the cube and one shuffle (Expand + aggregate) for all five cuts."""
    s = sliced_star(spark, sf_dir)
    cut = None
    for c in CUTS:
        cut = F.when(F.grouping(c) == 0, F.lit(c)) if cut is None else cut.when(F.grouping(c) == 0, F.lit(c))
    g = s.groupingSets([[c] for c in CUTS], *CUTS).agg(
        F.sum("nb_trips").alias("trips"), F.sum("total_amount").alias("rev"),
        F.sum("duration_seconds").alias("secs"), cut.alias("cut"))
    return g.select("cut", *CUTS, "trips", dbl("rev").alias("revenue"),
                    per_minute("rev", "secs").alias("revenue_per_min"))
