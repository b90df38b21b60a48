"""Semantic layer: the dashboard measures as aggregate Columns over the cube.

Filter-context rules (the ones the BI model relies on):

* slicers filter the dimensions, and the filtered dimensions restrict the
  facts (join after filtering the dim; facts never filter dims);
* a "total over the selection" keeps the slicers but drops the visual's own
  grouping: it is computed from the already-grouped rows (bounded by the
  grouping domain), never by re-scanning the detail;
* a measure that pins a column (e.g. category = airport) replaces any filter
  or grouping on that same column and keeps all others;
* every ratio is SUM/SUM of exact components; division by 0 or NULL is NULL.

Queries read the additive cube when the requested keys are cube keys or
attributes of the dimensions joined to them; anything else reads the fact.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import TripRules
from ..functions.measures import dbl, minutes, mph, n_rows, per_minute, ratio
from ..operators import cube as cube_ops
from ..operators import star
from ..operators.joins import broadcast_if_small
from ..operators.pareto import ranked_keys
from .catalog import register
from .common import (RULES, dim_date, dim_payment, dim_zone, lake, rules, s_min, s_mph, s_per_min, s_ratio,
                     with_totals)
from .lake import MONTH
from .oracle import _q, with_prelude

# Stand-in rule values used by the SQL oracles (Spark code takes them from the lake).
CARD = RULES.card_payment_type
AIRPORT = RULES.category_labels[0]

DATE_ATTRS = ("date", "year", "month", "day", "day_of_week", "day_name", "is_weekend", "is_holiday",
              "holiday_name", "iso_week")
ZONE_ATTRS = ("zone", "borough", "service_zone", "is_airport")
HOUR_ATTRS = ("hour_label", "time_slot")
PAY_ATTRS = ("payment_label",)


@dataclass(frozen=True)
class Slicers:
    """The report's slicers: date range, categories, payment labels, weekdays."""

    date_from: str | None = None
    date_to: str | None = None
    categories: tuple[str, ...] | None = None
    payment_labels: tuple[str, ...] | None = None
    weekdays: tuple[int, ...] | None = None

    def date_filter(self) -> Column | None:
        c = None
        if self.date_from:
            c = F.col("date") >= F.lit(self.date_from).cast("date")
        if self.date_to:
            e = F.col("date") <= F.lit(self.date_to).cast("date")
            c = e if c is None else c & e
        if self.weekdays:
            e = F.col("day_of_week").isin(list(self.weekdays))
            c = e if c is None else c & e
        return c


NO_SLICERS = Slicers()


def sliced_star(spark: SparkSession, sf_dir: str, needed: tuple[str, ...] = (),
                slicers: Slicers = NO_SLICERS, source: DataFrame | None = None) -> DataFrame:
    """Cube rows restricted by the slicers, with the dimension attributes asked for.

    Each dimension is filtered first and then joined (broadcast: one row per
    day / zone / hour / payment code); a dimension that is neither sliced nor
    needed is not joined at all.
    """
    f = source if source is not None else route_source(spark, sf_dir, needed)
    if slicers.categories:
        f = f.filter(F.col("trip_category").isin(list(slicers.categories)))
    # the date range also as a direct predicate on the integer key: it reaches
    # the scan (row-group statistics) instead of hiding behind the calendar join
    if slicers.date_from:
        f = f.filter(F.col("date_id") >= int(slicers.date_from.replace("-", "")))
    if slicers.date_to:
        f = f.filter(F.col("date_id") <= int(slicers.date_to.replace("-", "")))
    # a source that lies by months is read for the months of the range only (partition filters)
    if set(MONTH) <= set(f.columns):
        month = F.col(MONTH[0]) * 100 + F.col(MONTH[1])
        for text, keep in ((slicers.date_from, month.__ge__), (slicers.date_to, month.__le__)):
            if text:
                f = f.filter(keep(int(text.replace("-", "")[:6])))
    need = set(needed)
    dfilter = slicers.date_filter()
    if dfilter is not None or need & set(DATE_ATTRS):
        d = dim_date(spark, sf_dir)
        if dfilter is not None:
            d = d.filter(dfilter)
        d = d.select("date_id", *[c for c in DATE_ATTRS if c in need or c in ("date", "day_of_week")])
        f = f.join(F.broadcast(d), "date_id", "inner" if dfilter is not None else "left")
    if slicers.payment_labels or need & set(PAY_ATTRS):
        p = dim_payment(spark, sf_dir)
        if slicers.payment_labels:
            p = p.filter(F.col("payment_label").isin(list(slicers.payment_labels)))
        f = f.join(F.broadcast(p), "payment_type", "inner" if slicers.payment_labels else "left")
    if need & set(ZONE_ATTRS):
        z = dim_zone(spark, sf_dir).select(F.col("location_id").alias("pickup_location_id"),
                                           *[c for c in ZONE_ATTRS if c in need])
        f = f.join(broadcast_if_small(z), "pickup_location_id", "left")
    if need & set(HOUR_ATTRS):
        h = star.dim_hour(spark).select("hour", *[c for c in HOUR_ATTRS if c in need])
        f = f.join(F.broadcast(h), "hour", "left")
    return f


# Additive components of the measures (sums over cube rows).
def components(r: TripRules = RULES) -> list[Column]:
    card = F.col("payment_type") == r.card_payment_type
    airport = r.category_labels[0]
    return [
        F.sum("nb_trips").alias("n"),
        F.sum("total_amount").alias("rev"),
        F.sum("duration_seconds").alias("secs"),
        F.sum("distance_miles").alias("dist"),
        F.sum(F.when(card, F.col("nb_trips"))).alias("card_n"),
        F.sum(F.when(card, F.col("tip_amount"))).alias("card_tip"),
        F.sum(F.when(card, F.col("fare_amount"))).alias("card_fare"),
        F.sum(F.when(F.col("trip_category") == airport, F.col("total_amount"))).alias("air_rev"),
    ]


# Measure name -> Column over the components.
MEASURES = {
    "trips": lambda: F.col("n"),                                     # M1
    "revenue": lambda: dbl("rev"),                                   # M2
    "avg_basket": lambda: ratio("rev", "n"),                         # M5
    "minutes": lambda: minutes("secs"),                              # M6
    "revenue_per_min": lambda: per_minute("rev", "secs"),            # M7
    "avg_duration_min": lambda: F.try_divide(minutes("secs"), dbl("n")),  # M8
    "avg_distance": lambda: ratio("dist", "n"),                      # M9
    "avg_speed_mph": lambda: mph("dist", "secs"),                    # M10
    "airport_revenue": lambda: dbl("air_rev"),                       # M14 (no category grouping)
    "airport_revenue_share": lambda: ratio("air_rev", "rev"),        # M15
    "card_share": lambda: ratio("card_n", "n"),                      # M17
    "card_tip_rate": lambda: ratio("card_tip", "card_fare"),         # M18
}

# Same measures in SQL over trip-grain rows (the oracle side).
SQL_MEASURES = {
    "trips": "COUNT(*)",
    "revenue": "CAST(SUM(total_amount) AS DOUBLE)",
    "avg_basket": s_ratio("SUM(total_amount)", "COUNT(*)"),
    "minutes": s_min("SUM(trip_duration_seconds)"),
    "revenue_per_min": s_per_min("SUM(total_amount)", "SUM(trip_duration_seconds)"),
    "avg_duration_min": f"{s_min('SUM(trip_duration_seconds)')} / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)",
    "avg_distance": s_ratio("SUM(trip_distance)", "COUNT(*)"),
    "avg_speed_mph": s_mph("SUM(trip_distance)", "SUM(trip_duration_seconds)"),
    "airport_revenue": f"CAST(SUM(total_amount) FILTER (WHERE trip_category = {_q(AIRPORT)}) AS DOUBLE)",
    "airport_revenue_share": s_ratio(f"SUM(total_amount) FILTER (WHERE trip_category = {_q(AIRPORT)})",
                                     "SUM(total_amount)"),
    "card_share": s_ratio(f"COUNT(*) FILTER (WHERE payment_type = {CARD})", "COUNT(*)"),
    "card_tip_rate": s_ratio(f"SUM(tip_amount) FILTER (WHERE payment_type = {CARD})",
                             f"SUM(fare_amount) FILTER (WHERE payment_type = {CARD})"),
}


def evaluate(star_df: DataFrame, keys: tuple[str, ...], names: tuple[str, ...], r: TripRules = RULES) -> DataFrame:
    """Group the star by ``keys`` and compute the named measures."""
    g = star_df.groupBy(*keys).agg(*components(r)) if keys else star_df.agg(*components(r))
    return g.select(*keys, *[MEASURES[n]().alias(n) for n in names])


def sql_evaluate(keys: tuple[str, ...], names: tuple[str, ...], source: str = "trips", where: str = "") -> str:
    cols = ", ".join([*keys, *[f"{SQL_MEASURES[n]} AS {n}" for n in names]])
    grp = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {cols} FROM {source}{(' WHERE ' + where) if where else ''}{grp}"


#: The integer key that determines an attribute of a dimension.
KEY_OF = {**dict.fromkeys(DATE_ATTRS, "date_id"), **dict.fromkeys(ZONE_ATTRS, "pickup_location_id"),
          **dict.fromkeys(HOUR_ATTRS, "hour"), **dict.fromkeys(PAY_ATTRS, "payment_type")}


def grouped_star(spark: SparkSession, sf_dir: str, keys: tuple[str, ...], sums: list[Column], slicers: Slicers = NO_SLICERS) -> DataFrame:
    """``sums`` (aliased SUMs) by ``keys``, attributes included, with the grouping below the dimension joins.

    Facts are grouped by the integer keys that determine the attributes, attributes are joined to those few rows, and
    what shares an attribute is added up. A slicer on a dimension restricts the facts before that, as a filter on its key.
    """
    by = tuple(dict.fromkeys(KEY_OF.get(k, k) for k in keys))
    facts = sliced_star(spark, sf_dir, (), slicers)
    grouped = facts.groupBy(*by).agg(*sums)
    attributes = tuple(k for k in keys if k in KEY_OF)
    named = sliced_star(spark, sf_dir, attributes, source=grouped) if attributes else grouped
    again = [c for c in grouped.columns if c not in by]
    return named.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in again])


def evaluate_by(spark: SparkSession, sf_dir: str, keys: tuple[str, ...], names: tuple[str, ...], slicers: Slicers = NO_SLICERS) -> DataFrame:
    """The named measures by ``keys`` (cube keys or attributes of dimensions)."""
    g = grouped_star(spark, sf_dir, keys, components(rules(spark, sf_dir)), slicers)
    return g.select(*keys, *[MEASURES[n]().alias(n) for n in names])


# Components that a measure pins to one value of a column (CALCULATE semantics): the
# pin replaces any slicer and any group key on that very column, and keeps all others.
def _pins(r: TripRules) -> dict[str, tuple[str, object]]:
    airport, card = r.category_labels[0], r.card_payment_type
    return {"air_rev": ("trip_category", airport), "card_n": ("payment_type", card),
            "card_tip": ("payment_type", card), "card_fare": ("payment_type", card)}


PINNED = {"airport_revenue": ("air_rev",), "airport_revenue_share": ("air_rev",), "card_share": ("card_n",),
          "card_tip_rate": ("card_tip", "card_fare")}


def evaluate_sliced(spark: SparkSession, sf_dir: str, keys: tuple[str, ...], names: tuple[str, ...],
                    slicers: Slicers = NO_SLICERS) -> DataFrame:
    """Measures by ``keys`` under ``slicers``. Pinned components come from a star
    without their column's slicer and key, and are joined back on the other keys."""
    r = rules(spark, sf_dir)
    pins = _pins(r)
    out = sliced_star(spark, sf_dir, keys, slicers)
    out = (out.groupBy(*keys) if keys else out).agg(*components(r))
    wanted = {c for n in names for c in PINNED.get(n, ())}
    for column in sorted({pins[c][0] for c in wanted}):
        mine = sorted(c for c in wanted if pins[c][0] == column)
        free = replace(slicers, categories=None) if column == "trip_category" else slicers
        left = tuple(k for k in keys if k != column)
        star_df = sliced_star(spark, sf_dir, left, free).filter(F.col(column) == F.lit(pins[mine[0]][1]))
        sums = (star_df.groupBy(*left) if left else star_df).agg(*components(r))
        pinned = sums.select(*[F.col(k).alias(f"pin_{k}") for k in left], *[F.col(c).alias(f"pin_{c}") for c in mine])
        if left:
            on = [F.col(k).eqNullSafe(F.col(f"pin_{k}")) for k in left]
            out = out.join(pinned, reduce(lambda x, y: x & y, on), "left")
            out = out.withColumns({c: F.col(f"pin_{c}") for c in mine}).drop(*pinned.columns)
        else:                   # one aggregated row
            one = pinned.select(F.struct(*pinned.columns).alias("v")).scalar()
            out = out.withColumns({c: one[f"pin_{c}"] for c in mine})
    return out.select(*keys, *[MEASURES[n]().alias(n) for n in names])


# --- M1, M2, M5-M10, M14, M15, M17, M18: one row ----------------------------------
TOTAL_MEASURES = ("trips", "revenue", "avg_basket", "minutes", "revenue_per_min", "avg_duration_min",
                  "avg_distance", "avg_speed_mph", "airport_revenue", "airport_revenue_share",
                  "card_share", "card_tip_rate")


@register("measures_total", lambda: with_prelude(sql_evaluate((), TOTAL_MEASURES)))
def measures_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(sliced_star(spark, sf_dir), (), TOTAL_MEASURES, rules(spark, sf_dir))


# --- M3 / M4: average trips per visible date ----------------------------------------
def trips_per_day(star_df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """AVERAGEX over visible dates of trips; dates without trips are blank, not zero."""
    per_date = star_df.groupBy(*keys, "date_id").agg(F.sum("nb_trips").alias("n"))
    return (per_date.groupBy(*keys).agg(F.sum("n").alias("nb_trips"), n_rows().alias("nb_dates"))
                    .withColumn("trips_per_day", ratio("nb_trips", "nb_dates")))


@register("trips_per_day", lambda: with_prelude("""
SELECT d.day_of_week, d.day_name, COUNT(*) AS nb_trips, COUNT(DISTINCT t.date_id) AS nb_dates,
       CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT t.date_id) AS DOUBLE), 0) AS trips_per_day
FROM trips t JOIN dim_date d ON t.date_id = d.date_id GROUP BY d.day_of_week, d.day_name"""))
def trips_per_day_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 by weekday."""
    return trips_per_day(sliced_star(spark, sf_dir, ("day_of_week", "day_name")), ("day_of_week", "day_name"))


@register("trips_per_day_excl_holidays", lambda: with_prelude("""
hol AS (SELECT DISTINCT is_holiday FROM dim_date),
ordinary_days AS (
  SELECT COUNT(*) AS nb_trips, COUNT(DISTINCT t.date_id) AS nb_dates
  FROM trips t JOIN dim_date d ON t.date_id = d.date_id WHERE NOT d.is_holiday)
SELECT h.is_holiday, b.nb_trips, b.nb_dates,
       CAST(b.nb_trips AS DOUBLE) / NULLIF(CAST(b.nb_dates AS DOUBLE), 0) AS trips_per_day_excl_holidays
FROM hol h, ordinary_days b"""))
def trips_per_day_excl_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 on a visual grouped by the holiday flag: the measure pins ``is_holiday =
    false``, which replaces the visual's own filter on that column, so every row
    shows the ordinary-day average."""
    s = sliced_star(spark, sf_dir, ("is_holiday",))
    ordinary = trips_per_day(s.filter(~F.col("is_holiday")), ())
    groups = dim_date(spark, sf_dir).select("is_holiday").distinct()
    # `ordinary` is one aggregated row, attached to every group as one scalar subquery.
    v = ordinary.select(F.struct("nb_trips", "nb_dates", "trips_per_day").alias("v")).scalar()
    return groups.select("is_holiday", v["nb_trips"].alias("nb_trips"), v["nb_dates"].alias("nb_dates"),
                         v["trips_per_day"].alias("trips_per_day_excl_holidays"))


# --- M11-M13: shares and gap against the selection ----------------------------------------
@register("share_of_selection", lambda: with_prelude(f"""
SELECT trip_category, COUNT(*) AS trips,
       {s_ratio("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS trips_share,
       CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       {s_ratio("SUM(total_amount)", "SUM(SUM(total_amount)) OVER ()")} AS revenue_share
FROM trips GROUP BY trip_category"""))
def share_of_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = with_totals(sliced_star(spark, sf_dir).groupBy("trip_category").agg(*components(rules(spark, sf_dir))),
                    "n", "rev")
    return g.select("trip_category", F.col("n").alias("trips"), ratio("n", "n_total").alias("trips_share"),
                    dbl("rev").alias("revenue"), ratio("rev", "rev_total").alias("revenue_share"))


def gap_vs_selection_df(star_df: DataFrame, key: str, r: TripRules = RULES) -> DataFrame:
    g = with_totals(star_df.groupBy(key).agg(*components(r)), "rev", "secs")
    sel = per_minute("rev_total", "secs_total")
    return g.select(key, per_minute("rev", "secs").alias("revenue_per_min"),
                    sel.alias("selection_revenue_per_min"),
                    F.try_divide(per_minute("rev", "secs") - sel, sel).alias("gap_vs_selection"))


def gap_sql(key: str) -> str:
    rpm = s_per_min("SUM(total_amount)", "SUM(trip_duration_seconds)")
    sel = s_per_min("SUM(SUM(total_amount)) OVER ()", "SUM(SUM(trip_duration_seconds)) OVER ()")
    return f"""
SELECT {key}, {rpm} AS revenue_per_min, {sel} AS selection_revenue_per_min,
       ({rpm} - {sel}) / NULLIF({sel}, 0) AS gap_vs_selection
FROM trips GROUP BY {key}"""


@register("gap_vs_selection", lambda: with_prelude(gap_sql("trip_category")))
def gap_vs_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 by category."""
    return gap_vs_selection_df(sliced_star(spark, sf_dir), "trip_category", rules(spark, sf_dir))


# --- M14/M15 on a visual grouped by category (the pinned column) --------------------------
@register("airport_revenue_override", lambda: with_prelude(f"""
SELECT trip_category, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(SUM(total_amount) FILTER (WHERE trip_category = {_q(AIRPORT)})) OVER () AS DOUBLE) AS airport_revenue,
       CAST(SUM(SUM(total_amount) FILTER (WHERE trip_category = {_q(AIRPORT)})) OVER () AS DOUBLE)
         / NULLIF(CAST(SUM(total_amount) AS DOUBLE), 0) AS airport_revenue_share
FROM trips GROUP BY trip_category"""))
def airport_revenue_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport measure replaces the category grouping, so each row sees the
    airport total of the selection; the share divides it by the row's revenue."""
    g = with_totals(sliced_star(spark, sf_dir).groupBy("trip_category").agg(*components(rules(spark, sf_dir))),
                    "air_rev")
    return g.select("trip_category", dbl("rev").alias("revenue"), dbl("air_rev_total").alias("airport_revenue"),
                    ratio("air_rev_total", "rev").alias("airport_revenue_share"))


# --- M16: revenue of the top-10 zones (rank over zone names, ties skip) ----------------
@register("top10_zone_revenue", lambda: with_prelude(f"""
z AS (SELECT z.zone, SUM(t.total_amount) AS rev
      FROM trips t JOIN dim_zone z ON t.pickup_location_id = z.location_id GROUP BY z.zone)
SELECT zone, CAST(rev AS DOUBLE) AS revenue, rank() OVER (ORDER BY rev DESC) AS revenue_rank,
       CASE WHEN rank() OVER (ORDER BY rev DESC) <= 10 THEN CAST(rev AS DOUBLE) END AS top10_revenue
FROM z"""))
def top10_zone_revenue(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    g = grouped_star(spark, sf_dir, ("zone",), [F.sum("total_amount").alias("rev")])
    return (ranked_keys(g, "rev").withColumnRenamed("rank", "revenue_rank")
             .select("zone", dbl("rev").alias("revenue"), "revenue_rank",
                     F.when(F.col("revenue_rank") <= k, dbl("rev")).alias("top10_revenue")))


# --- M19-M25: quality measures over the funnel table ----------------------------------------
def _quality_sql() -> str:
    def cat(c):
        return f"SUM(nb_trips) FILTER (WHERE category = {_q(c)})"
    return with_prelude(f"""
SELECT CAST({cat(C.FUNNEL_CAT_INPUT)} AS BIGINT) AS raw_trips,
       CAST({cat(C.FUNNEL_CAT_OUTPUT)} AS BIGINT) AS analysed_trips,
       CAST({cat(C.FUNNEL_CAT_INPUT)} - {cat(C.FUNNEL_CAT_OUTPUT)} AS BIGINT) AS excluded_trips,
       {s_ratio(cat(C.FUNNEL_CAT_OUTPUT), cat(C.FUNNEL_CAT_INPUT))} AS usable_rate,
       CAST(SUM(nb_trips) AS BIGINT) AS funnel_trips,
       CAST(SUM(nb_trips) AS DOUBLE) / NULLIF(CAST({cat(C.FUNNEL_CAT_INPUT)} AS DOUBLE), 0) AS funnel_pct_of_raw,
       CAST(SUM(nb_trips) FILTER (WHERE category IN ({_q(C.FUNNEL_CAT_REJECT)}, {_q(C.FUNNEL_CAT_ANOMALY)})) AS BIGINT)
         AS rejects_and_anomalies
FROM data_quality""")


@register("quality_measures", _quality_sql)
def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lake(spark, sf_dir).table("data_quality")
    cat = F.col("category")
    a = q.agg(
        F.sum(F.when(cat == C.FUNNEL_CAT_INPUT, F.col("nb_trips"))).alias("raw_trips"),
        F.sum(F.when(cat == C.FUNNEL_CAT_OUTPUT, F.col("nb_trips"))).alias("analysed_trips"),
        F.sum("nb_trips").alias("funnel_trips"),

        F.sum(F.when(cat.isin(C.FUNNEL_CAT_REJECT, C.FUNNEL_CAT_ANOMALY), F.col("nb_trips")))
         .alias("rejects_and_anomalies"),
    )
    return a.select("raw_trips", "analysed_trips",
                    (F.col("raw_trips") - F.col("analysed_trips")).alias("excluded_trips"),
                    ratio("analysed_trips", "raw_trips").alias("usable_rate"),
                    # sum of the shares = share of the summed counts (exact integers, one division)
                    "funnel_trips", ratio("funnel_trips", "raw_trips").alias("funnel_pct_of_raw"),
                    "rejects_and_anomalies")


# --- M26: period title from the calendar dimension ---------------------------------------------
@register("period_title", lambda: with_prelude("""
SELECT MIN(d.date) AS first_date, MAX(d.date) AS last_date,
       'Du ' || strftime(MIN(d.date), '%d/%m/%Y') || ' au ' || strftime(MAX(d.date), '%d/%m/%Y') AS period_title,
       (SELECT MIN(date_id) FROM trips) AS first_trip_date_id,
       (SELECT MAX(date_id) FROM trips) AS last_trip_date_id
FROM dim_date d"""))
def period_title(spark: SparkSession, sf_dir: str, slicers: Slicers = NO_SLICERS) -> DataFrame:
    """Title from the calendar of the selection (the dimension, as the report
    does), beside the first and last day that actually has analysed trips."""
    d = dim_date(spark, sf_dir)
    f = slicers.date_filter()
    if f is not None:
        d = d.filter(f)
    a = d.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    seen = (lake(spark, sf_dir).table("trip_cube")
            .agg(F.min("date_id").alias("lo"), F.max("date_id").alias("hi")))
    span = seen.select(F.struct("lo", "hi").alias("s")).scalar()
    return a.select(
        "first_date", "last_date",
        F.concat(F.lit("Du "), F.date_format("first_date", C.PERIOD_TITLE_FORMAT),
                 F.lit(" au "), F.date_format("last_date", C.PERIOD_TITLE_FORMAT)).alias("period_title"),
        span["lo"].alias("first_trip_date_id"), span["hi"].alias("last_trip_date_id"))


# --- C6 / V19: the star under a set of slicers --------------------------------------------
def demo_slicers(r: TripRules) -> Slicers:
    """Second and third fifth of the period, two categories, card, working days."""
    days = r.calendar_days
    return Slicers(date_from=str(r.period_start + dt.timedelta(days=days // 5)),
                   date_to=str(r.period_start + dt.timedelta(days=3 * days // 5)),
                   categories=r.category_labels[:2], payment_labels=(r.payment_labels[r.card_payment_type],),
                   weekdays=(1, 2, 3, 4, 5))


def _slice_sql() -> str:
    s = demo_slicers(RULES)
    cats = ", ".join(_q(c) for c in s.categories)
    pays = ", ".join(_q(p) for p in s.payment_labels)
    days = ", ".join(str(d) for d in s.weekdays)
    body = sql_evaluate(("t.trip_category", "p.payment_label"), ("trips", "revenue", "revenue_per_min"),
                        source="trips t JOIN dim_date d ON t.date_id = d.date_id "
                               "JOIN dim_payment p ON t.payment_type = p.payment_type",
                        where=f"d.date >= DATE '{s.date_from}' AND d.date <= DATE '{s.date_to}' "
                              f"AND d.day_of_week IN ({days}) AND t.trip_category IN ({cats}) "
                              f"AND p.payment_label IN ({pays})")
    return with_prelude(body.replace("t.trip_category, p.payment_label,", "t.trip_category AS trip_category, "
                                     "p.payment_label AS payment_label,", 1))


@register("slice_star", _slice_sql)
def slice_star(spark: SparkSession, sf_dir: str, slicers: Slicers | None = None) -> DataFrame:
    slicers = slicers or demo_slicers(rules(spark, sf_dir))
    s = sliced_star(spark, sf_dir, ("payment_label",), slicers)
    return evaluate(s, ("trip_category", "payment_label"), ("trips", "revenue", "revenue_per_min"),
                    rules(spark, sf_dir))


# --- M14, M15, M17, M18 under category, date and payment slicers ----------------------------
def pin_slicers(r: TripRules) -> Slicers:
    """A category slicer without the airport one, dates, and two payment labels."""
    return replace(demo_slicers(r), categories=r.category_labels[1:3],
                   payment_labels=tuple(r.payment_labels[k] for k in sorted(r.payment_labels)[:2]))


def _pinned_sql() -> str:
    s = pin_slicers(RULES)
    cats, pays = (", ".join(map(_q, x)) for x in (s.categories, s.payment_labels))
    return with_prelude(f"""
seen AS (SELECT t.*, d.day_of_week, t.trip_category IN ({cats}) AS picked, t.payment_type = {CARD} AS by_card
         FROM trips t JOIN dim_date d ON d.date_id = t.date_id JOIN dim_payment p ON p.payment_type = t.payment_type
         WHERE d.date BETWEEN DATE '{s.date_from}' AND DATE '{s.date_to}'
           AND d.day_of_week IN ({", ".join(map(str, s.weekdays))}) AND p.payment_label IN ({pays})),
airport AS (SELECT day_of_week, SUM(total_amount) AS money FROM seen WHERE trip_category = {_q(AIRPORT)} GROUP BY day_of_week),
rest AS (SELECT day_of_week, COUNT(*) AS k, SUM(total_amount) AS money, COUNT(*) FILTER (WHERE by_card) AS card_k,
                SUM(tip_amount) FILTER (WHERE by_card) AS tips, SUM(fare_amount) FILTER (WHERE by_card) AS fares
         FROM seen WHERE picked GROUP BY day_of_week)
SELECT rest.day_of_week, rest.k AS trips, CAST(airport.money AS DOUBLE) AS airport_revenue,
       {s_ratio("airport.money", "rest.money")} AS airport_revenue_share, {s_ratio("rest.card_k", "rest.k")} AS card_share,
       {s_ratio("rest.tips", "rest.fares")} AS card_tip_rate
FROM rest LEFT JOIN airport USING (day_of_week)""")


@register("pinned_measures_sliced", _pinned_sql)
def pinned_measures_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport measures keep their category under a slicer on other categories;
    card measures intersect with a slicer on payment labels."""
    return evaluate_sliced(spark, sf_dir, ("day_of_week",), ("trips", "airport_revenue", "airport_revenue_share", "card_share", "card_tip_rate"),
                           pin_slicers(rules(spark, sf_dir)))


CUBE_REACHABLE = frozenset(cube_ops.CUBE_GRAIN) | frozenset(DATE_ATTRS) | frozenset(ZONE_ATTRS) \
    | frozenset(HOUR_ATTRS) | frozenset(PAY_ATTRS)


def route_source(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> DataFrame:
    """Cube when every key is a cube key or a dimension attribute reachable from
    one; otherwise the analysed fact, shaped like the cube (one trip per row),
    so every measure gives the same value from either source."""
    if set(keys) <= CUBE_REACHABLE:
        return lake(spark, sf_dir).table("trip_cube")
    f = cube_ops.analysed(lake(spark, sf_dir).table("fact_trips"))
    return f.withColumns({
        "nb_trips": F.lit(1).cast("bigint"),
        "distance_miles": F.col("trip_distance"),
        "duration_seconds": F.col("trip_duration_seconds"),
    })
