"""Calendar and concentration analyses on the `events` table.

Events stand in for trips with a second shape: every hour, many keys (users). The same operators run: pre-aggregation by (date, hour), the
calendar join, and the two-level running share over many keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.measures import n_rows, ratio
from ..operators.pareto import threshold_counts
from ..sources.fixture import event_trips
from .analyses import concentration_sql
from .catalog import register
from .oracle import day_name_sql, event_prelude


def _event_sql(body: str) -> str:
    return f"WITH {event_prelude().strip()},\n{body.strip()}"


@register("event_demand_by_hour_day", lambda: _event_sql(f"""
SELECT CAST(isodow(pickup_ts) AS INTEGER) AS day_of_week, {day_name_sql("pickup_ts")} AS day_name,
       CAST(hour(pickup_ts) AS INTEGER) AS hour,
       COUNT(*) AS nb_events, COUNT(DISTINCT d) AS observed_days,
       CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT d) AS DOUBLE), 0) AS avg_events
FROM event_days WHERE NOT is_holiday
GROUP BY 1, 2, 3"""))
def event_demand_by_hour_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean events per weekday x hour over ordinary days that have events in the cell."""
    e = event_trips(spark, sf_dir).withColumn("date", F.to_date("pickup_ts")).withColumn("hour", F.hour("pickup_ts"))
    per = e.groupBy("date", "hour").agg(n_rows().alias("n"))
    # the calendar of whatever days the data has: weekday and rule-built holidays
    cells = per.filter(~R.january_holiday("date")).select(
        "hour", "n", R.iso_day_of_week("date").alias("day_of_week"), R.day_name("date").alias("day_name"))
    return (cells.groupBy("day_of_week", "day_name", "hour")
                 .agg(F.sum("n").alias("nb_events"), n_rows().alias("observed_days"))
                 .withColumn("avg_events", ratio("nb_events", "observed_days")))


@register("user_concentration", lambda: _event_sql(
    concentration_sql("event_trips", "location_id", "amount", "users")))
def user_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users make 50 % / 80 % of the value: running share over many keys."""
    per_user = event_trips(spark, sf_dir).groupBy("location_id").agg(F.sum("amount").alias("value"))
    return threshold_counts(per_user, "value", (0.5, 0.8), "users")
