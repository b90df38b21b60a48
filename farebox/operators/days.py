"""Distinct days that add up: bitmap states beside the cube.

A count of distinct days can't be summed, a set of days can be united. Each state
row holds, for one weekday, holiday flag, hour, category and payment, the trips
and the days on which there were any, as a bitmap of day numbers of the period
(``bitmap_construct_agg``). Any coarser question unites the bitmaps
(``bitmap_or_agg``) and counts bits: exact, in one grouping, without going back
to dates. A bitmap covers 32768 days; a longer period has several per state, told
apart by ``days_block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TripRules

DAY_KEYS = ("day_of_week", "day_name", "is_holiday")
STATE_GRAIN = (*DAY_KEYS, "hour", "trip_category", "payment_type")
#: Bits of one of Spark's bitmaps.
BITS = 8 * 4096


def day_states(cells: DataFrame, calendar: DataFrame, rules: TripRules) -> DataFrame:
    """States of the cube's ``cells``; days outside the calendar are no days of the period."""
    number = F.datediff("date", F.lit(rules.period_start)) + 1
    days = calendar.select("date_id", *DAY_KEYS, F.bitmap_bit_position(number.cast("bigint")).alias("_bit"),
                           F.bitmap_bucket_number(number.cast("bigint")).alias("days_block"))
    # the calendar has one row per day of the period: a broadcast
    return (cells.join(F.broadcast(days), "date_id").groupBy(*STATE_GRAIN, "days_block")
            .agg(F.sum("nb_trips").alias("nb_trips"), F.sum("total_amount").alias("total_amount"), F.bitmap_construct_agg("_bit").alias("days")))


def distinct_days(rules: TripRules) -> Column:
    """The number of distinct days over state rows (an aggregate)."""
    blocks = -(-rules.calendar_days // BITS)
    counts = [F.bitmap_count(F.bitmap_or_agg(F.when(F.col("days_block") == b, F.col("days")))) for b in range(1, blocks + 1)]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total
