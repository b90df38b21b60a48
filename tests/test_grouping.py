"""Ranks over ranges, days as bitmaps, grouping below dimension joins, the null-safe anti-join, the entry guard."""

import datetime as dt
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farebox.config import FIXTURE_RULES, TripRules
from farebox.operators import days, pareto, star
from farebox.operators.joins import null_safe_anti
from farebox.plans import common, measures
from farebox.plans.catalog import all_queries

from .conftest import SF0001


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_ranks_with_ties_and_nulls(spark, ranges):
    rng = random.Random(ranges)
    # a third of all keys share one value
    rows = [(k, None if k % 50 == 0 else 500 if k % 3 == 0 else rng.randint(0, 900)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, value long")
    want = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("value").desc())))
    got = pareto.ranked_keys(df, "value", ranges)
    assert sorted(map(str, got.select("k", "value", "rank").collect())) == sorted(map(str, want.collect()))


def test_no_task_holds_more_than_its_range(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("value"))
    sizes = [r["count"] for r in pareto.by_range(df, "value", 16).groupBy("part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16
    tops = pareto.by_range(df, "value", 4).groupBy("part").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("part").collect()
    assert all(a.lo > b.hi for a, b in zip(tops, tops[1:]))


def test_ranges_grow_with_the_data(spark):
    small, large = spark.range(1000), spark.range(100_000_000)
    assert pareto.ranges_needed(small) == 1 < pareto.ranges_needed(large)


def test_days_unite_over_any_keys(spark):
    """Bitmaps over every subset of the state keys, sliced and not, against distinct dates of the cube."""
    states = common.lake(spark, SF0001).table("day_states")
    cells = common.cells(spark, SF0001).join(star.dim_date(spark, FIXTURE_RULES), "date_id")
    for keys in ((), ("hour",), ("day_of_week", "trip_category"), ("payment_type", "is_holiday", "hour")):
        for where in ("true", "trip_category = 'Intra-ASIA' AND NOT is_holiday"):
            got = states.filter(where).groupBy(*keys).agg(days.distinct_days(FIXTURE_RULES).alias("d"), F.sum("nb_trips").alias("n"))
            want = cells.filter(where).groupBy(*keys).agg(F.count_distinct("date_id").alias("d"), F.sum("nb_trips").alias("n"))
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_days_of_a_period_beyond_one_bitmap(spark):
    rules = TripRules(**{**FIXTURE_RULES.__dict__, "period_start": dt.date(1900, 1, 1), "period_end": dt.date(2040, 1, 1)})
    calendar = star.dim_date(spark, rules)
    cells = calendar.select("date_id", F.lit(1).alias("hour"), F.lit("c").alias("trip_category"), F.lit(1).alias("payment_type"),
                            F.lit(1).cast("bigint").alias("nb_trips"), F.lit(1).cast("decimal(18,6)").alias("total_amount"))
    states = days.day_states(cells, calendar, rules)
    assert states.select("days_block").distinct().count() == 2
    assert states.agg(days.distinct_days(rules).alias("d")).first().d == rules.calendar_days > days.BITS


def test_k2_and_k10_group_once(spark):
    for name in ("demand_by_hour_day", "activity_by_weekday", "demand_heatmap"):
        plan = all_queries()[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert "bitmap_or_agg" in plan and "date_id" not in plan.split("bitmap_or_agg")[-1].split("Filter")[0]
        assert "/trip_cube" not in plan


BELOW = ("zone_scatter", "zone_detail", "borough_revenue", "revenue_by_date", "top10_zone_revenue", "payment_mix", "revenue_per_min_by_slot")


@pytest.mark.parametrize("name", BELOW)
def test_grouping_lies_below_the_dimension_join(spark, name):
    """In the tree, an aggregate stands deeper than the join, on the side of the facts."""
    lines = all_queries()[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    joins = [i for i, s in enumerate(lines) if s.lstrip(" :+-").startswith("Join")]
    assert joins
    last = joins[0]
    facts = [s for s in lines[last + 1:] if depth(s) > depth(lines[last])]
    assert facts[0].lstrip(" :+-").startswith(("Aggregate", "Filter", "Project")) and any(s.lstrip(" :+-").startswith("Aggregate") for s in facts)


def test_grouped_star_equals_grouping_above(spark):
    s = measures.Slicers(date_from="1996-03-01", date_to="1998-06-30", weekdays=(1, 5, 7), payment_labels=("Espèces", "Litige"))
    for keys in (("borough", "time_slot"), ("month", "trip_category"), ("zone", "payment_label", "is_weekend"), ()):
        want = measures.evaluate(measures.sliced_star(spark, SF0001, keys, s), keys, ("trips", "revenue", "card_share"), FIXTURE_RULES)
        got = measures.evaluate_by(spark, SF0001, keys, ("trips", "revenue", "card_share"), s)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_safe_anti_join(spark):
    schema = "a int, b string"
    left = spark.createDataFrame([(1, "x"), (1, None), (None, "x"), (None, None), (2, "y"), (2, "y")], schema)
    known = spark.createDataFrame([(1, None), (None, None), (3, "z"), (None, None)], schema)
    rest = lambda df: sorted(map(str, df.collect()))
    assert rest(null_safe_anti(left, known, ["a", "b"])) == rest(left.filter("a IS NOT NULL AND b IS NOT NULL OR b = 'x'"))
    assert rest(null_safe_anti(left, known.limit(0), ["a", "b"])) == rest(left)
    assert "BroadcastNestedLoopJoin" not in null_safe_anti(left, known, ["a", "b"])._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("missing", ["farebox.llm", "corpus_pipeline", "xxhash"])
def test_analyses_survive_missing_libraries(missing):
    code = ("import sys, warnings; warnings.simplefilter('ignore')\n"
            f"sys.modules['{missing}'] = None\n"
            "import __spark_entry__ as E\n"
            "from farebox.plans.catalog import all_queries\n"
            "assert set(all_queries()) <= set(E.queries()) and len(all_queries()) >= 70\n"
            "assert not [k for k in E.queries() if k == 'pipeline' or k.startswith('op')]\n"
            "assert 'global_kpis' in E.oracle_sql()\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": root})
    assert done.returncode == 0, done.stderr
