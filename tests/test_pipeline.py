"""Medallion build on the driver tables: funnel conservation, expected counts,
exact cube reconciliation, shares, dedup determinism, plan shape."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farebox import config as C
from farebox.config import FIXTURE_RULES
from farebox.operators import clean
from farebox.operators.pareto import running_share, threshold_counts
from farebox.plans import analyses, layers, measures
from farebox.plans.lake import fixture_lake

from .conftest import SF0001

# Expected funnel at sf 0.001 (prototyped independently in Spark and DuckDB).
EXPECTED_0001 = {
    C.REJECT_ZONE_MISSING: 51, C.REJECT_TIME_MISSING: 54, C.REJECT_DROPOFF_BEFORE_PICKUP: 140,
    C.REJECT_DISTANCE: 145, C.REJECT_FARE: 196, C.REJECT_NO_PASSENGER: 763, C.FUNNEL_REASON_DUPLICATE: 105,
    C.ANOMALY_PERIOD: 1170, C.ANOMALY_AMOUNT: 433, C.ANOMALY_SPEED: 107, C.ANOMALY_LONG: 207,
    C.ANOMALY_SHORT: 1, C.FUNNEL_REASON_OUTPUT: 2867,
}


@pytest.fixture(scope="module")
def lake(spark):
    return fixture_lake(spark, SF0001)


def test_funnel_matches_expected_counts(lake):
    rows = {r["reason"]: r["nb_trips"] for r in lake.table("data_quality").collect()}
    for reason, n in EXPECTED_0001.items():
        assert rows[reason] == n, reason


def test_funnel_conserves_every_raw_row(lake):
    q = lake.table("data_quality").collect()
    raw = [r["nb_trips"] for r in q if r["category"] == C.FUNNEL_CAT_INPUT][0]
    rest = sum(r["nb_trips"] for r in q if r["category"] != C.FUNNEL_CAT_INPUT)
    assert raw == rest == lake.table("staged").count()
    assert abs(sum(r["pct_of_raw"] for r in q if r["category"] != C.FUNNEL_CAT_INPUT) - 1.0) < 1e-12


def test_cube_reconciles_exactly(spark):
    rec = layers.cube_reconciliation(spark, SF0001).collect()
    assert len(rec) == 9 and all(r["difference"] == 0 for r in rec)


def test_each_trip_in_exactly_one_segment(spark, lake):
    f = lake.table("fact_trips")
    n = f.count()
    assert f.filter(F.col("trip_category").isNull() | F.col("distance_band").isNull()).count() == 0
    assert sum(r["nb_trips"] for r in layers.trip_category(spark, SF0001).collect()) == n
    assert sum(r["nb_trips"] for r in layers.distance_band(spark, SF0001).collect()) == n
    assert sum(r["nb_trips"] for r in layers.time_slot(spark, SF0001).collect()) == n


def test_shares_sum_to_one_hundred(spark):
    mix = analyses.trip_category_mix(spark, SF0001).collect()
    assert abs(sum(r["trips_share_pct"] for r in mix) - 100) < 1e-9
    assert abs(sum(r["revenue_share_pct"] for r in mix) - 100) < 1e-9
    s = measures.share_of_selection(spark, SF0001).collect()
    assert abs(sum(r["revenue_share"] for r in s) - 1) < 1e-12


def test_dedup_keeps_the_smallest_by_total_order(spark):
    rows = [
        (1, "2019-01-01 10:00:00", "2019-01-01 10:20:00", 1, 2.5, 12.0, 100, 200, 1, 15.0, 2.0, 7),
        (1, "2019-01-01 10:00:00", "2019-01-01 10:20:00", 1, 2.5, 12.0, 100, 200, 1, 14.0, 3.0, 9),
        (1, "2019-01-01 10:00:00", "2019-01-01 10:20:00", 2, 2.5, 12.0, 100, 200, 1, 14.0, 3.0, 8),
        (2, "2019-01-01 10:00:00", "2019-01-01 10:20:00", 1, 2.5, 12.0, 100, 200, 1, 30.0, 1.0, 1),
    ]
    cols = ("vendor_id string, pickup_ts string, dropoff_ts string, passenger_count int, trip_distance double, "
            "fare_amount double, pu_location_id int, do_location_id int, payment_type int, total_amount double, "
            "tip_amount double, trip_ref long")
    df = spark.createDataFrame(rows, cols)
    out = {r["vendor_id"]: r for r in clean.dedup(df, FIXTURE_RULES).collect()}
    # total, tip, distance, fare, passengers, payment, ref: 14.0/3.0 tie -> passengers 1 wins
    assert out["1"]["trip_ref"] == 9 and out["1"]["duplicates_removed"] == 2
    assert out["2"]["duplicates_removed"] == 0
    # same survivor whatever the input order / partitioning
    for seed in range(3):
        shuffled = df.repartition(3, F.rand(seed))
        assert clean.dedup(shuffled, FIXTURE_RULES).filter("vendor_id = '1'").first()["trip_ref"] == 9


def test_running_share_matches_plain_window_with_ties(spark):
    rnd = random.Random(7)
    vals = [(k, rnd.choice([1, 2, 3, 5, 8, 8, 8, 13, 21, 21]) * rnd.randint(1, 40)) for k in range(2000)]
    df = spark.createDataFrame(vals, "k int, value long")
    got = {r["value"]: r["share"] for r in running_share(df, "value", ranges=8).collect()}
    w = Window.orderBy(F.col("value").desc())
    plain = (df.withColumn("run", F.sum("value").over(w))
               .withColumn("share", F.col("run") / F.sum("value").over(Window.partitionBy())))
    want = {r["value"]: r["share"] for r in plain.select("value", "share").distinct().collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-12 for v in want)
    t = threshold_counts(df, "value", (0.5, 0.8), "keys").first()
    n50 = plain.filter(F.col("share") <= 0.5).count() + 1
    assert t["active_keys"] == 2000 and t["keys_for_50pct"] == n50


def test_running_share_empty_input(spark):
    df = spark.createDataFrame([], "k int, value long")
    t = threshold_counts(df, "value", (0.5,), "keys").first()
    assert t["active_keys"] == 0 and t["keys_for_50pct"] == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_broadcast_dims_and_push_filters(spark, lake):
    staged = lake.table("staged")
    p = _plan(clean.silver(clean.valid_trips(staged), lake.zones(), FIXTURE_RULES))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    from farebox.plans import reports
    fact_q = reports.airport_detail(spark, SF0001)          # needs the dropoff zone: reads the fact
    txt = spark._jvm.PythonSQLUtils.explainString(fact_q._jdf.queryExecution(), "formatted")
    assert "IsNull(anomaly_reason)" in txt.split("PushedFilters: ")[1].split("\n")[0] and "fact_trips" in txt
    schema = txt.split("ReadSchema: ")[1].split("\n")[0]
    assert "pickup_datetime" not in schema and "dropoff_location_id" in schema
    k4 = analyses.trip_category_mix(spark, SF0001)          # cube keys only: reads the cube
    txt = spark._jvm.PythonSQLUtils.explainString(k4._jdf.queryExecution(), "formatted")
    assert "trip_cube" in txt and "fact_trips" not in txt
    schema = txt.split("ReadSchema: ")[1].split("\n")[0]
    assert "date_id" not in schema and "trip_category" in schema
    for q in (analyses.top_zones, analyses.daily_activity, analyses.tips_by_payment, measures.zone_scatter
              if hasattr(measures, "zone_scatter") else analyses.global_kpis):
        assert "CartesianProduct" not in _plan(q(spark, SF0001))


def test_dedup_uses_partial_aggregation(spark, lake):
    p = _plan(clean.dedup(clean.valid_trips(lake.table("staged")), FIXTURE_RULES))
    assert "partial_min" in p and "Window" not in p


def test_reads_whole_tables(spark, lake):
    # the base is never filtered: every line item with its joins yields a trip
    staged = lake.table("staged").count()
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet").count()
    assert staged >= li


def test_measures_route_to_cube_or_fact_with_equal_results(spark):
    from farebox.plans.measures import evaluate, sliced_star
    by_cube = evaluate(sliced_star(spark, SF0001, ("hour",)), ("hour",), ("trips", "revenue", "revenue_per_min"))
    # vendor is not a cube key: the same measures come from the fact
    by_fact = evaluate(sliced_star(spark, SF0001, ("vendor_id",)), ("vendor_id",), ("trips", "revenue"))
    assert "trip_cube" in _plan(by_cube) and "fact_trips" in _plan(by_fact)
    a = by_cube.agg(F.sum("trips"), F.sum("revenue")).first()
    b = by_fact.agg(F.sum("trips"), F.sum("revenue")).first()
    assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-6


def test_interrupted_build_resumes_finished_layers(spark, scratch):
    import uuid

    from farebox.plans.lake import TripLake
    from farebox.sources import fixture

    def fresh():
        return TripLake(spark, lambda: fixture.raw_trips(spark, SF0001),
                        lambda: fixture.zone_lookup(spark, SF0001, FIXTURE_RULES), FIXTURE_RULES,
                        fingerprint=key)

    key = f"resume-test-{uuid.uuid4()}"
    first = fresh()
    first._write(clean.tag_rejects(first._raw()), "staged", partition_by=("status",))   # then "dies"
    resumed = fresh().build()
    assert resumed.root == first.root
    assert resumed.metrics["staged"] == {"reused": True} and "rows" in resumed.metrics["fact_trips"]
    got = {r["reason"]: r["nb_trips"] for r in resumed.table("data_quality").collect()}
    assert got[C.FUNNEL_REASON_OUTPUT] == EXPECTED_0001[C.FUNNEL_REASON_OUTPUT]


def test_dedup_with_a_hot_key_holding_a_third_of_the_rows(spark):
    """One trip key repeated for a third of the input: collapsed on the map side
    (partial aggregate per input partition) and still exact."""
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 7 + 2).cast("int")).alias("vendor_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("timestamp").cast("timestamp_ntz")
         .alias("pickup_ts"),
        F.lit(None).cast("timestamp_ntz").alias("dropoff_ts"),
        F.lit(1).alias("pu_location_id"), F.lit(2).alias("do_location_id"),
        (F.col("id") % 11).cast("double").alias("total_amount"), F.col("id").alias("trip_ref"))
    out = clean.dedup(base.repartition(8), FIXTURE_RULES)
    hot = out.filter((F.col("vendor_id") == 1) & (F.col("pu_location_id") == 1)
                     & (F.col("pickup_ts") == F.lit(0).cast("timestamp").cast("timestamp_ntz"))).collect()
    assert len(hot) == 1 and hot[0]["duplicates_removed"] == n // 3 - 1
    assert hot[0]["total_amount"] == 0.0 and hot[0]["trip_ref"] == 0      # smallest by the total order
    assert out.count() == 1 + (n - n // 3)
    assert "partial_min" in _plan(out)


def test_pinned_column_overrides_the_visual_grouping(spark):
    """A measure that pins a column replaces the grouping on that column (and only it)."""
    rows = measures.airport_revenue_override(spark, SF0001).collect()
    total = measures.measures_total(spark, SF0001).first()
    assert len({r["airport_revenue"] for r in rows}) == 1
    assert rows[0]["airport_revenue"] == total["airport_revenue"]
    for r in rows:
        assert abs(r["airport_revenue_share"] - r["airport_revenue"] / r["revenue"]) < 1e-12
    m4 = measures.trips_per_day_excl_holidays(spark, SF0001).collect()
    assert {r["is_holiday"] for r in m4} == {True, False}
    assert len({r["trips_per_day_excl_holidays"] for r in m4}) == 1


def test_slicers_restrict_facts_through_dimensions(spark):
    s = measures.slice_star(spark, SF0001).collect()
    assert {r["payment_label"] for r in s} == {"Carte bancaire"}
    full = measures.measures_total(spark, SF0001).first()
    assert 0 < sum(r["trips"] for r in s) < full["trips"]


def test_threshold_exactly_reached(spark):
    """Shares 0.5, 0.8, 1.0: the published count adds the crossing key even when
    a share equals the threshold; the `to_reach` count does not."""
    df = spark.createDataFrame([(1, 5), (2, 3), (3, 2)], "k int, value long")
    t = threshold_counts(df, "value", (0.5, 0.8), "keys").first()
    assert (t["keys_for_50pct"], t["keys_to_reach_50pct"]) == (2, 1)
    assert (t["keys_for_80pct"], t["keys_to_reach_80pct"]) == (3, 2)


def test_broadcast_only_behind_a_size_check(spark, lake):
    from farebox.operators.joins import BROADCAST_LIMIT_BYTES, broadcast_if_small, estimated_bytes
    from farebox.session import session_conf
    zones = lake.zones()
    assert 0 < estimated_bytes(zones) < BROADCAST_LIMIT_BYTES     # an upper-bound estimate, no job run
    trips = lake.table("silver_trips").select("pu_location_id")
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                      spark__sql__adaptive__enabled="false"):
        small = trips.join(broadcast_if_small(zones.withColumnRenamed("location_id", "pu_location_id")),
                           "pu_location_id", "left")
        over = trips.join(broadcast_if_small(zones.withColumnRenamed("location_id", "pu_location_id"), 1),
                          "pu_location_id", "left")
        assert "BroadcastHashJoin" in _plan(small)
        assert "BroadcastHashJoin" not in _plan(over) and "SortMergeJoin" in _plan(over)
        assert small.count() == over.count() == trips.count()


def test_airport_attribution_parameter(spark):
    from farebox.plans import reports
    either = {r["airport_id"]: r["nb_trips"] for r in reports.airport_detail(spark, SF0001).collect()}
    pickup = {r["airport_id"]: r["nb_trips"] for r in reports.airport_detail(spark, SF0001, "pickup").collect()}
    assert set(pickup) <= set(either) and all(pickup[k] <= either[k] for k in pickup)
    assert sum(pickup.values()) < sum(either.values())
