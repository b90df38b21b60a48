"""What the medallion build moves: line items once for their order, trips once by month, without what can be added later."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from farebox.config import FIXTURE_RULES
from farebox.operators import clean
from farebox.plans.lake import TripLake, by_month
from farebox.sources import fixture

from .conftest import SF0001

DAY = dt.datetime(1997, 3, 4)
TABLES = {
    # an order that is missing, one that occurs twice, one without customer; a supplier that is missing, a null key
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string",
                 [(1, 5, 1, 3.0, 10.25, 0.04, 0.02, "N"), (2, 6, 2, 46.0, 99.99, 0.1, 0.0, "R"), (3, 7, 9, 8.0, 5.5, 0.0, 0.08, None),
                  (4, 8, 1, 9.0, 7.0, 0.01, 0.01, "A"), (9, 9, None, 1.0, None, None, 0.0, "R"), (None, 1, 1, 2.0, 3.0, 0.0, 0.0, "N"),
                  (1, 5, 1, 3.0, 10.25, 0.04, 0.02, "N")]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
               [(1, 10, DAY, "1-URGENT"), (2, 11, DAY, "2-HIGH"), (2, 10, DAY, "5-LOW"), (3, None, DAY, "3-MEDIUM"), (4, 99, None, None),
                (None, 10, DAY, "1-URGENT")]),
    "supplier": ("s_suppkey long, s_nationkey int", [(1, 4), (2, 8), (2, 9), (None, 1)]),
    "customer": ("c_custkey long, c_nationkey int", [(10, 3), (11, 5), (11, 6), (None, 7)]),
}


def _tables(spark, folder) -> str:
    sf_dir = f"{folder}/tables-{uuid.uuid4().hex}"
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf_dir}/{name}.parquet")
    return sf_dir


def _below(plan: str, *words: str) -> str:
    """The part of a printed plan below its first line with all of ``words``."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if all(w in line for w in words))
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    under = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        under.append(line)
    return "\n".join(under)


def test_customers_meet_orders_not_line_items(spark, scratch):
    plan = fixture.base_trips(spark, _tables(spark, scratch))._jdf.queryExecution().optimizedPlan().toString()
    under = _below(plan, "Join LeftOuter", "c_custkey")
    assert "o_orderkey" in under and "l_orderkey" not in under


def test_base_trips_with_missing_repeated_and_null_keys(spark, scratch):
    sf_dir = _tables(spark, scratch)
    li, od, su, cu = (fixture.read_table(spark, sf_dir, n) for n in ("lineitem", "orders", "supplier", "customer"))
    plain = (li.join(od, li.l_orderkey == od.o_orderkey, "left").join(su, li.l_suppkey == su.s_suppkey, "left")
               .join(cu, od.o_custkey == cu.c_custkey, "left"))
    sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), -1).otherwise(1)
    want = plain.select(
        "l_orderkey", (F.col("l_suppkey") % 3 + 1).cast("int"), "s_nationkey", "c_nationkey",
        F.substring("o_orderpriority", 1, 1).cast("int"), (F.col("l_quantity") - 1) / 2,
        (F.round(F.col("l_extendedprice") * 100) / 10000 * sign).cast("decimal(18,6)")).collect()
    got = fixture.base_trips(spark, sf_dir).select("trip_ref", "vendor_id", "pu_location_id", "do_location_id", "payment_type",
                                                   "trip_distance", "fare_amount").collect()
    assert len(got) > len(TABLES["lineitem"][1])
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r)) for r in want)


def _silver(spark, zones, gather=None):
    t = lambda m: dt.datetime(1997, 1, 2, 3, m)
    rows = [(i % 3 + 1, t(i), t(i + 9), 1 + i % 2, None if i % 5 == 0 else 2, 2.5, i) for i in range(20)] * 2
    valid = spark.createDataFrame(rows, "vendor_id int, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_location_id int, "
                                        "do_location_id int, trip_distance double, trip_ref long")
    return clean.silver(valid, zones, FIXTURE_RULES, gather=gather)


def _zones(spark):
    return spark.sql("SELECT * FROM VALUES (1, 'A', 'one'), (2, 'B', 'two') AS t(location_id, borough, zone)")


def test_trips_are_gathered_by_month_before_metrics_and_zone_names(spark):
    plan = _silver(spark, _zones(spark), by_month)._jdf.queryExecution().optimizedPlan().toString()
    under = _below(plan, "RebalancePartitions")
    assert "pickup_ts" in under and "avg_speed_mph" not in under and "pickup_zone" not in under


def test_gathered_silver_has_the_same_rows(spark, monkeypatch):
    zones = _zones(spark)
    want = _silver(spark, zones)
    rows = lambda df: sorted(map(repr, df.select(*want.columns).collect()))
    assert want.count() == 20
    assert rows(_silver(spark, zones, by_month)) == rows(want)
    # a lookup too large to be broadcast: trips are gathered last, so that they lie by month
    monkeypatch.setattr(clean, "is_small", lambda df: False)
    last = _silver(spark, zones, by_month)
    assert rows(last) == rows(want)
    assert "pickup_zone" in _below(last._jdf.queryExecution().optimizedPlan().toString(), "RebalancePartitions")


def test_fact_trips_are_sorted_by_small_splits(spark, monkeypatch):
    """A split of 128 MB holds some four million trips, whose sort outgrew a task's memory and spilled."""
    key, seen, write = "spark.sql.files.maxPartitionBytes", {}, TripLake._write
    monkeypatch.setattr(TripLake, "_write", lambda self, df, name, *a, **k: (seen.update({name: spark.conf.get(key)}), write(self, df, name, *a, **k))[1])
    before = spark.conf.get(key)
    lake = TripLake(spark, lambda: fixture.raw_trips(spark, SF0001), lambda: fixture.zone_lookup(spark, SF0001, FIXTURE_RULES), FIXTURE_RULES, uuid.uuid4().hex)
    lake.build()
    assert seen["fact_trips"] == "32m" and seen["trip_cube"] == before == spark.conf.get(key)


def _repeated_trips(spark):
    t = lambda m: dt.datetime(1997, 1, 2, 3, m)
    rows = [(i % 3, t(i % 5), None if i % 4 == 0 else t(i % 5 + 9), None if i % 7 == 0 else i % 2, 2, float(i), i) for i in range(60)]
    return spark.createDataFrame(rows, "vendor_id int, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_location_id int, "
                                       "do_location_id int, trip_distance double, trip_ref long")


def test_trip_keys_are_counted_by_hash(spark):
    """All five columns of every trip's key went through the shuffle, and those of repeated keys into a broadcast."""
    plan = clean.duplicate_keys(_repeated_trips(spark), FIXTURE_RULES)._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.split("\n") if "Exchange" in line)
    assert not any(k in exchange for k in FIXTURE_RULES.dedup_keys)
    assert "pickup_ts" not in clean.duplicate_keys(_repeated_trips(spark), FIXTURE_RULES).columns


def test_keys_that_share_a_hash_stay_apart(spark, monkeypatch):
    trips = _repeated_trips(spark)
    want = {}
    for r in trips.collect():
        want.setdefault(tuple(r[:5]), []).append(r)
    rows = lambda df: sorted((repr(tuple(r[:5])), r.trip_ref, r.duplicates_removed) for r in df.collect())
    expected = sorted((repr(k), min(r.trip_ref for r in v), len(v) - 1) for k, v in want.items())
    assert 1 in map(len, want.values()) and rows(clean.dedup(trips, FIXTURE_RULES)) == expected
    monkeypatch.setattr(clean, "key_hash", lambda rules: F.xxhash64(F.lit(None).cast("int"), F.col("vendor_id") % 2))
    assert rows(clean.dedup(trips, FIXTURE_RULES)) == expected
    repeated = clean.duplicate_keys(trips, FIXTURE_RULES).localCheckpoint()
    assert rows(clean.dedup(trips, FIXTURE_RULES, repeated)) == expected
