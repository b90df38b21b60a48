"""The monthly lake: months rebuilt by change sets, cube upkeep by difference, snapshots, malformed lines."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from farebox.config import TAXI_JANUARY_2019, TripRules
from farebox.operators import cube
from farebox.plans import measures
from farebox.plans.common import register_lake
from farebox.plans.monthly import MOST_DIFFERENCES, MonthlyLake
from farebox.sources.ingest import BronzeIngest
from farebox.sources.schemas import TLC_TRIP_CSV_SCHEMA
from farebox.sources.snapshots import Conflict, Snapshots

HEADER = ",".join(f.name for f in TLC_TRIP_CSV_SCHEMA)
RULES = TripRules(**{**TAXI_JANUARY_2019.__dict__, "period_end": dt.date(2019, 7, 1)})


def trip(rng, month, day=None, **cells):
    start = dt.datetime(2019, month, day or rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59))
    row = {"VendorID": rng.choice([1, 2]), "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=rng.randint(3, 40)),
           "passenger_count": rng.choice([0, 1, 2]), "trip_distance": f"{rng.randint(1, 900) / 100:.2f}", "RatecodeID": 1, "store_and_fwd_flag": "N",
           "PULocationID": rng.choice([1, 2, 3]), "DOLocationID": rng.choice([2, 3]), "payment_type": rng.choice([1, 2]),
           "fare_amount": f"{rng.randint(300, 4000) / 100:.2f}", "extra": "0.5", "mta_tax": "0.5", "tip_amount": rng.choice(["", "1.01"]),
           "tolls_amount": "", "improvement_surcharge": "0.3", "total_amount": f"{rng.randint(400, 5000) / 100:.2f}", "congestion_surcharge": ""}
    return ",".join(str(v) for v in (row | cells).values())


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def lake_at(spark, base, name="gold"):
    zones = spark.createDataFrame([(1, "EWR", "Airport", "s"), (2, "Manhattan", "M1", "s"), (3, "Queens", "Q1", "s")],
                                  "location_id int, borough string, zone string, service_zone string")
    return MonthlyLake(spark, f"{base}/{name}", BronzeIngest(spark, f"{base}/bronze", f"{base}/audit"), lambda: zones, RULES)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same_as_rebuilt(spark, base, lake, name):
    """Every table equals that of a lake built from nothing over the same loads; cube and detail add up alike."""
    whole = lake_at(spark, base, name).build()
    for t in ("fact_trips", "trip_cube", "data_quality"):
        assert rows(lake.table(t)) == rows(whole.table(t)), t
    assert all(r.cube_total == r.detail_total for r in cube.reconcile(lake.table("trip_cube"), lake.table("fact_trips")).collect())


def files(base, table):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{base}/gold/{table}/**/*.parquet", recursive=True)}


def test_one_file_rewrites_one_month(spark, scratch):
    rng = random.Random(1)
    jan, feb = [trip(rng, 1) for _ in range(60)], [trip(rng, 2) for _ in range(60)]
    write(f"{scratch}/raw/a.csv", jan + [jan[0], "2,,,1,1,1,N,2,3,1,5,,,,,,6,"])
    write(f"{scratch}/raw/b.csv", feb)
    lake = lake_at(spark, scratch)
    lake.ingest.ingest_all([f"{scratch}/raw"])
    lake.build()
    assert sorted(lake.pinned["tables"]["staged"]) == ["2019-01", "2019-02", "none"]
    before = {t: files(scratch, t) for t in ("silver_trips", "fact_trips", "cells")}
    # the same trip in another file is a duplicate; one new cell
    write(f"{scratch}/raw/c.csv", [feb[0], feb[1], trip(rng, 2, passenger_count=1)])
    lake.ingest.ingest_all([f"{scratch}/raw"])
    held = lake.table("fact_trips")
    counted = held.count()
    lake.build()
    for t, old in before.items():
        now = files(scratch, t)
        assert all(now[p] == m for p, m in old.items())             # nothing is written over
        new = [p for p in now if p not in old]
        assert new and all("pickup_year=2019/pickup_month=2/" in p for p in new)
    changed = [p for p in files(scratch, "cells") if p not in before["cells"]]
    assert spark.read.parquet(*changed).count() == 1                # only the cell that changed
    assert held.count() == counted                                   # the pinned handle reads its own snapshot
    assert lake.table("fact_trips").count() == counted + 1
    same_as_rebuilt(spark, scratch, lake, "again")
    number = lake.pinned["number"]
    assert lake.build().pinned["number"] == number and len(os.listdir(f"{scratch}/gold/runs")) == 2     # nothing to do


def test_cube_follows_shrunk_reloaded_and_emptied_files(spark, scratch):
    rng = random.Random(2)
    a, b = [trip(rng, 1) for _ in range(80)], [trip(rng, m) for m in (1, 3) for _ in range(30)]
    write(f"{scratch}/raw/a.csv", a)
    write(f"{scratch}/raw/b.csv", b)
    lake = lake_at(spark, scratch)
    load = lambda **k: (lake.ingest.ingest_all([f"{scratch}/raw"], **k), lake.build())
    load()
    write(f"{scratch}/raw/a.csv", a[:50])                            # shrunk
    load()
    same_as_rebuilt(spark, scratch, lake, "shrunk")
    number = lake.pinned["number"]
    load(force=True)                                                 # reloaded: the same rows in other runs
    assert lake.pinned["number"] == number + 1
    assert [p for m, p in lake.pinned["tables"]["cells"].items() if m == "2019-03" and len(p) > 1] == []     # no cell changed
    write(f"{scratch}/raw/b.csv", [])                                # emptied: its month goes
    load()
    assert "2019-03" not in lake.pinned["tables"]["fact_trips"] and lake.table("trip_cube").filter("date_id >= 20190301").isEmpty()
    same_as_rebuilt(spark, scratch, lake, "emptied")


def test_many_differences_become_a_base(spark, scratch):
    rng = random.Random(3)
    lake = lake_at(spark, scratch)
    depth = []
    for i in range(MOST_DIFFERENCES + 3):
        write(f"{scratch}/raw/f{i}.csv", [trip(rng, 5, day=3) for _ in range(4)])
        lake.ingest.ingest_all([f"{scratch}/raw"])
        lake.build()
        depth.append(len(lake.pinned["tables"]["cells"].get("2019-05", [])))
    assert max(depth) == MOST_DIFFERENCES + 1 and 1 in depth[1:]
    same_as_rebuilt(spark, scratch, lake, "again")


def test_cells_retract_sums_of_nulls(spark):
    """A cell whose tips were all null, then one, then null again."""
    schema = "date_id int, hour int, pickup_location_id int, payment_type int, trip_category string, distance_band string, anomaly_reason string, " \
             "passenger_count int, trip_distance decimal(18,6), trip_duration_seconds long, fare_amount decimal(18,6), tip_amount decimal(18,6), " \
             "tolls_amount decimal(18,6), extra decimal(18,6), mta_tax decimal(18,6), improvement_surcharge decimal(18,6), total_amount decimal(18,6)"
    fact = lambda *tips: spark.createDataFrame([(1, 1, 1, 1, "c", "b", None, 1, None, 60, None, t, None, None, None, None, None) for t in tips], "struct<" + ",".join(
        c.strip().replace(" ", ":", 1) for c in __import__("re").split(r",(?![^(]*\))", schema)) + ">")
    from decimal import Decimal as D
    states = [fact(None), fact(None, D("2.5")), fact(D("2.5")), fact(None, None), fact()]
    have = cube.build_cells(states[0])
    for now in states[1:]:
        have = cube.merge_cells(have.unionByName(cube.difference(cube.build_cells(now), have)))
        assert rows(cube.as_cube(have)) == rows(cube.build_trip_cube(now))


def test_malformed_lines_are_kept_and_counted(spark, scratch):
    rng = random.Random(4)
    good = [trip(rng, 1, passenger_count=1) for _ in range(20)]
    bad = [trip(rng, 1, passenger_count=1, total_amount="oops"), trip(rng, 1, passenger_count=1, payment_type="x"),
           trip(rng, 1, passenger_count=1) + ",too,many"]
    caught = [trip(rng, 1, passenger_count="abc")]                   # a published rule rejects it already
    write(f"{scratch}/raw/a.csv", good + bad + caught)
    lake = lake_at(spark, scratch)
    lake.ingest.ingest_all([f"{scratch}/raw"])
    lake.build()
    n = {(r.category, r.reason): r.nb_trips for r in lake.table("data_quality").collect()}
    assert n["Illisible", "Ligne au format invalide"] == 3 and n["Rejet", "Aucun passager"] == 1
    raw = n["Entrée", "Courses brutes ingérées"]
    assert raw == 24 and raw == sum(v for (c, _), v in n.items() if c != "Entrée")
    assert lake.table("fact_trips").count() == 20
    kept = lake.table("staged").filter("status = 'malformed'")
    assert sorted(r.corrupt_line for r in kept.collect()) == sorted(bad)


def test_date_slicer_prunes_months(spark, scratch):
    rng = random.Random(5)
    write(f"{scratch}/raw/a.csv", [trip(rng, m) for m in range(1, 7) for _ in range(5)])
    lake = lake_at(spark, scratch)
    lake.ingest.ingest_all([f"{scratch}/raw"])
    register_lake("monthly-test", lake.build())
    s = measures.Slicers(date_from="2019-02-10", date_to="2019-03-20")
    cut = measures.sliced_star(spark, "monthly-test", (), s, source=lake.table("fact_trips"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "pickup_year" in filters and "201902" in filters and "201903" in filters
    want = lake.table("fact_trips").filter("date_id BETWEEN 20190210 AND 20190320").count()
    assert cut.count() == want and 0 < want < lake.table("fact_trips").count()


def test_two_builders_and_a_reader(spark, scratch):
    rng = random.Random(6)
    write(f"{scratch}/raw/a.csv", [trip(rng, 1) for _ in range(30)])
    one, two = lake_at(spark, scratch), lake_at(spark, scratch)
    one.ingest.ingest_all([f"{scratch}/raw"])
    one.build()
    reader = lake_at(spark, scratch).refresh()
    want = rows(reader.table("fact_trips"))
    write(f"{scratch}/raw/b.csv", [trip(rng, 1) for _ in range(30)])
    one.ingest.ingest_all([f"{scratch}/raw"])
    inside = two._build_months

    def overtaken(*args):
        """The other builder publishes while this one is at work."""
        two._build_months = inside
        made = inside(*args)
        one.build(force=True)
        return made
    two._build_months = overtaken
    two.build()
    assert two.pinned["number"] == one.pinned["number"] == 2         # it saw the newer snapshot and had nothing left to do
    assert rows(two.table("fact_trips")) == rows(one.table("fact_trips"))
    with pytest.raises(Conflict):
        one.snapshots.publish(one.pinned, {"number": 1})
    # the reader's snapshot is older than all that and still whole
    lake = lake_at(spark, scratch)
    lake.pinned = reader.pinned
    assert rows(lake.table("fact_trips")) == want
    assert one.snapshots.expire(3600) == []                           # young ones stay
    assert one.snapshots.expire(0, now=one.pinned["published"] + 10) == [1]
    assert one.snapshots.numbers() == [2] and rows(lake_at(spark, scratch).table("fact_trips")) == rows(one.table("fact_trips"))
    assert {p for p in os.listdir(f"{scratch}/gold/fact_trips")} == {f"build={b}" for m in one.pinned["tables"]["fact_trips"].values() for b, _ in m}


def test_manifests_are_never_half_read(spark, scratch):
    s = Snapshots(spark, f"{scratch}/s")
    assert s.latest() is None
    first = s.publish({"builds": [], "tables": {}}, None)
    assert s.publish({"builds": [], "tables": {}}, first)["number"] == 2 and s.numbers() == [1, 2]
    with pytest.raises(Conflict):
        s.publish({"builds": []}, first)
    assert not [f for f in os.listdir(f"{scratch}/s/_snapshots") if f.startswith(".") and not f.endswith(".crc")]


def test_months_of_strays_and_missing_times(spark, scratch):
    rng = random.Random(7)
    write(f"{scratch}/raw/a.csv", [trip(rng, 1), trip(rng, 1, tpep_pickup_datetime="2088-01-02 03:04:05", tpep_dropoff_datetime="2088-01-02 03:14:05"),
                                  trip(rng, 1, tpep_pickup_datetime="")])
    lake = lake_at(spark, scratch)
    lake.ingest.ingest_all([f"{scratch}/raw"])
    lake.build()
    assert sorted(lake.pinned["tables"]["staged"]) == ["2019-01", "2088-01", "none"]
    assert lake.table("staged").filter(F.col("pickup_month").isNull()).count() == 1
