"""Structured Streaming: exactly-once file ingest, bounded dedup, routed sinks
with an idempotent audit, and hourly windows equal to the batch result."""

import datetime as dt
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from farebox.config import FIXTURE_RULES, TAXI_JANUARY_2019
from farebox.operators import clean
from farebox.sources import ingest
from farebox.session import session_conf
from farebox.streaming import lanes, window_log
from farebox.streaming import trips_stream as S

from .conftest import SF0001
from .helpers import trip_files, write_csv
from .test_monthly import trip, write


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    return trip_files(spark, SF0001, str(tmp_path_factory.mktemp("raw")))


def test_file_stream_ingests_each_file_once(spark, files, scratch):
    a, b, na, nb = files
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copyfile(a, f"{src}/trips_a.csv")
    S.ingest_files(spark, src, f"{scratch}/bronze", f"{scratch}/ckpt")
    assert spark.read.parquet(f"{scratch}/bronze").count() == na
    S.ingest_files(spark, src, f"{scratch}/bronze", f"{scratch}/ckpt")      # nothing new
    assert spark.read.parquet(f"{scratch}/bronze").count() == na
    shutil.copyfile(b, f"{src}/trips_b.csv")
    S.ingest_files(spark, src, f"{scratch}/bronze", f"{scratch}/ckpt")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    assert bronze.count() == na + nb
    assert bronze.select("source_file").distinct().count() == 2


def test_dedup_within_watermark(spark, scratch):
    rows = spark.createDataFrame([
        ("1", "2019-01-01 10:00:00", "2019-01-01 10:20:00", "100", "200", "14.0"),
        ("1", "2019-01-01 10:00:00", "2019-01-01 10:20:00", "100", "200", "15.0"),   # copy, other amount
        ("2", "2019-01-01 10:00:00", "2019-01-01 10:20:00", "100", "200", "9.0"),
        ("1", "2019-01-01 11:00:00", "2019-01-01 11:20:00", "100", "200", "9.0"),
    ], "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, "
       "DOLocationID string, total_amount string")
    full = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
                         for c in [f.name for f in ingest.TLC_TRIP_CSV_SCHEMA]])
    src = f"{scratch}/in"
    write_csv(full, f"{src}/t.csv")
    stream = S.dedup_within_watermark(S.read_trip_stream(spark, src), TAXI_JANUARY_2019)
    q = (stream.writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 3


def test_routed_batches_match_batch_split_and_audit_is_idempotent(spark, files, scratch):
    a, b, na, nb = files
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copyfile(a, f"{src}/trips_a.csv")
    shutil.copyfile(b, f"{src}/trips_b.csv")
    args = (f"{scratch}/routed", f"{scratch}/audit", f"{scratch}/ckpt")
    S.route_batches(spark, S.read_trip_stream(spark, src, max_files_per_trigger=1), *args)
    S.route_batches(spark, S.read_trip_stream(spark, src, max_files_per_trigger=1), *args)   # re-run: no-op
    batch = clean.tag_rejects(ingest.read_trip_csv(spark, src))
    assert S.routed(spark, f"{scratch}/routed", "valid").count() == batch.filter("status = 'valid'").count()
    assert S.routed(spark, f"{scratch}/routed", "rejected").count() == batch.filter("status = 'rejected'").count()
    audit = spark.read.parquet(f"{scratch}/audit")
    assert audit.count() == audit.select("batch_id").distinct().count() == 2
    assert audit.agg(F.sum("valid") + F.sum("rejected")).first()[0] == na + nb


def test_hourly_windows_equal_batch_for_closed_windows(spark, files, scratch):
    a, b, _, _ = files
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copyfile(a, f"{src}/trips_a.csv")
    shutil.copyfile(b, f"{src}/trips_b.csv")
    delay = "1 hour"
    S.run_hourly_zone_demand(spark, src, FIXTURE_RULES, f"{scratch}/out", f"{scratch}/ckpt", delay, max_files_per_trigger=1)
    got = spark.read.parquet(f"{scratch}/out")
    static = ingest.read_trip_csv(spark, src)
    want = S.hourly_zone_demand(static, FIXTURE_RULES)          # same plan, run as batch
    key = ["window_start", "pu_location_id"]
    # every emitted window equals the batch value
    diff = got.join(want, key, "left").filter(
        (got.nb_trips != want.nb_trips) | (got.revenue != want.revenue) | want.nb_trips.isNull())
    assert diff.count() == 0
    # every window of the first file (closed by the second file's watermark) was emitted
    first_max = ingest.read_trip_csv(spark, a).filter(S.in_period(FIXTURE_RULES)).agg(F.max("pickup_ts")).first()[0]
    closed = want.filter(F.col("window_end") <= F.lit(first_max).cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
    assert closed.join(got, key, "left_anti").count() == 0
    assert got.count() > 0


def test_dedup_across_batches_inside_and_outside_the_watermark(spark, scratch):
    """Batch 1 sees 10:00 and 15:00 (watermark 13:00 with a 2 h delay). Batch 2
    brings a copy of 15:00 (inside: dropped as a duplicate), a copy of 10:00
    (behind the watermark: dropped as late) and a new 14:00 trip (kept)."""
    cols = ("VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, "
            "DOLocationID string, total_amount string")
    names = [f.name for f in ingest.TLC_TRIP_CSV_SCHEMA]

    def csv(rows, path):
        df = spark.createDataFrame(rows, cols)
        write_csv(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                              for c in names]), path)

    src = f"{scratch}/in"
    csv([("1", "2019-01-01 10:00:00", "2019-01-01 10:20:00", "1", "2", "10.0"),
         ("1", "2019-01-01 15:00:00", "2019-01-01 15:20:00", "1", "2", "10.0")], f"{src}/a.csv")
    os.utime(f"{src}/a.csv", (1_000_000_000, 1_000_000_000))     # processed first
    csv([("1", "2019-01-01 15:00:00", "2019-01-01 15:20:00", "1", "2", "11.0"),
         ("1", "2019-01-01 10:00:00", "2019-01-01 10:20:00", "1", "2", "11.0"),
         ("1", "2019-01-01 14:00:00", "2019-01-01 14:20:00", "1", "2", "10.0")], f"{src}/b.csv")
    stream = S.dedup_within_watermark(S.read_trip_stream(spark, src, max_files_per_trigger=1), TAXI_JANUARY_2019)
    q = (stream.writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(str(r["pickup_ts"]) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == ["2019-01-01 10:00:00", "2019-01-01 14:00:00", "2019-01-01 15:00:00"]


def test_hourly_windows_update_mode_equal_batch_for_every_window(spark, files, scratch):
    a, b, _, _ = files
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copyfile(a, f"{src}/trips_a.csv")
    shutil.copyfile(b, f"{src}/trips_b.csv")
    window_log.run_hourly_zone_demand_updates(spark, src, FIXTURE_RULES, f"{scratch}/out", f"{scratch}/ckpt",
                                     max_files_per_trigger=1)
    got = window_log.latest_hourly_zone_demand(spark, f"{scratch}/out")
    want = S.hourly_zone_demand(ingest.read_trip_csv(spark, src), FIXTURE_RULES)
    key = ["window_start", "pu_location_id"]
    assert got.count() == want.count()
    assert got.join(want, key, "full_outer").filter(
        (got.nb_trips != want.nb_trips) | (got.revenue != want.revenue)
        | got.nb_trips.isNull() | want.nb_trips.isNull()).count() == 0


TRIP = ("VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, "
        "DOLocationID string, total_amount string")


def trip_csv(spark, rows, path, age):
    """A raw file of (vendor, pickup, zone) trips; older files are read first."""
    df = spark.createDataFrame([(v, p, p, z, "2", "10.0") for v, p, z in rows], TRIP)
    names = [f.name for f in ingest.TLC_TRIP_CSV_SCHEMA]
    write_csv(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names]), path)
    os.utime(path, (1_000_000_000 + age, 1_000_000_000 + age))


def test_a_second_checkpoint_into_the_same_sinks_keeps_its_rows(spark, files, scratch):
    a, b, na, nb = files
    for name, f in (("one", a), ("two", b)):
        os.makedirs(f"{scratch}/{name}")
        shutil.copyfile(f, f"{scratch}/{name}/t.csv")
        S.route_batches(spark, S.read_trip_stream(spark, f"{scratch}/{name}"), f"{scratch}/routed", f"{scratch}/audit", f"{scratch}/ckpt-{name}")
    assert spark.read.parquet(f"{scratch}/routed").count() == na + nb
    audit = spark.read.parquet(f"{scratch}/audit")
    assert audit.select("query_id").distinct().count() == 2
    assert audit.agg(F.sum("valid") + F.sum("rejected")).first()[0] == na + nb


def test_a_stray_future_row_drops_nothing_and_is_kept_apart(spark, scratch):
    rng = random.Random(1)
    ok = {"passenger_count": 1}
    at = lambda when: {"tpep_pickup_datetime": when, "tpep_dropoff_datetime": when[:14] + "59:59"}
    first = trip(rng, 1, **ok, **at("2019-01-01 10:00:00"))
    twice = trip(rng, 1, **ok, **at("2019-01-03 10:00:00"))
    batches = [[first, trip(rng, 1, **ok, **at("2088-01-24 00:00:00")), trip(rng, 1, **ok, tpep_pickup_datetime="")],
               [trip(rng, 1, **ok, **at("2019-01-02 10:00:00")), trip(rng, 1, passenger_count=0, **at("2019-01-02 10:01:00"))],
               [trip(rng, 1, **ok, **at(f"2019-01-03 10:{i:02d}:00")) for i in range(1, 20)] + [twice, twice],
               [twice, trip(rng, 1, **ok, **at("2019-01-01 09:00:00")), first]]
    for i, b in enumerate(batches):
        write(f"{scratch}/in/{i}.csv", b)
        os.utime(f"{scratch}/in/{i}.csv", (1_000_000_000 + i,) * 2)
    run = lambda: lanes.run_dedup(spark, f"{scratch}/in", TAXI_JANUARY_2019, f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=1)
    done = run()
    assert done == {"kept": 22, "duplicates": 2, "late": 2, "rejected": 1, "stray": 2} and sum(done.values()) == sum(map(len, batches))
    sink = lanes.Lanes(spark, f"{scratch}/out", f"{scratch}/ckpt")
    assert sorted(r.pickup_ts.hour for r in sink.lane("late").collect()) == [9, 10]      # late rows are readable
    assert {x: sink.lane(x).count() for x in lanes.LANES} == {"kept": 22, "duplicate": 1, "late": 2, "rejected": 1, "stray": 2}
    assert run() == done                                                                  # nothing new
    # a batch that is replayed before its log entry is written over, after it left alone
    query = S.query_id(spark, f"{scratch}/ckpt")
    batch = ingest.read_trip_csv(spark, f"{scratch}/in/3.csv")
    sink.handle(batch, 3, TAXI_JANUARY_2019, 7200)
    os.remove(f"{scratch}/out/log/{query}/3.json")
    sink.handle(batch, 3, TAXI_JANUARY_2019, 7200)
    assert sink.counts()[3] == {"kept": 0, "duplicates": 1, "late": 2, "rejected": 0, "stray": 0}
    assert sink.lane("late").count() == 2


def test_nothing_is_lost_over_many_micro_batches(spark, scratch):
    """Rows come in order of time with copies, late rows, strays and rejects between; the state stays bounded.
    ``STREAM_BATCHES=150`` takes about six minutes."""
    rng, n, total = random.Random(2), int(os.environ.get("STREAM_BATCHES", "22")), 0
    start, seen, kept, late = dt.datetime(2019, 1, 1), [], set(), 0
    for i in range(n):
        now = start + dt.timedelta(minutes=30 * i)
        fresh = [trip(rng, 1, passenger_count=1, tpep_pickup_datetime=now + dt.timedelta(minutes=k), tpep_dropoff_datetime=now + dt.timedelta(minutes=40))
                 for k in (0, 3)]
        rows = fresh + [rng.choice(seen[-4:] or fresh)]
        if i % 10 == 9 and i > 9:                                # long past the watermark: new rows and copies alike
            old = start + dt.timedelta(minutes=30 * i - 300, seconds=i)
            rows += [trip(rng, 1, passenger_count=1, tpep_pickup_datetime=old, tpep_dropoff_datetime=old + dt.timedelta(minutes=9)), seen[0]]
            late += 2
        if i % 25 == 0:
            rows += [trip(rng, 1, tpep_pickup_datetime="2031-01-01 00:00:00"), trip(rng, 1, passenger_count=0, tpep_pickup_datetime=now)]
        seen += fresh
        kept |= set(fresh)
        total += len(rows)
        write(f"{scratch}/in/{i:03d}.csv", rows)
        os.utime(f"{scratch}/in/{i:03d}.csv", (1_000_000_000 + i,) * 2)
    with session_conf(spark, spark__sql__shuffle__partitions="1"):
        done = lanes.run_dedup(spark, f"{scratch}/in", TAXI_JANUARY_2019, f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=1)
    sink = lanes.Lanes(spark, f"{scratch}/out", f"{scratch}/ckpt")
    assert len(sink.counts()) == n and sum(done.values()) == total
    assert (done["kept"], done["late"], done["stray"]) == (len(kept), late, len(range(0, n, 25))) and sink.lane("late").count() == late
    query = S.query_id(spark, f"{scratch}/ckpt")
    assert max(len(sink.log(query, b)["open"]) for b in range(n)) <= 6         # two hours of batches, not all


def test_window_log_reads_base_and_open_batches_only(spark, files, scratch):
    rng = random.Random(3)
    for i in range(7):
        day = dt.datetime(2019, 1, 1 + i // 3, 10 + i % 3)
        write(f"{scratch}/in/{i}.csv", [trip(rng, 1, passenger_count=1, tpep_pickup_datetime=day + dt.timedelta(minutes=k),
                                             tpep_dropoff_datetime=day + dt.timedelta(minutes=k + 5)) for k in range(12)])
        os.utime(f"{scratch}/in/{i}.csv", (1_000_000_000 + i,) * 2)
    with session_conf(spark, spark__sql__shuffle__partitions="1"):
        window_log.run_hourly_zone_demand_updates(spark, f"{scratch}/in", TAXI_JANUARY_2019, f"{scratch}/out", f"{scratch}/ckpt", delay="100 days",
                                                  max_files_per_trigger=1, compact_every=3)
    log = window_log.WindowLog(spark, f"{scratch}/out")
    manifest, paths = log.snapshots.latest(), log.paths(log.snapshots.latest())
    assert manifest["number"] == 2 and list(manifest["upto"].values()) == [5]
    assert "/base/" in paths[0] and len(paths) - 1 <= 3 and all("/batch=" in p and int(p.split("=")[-1]) > 5 for p in paths[1:])
    want = S.hourly_zone_demand(ingest.read_trip_csv(spark, f"{scratch}/in"), TAXI_JANUARY_2019).select(*window_log.KEYS, *window_log.VALUES)
    same = lambda: sorted(map(str, log.read().collect())) == sorted(map(str, want.collect()))
    assert same()
    log.vacuum(3600)                                     # young: nothing goes
    query = S.query_id(spark, f"{scratch}/ckpt")
    assert len(log._batches()[query]) >= 7
    log.vacuum(0, now=manifest["published"] + 10)
    assert min(log._batches()[query]) > 5 and log.snapshots.numbers() == [2] and same()
    log.compact()
    assert len(log.paths(log.snapshots.latest())) == 1 and same()
