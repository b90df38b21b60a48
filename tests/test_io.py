"""Sources and sinks: typed CSV scan, incremental ingest with audit, export,
named SQL runner, and the CSV -> bronze -> gold path end to end."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from farebox.config import FIXTURE_RULES
from farebox.plans.lake import TripLake, fixture_lake
from farebox.session import list_files
from farebox.sources import ingest

from .conftest import SF0001
from .helpers import trip_files, zone_csv


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("raw"))
    return trip_files(spark, SF0001, d)


def test_typed_csv_scan(spark, files):
    a, b, na, nb = files
    df = ingest.read_trip_csv(spark, [a, b])
    types = dict(df.dtypes)
    assert types["pickup_ts"] == "timestamp_ntz" and types["total_amount"] == "decimal(18,6)"
    assert df.count() == na + nb
    assert types["trip_distance"] == "decimal(18,6)"
    assert {r["source_file"] for r in df.select("source_file").distinct().collect()} == {f"file:{a}", f"file:{b}"}


def test_bad_cell_becomes_null_and_is_rejected(spark, tmp_path):
    p = tmp_path / "bad.csv"
    header = ",".join(f.name for f in ingest.TLC_TRIP_CSV_SCHEMA)
    p.write_text(header + "\n1,2019-01-01 10:00:00,2019-01-01 10:20:00,abc,2.5,1,N,100,200,1,"
                 "12.0,0,0.5,2,0,0.3,14.8,0\n")
    df = ingest.read_trip_csv(spark, str(p))
    from farebox.functions.rules import reject_reason
    r = df.select("passenger_count", reject_reason().alias("r"), "corrupt_line").first()
    assert r["passenger_count"] is None and r["r"] == "Aucun passager" and ",abc," in r["corrupt_line"]


def test_incremental_ingest_gate(spark, files, scratch):
    a, b, na, nb = files
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    assert bi.ingest(a)["rows"] == na
    assert bi.ingest(a)["status"] == "SKIPPED"
    assert bi.ingest(b)["rows"] == nb
    assert bi.bronze().count() == na + nb                      # file B did not destroy file A
    assert bi.ingest(a, force=True)["rows"] == na
    assert bi.bronze().count() == na + nb                      # a forced reload replaces, never duplicates
    audit = bi.audit()
    assert audit.filter("status = 'SUCCESS'").count() == 3
    listing = spark.createDataFrame([(f["source_file"], f["size"], f["modified"]) for f in list_files(spark, [a, b])]
                                    + [("file:/new.csv", 1, 1)], "source_file string, size long, modified long")
    assert [r[0] for r in bi.pending(listing).collect()] == ["file:/new.csv"]


def small_csv(path, n, day=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    header = ",".join(f.name for f in ingest.TLC_TRIP_CSV_SCHEMA)
    lines = [f"1,2019-01-{day:02d} 10:00:00,2019-01-{day:02d} 10:20:00,1,{i / 100:.2f},1,N,100,200,1,12.0,0,0.5,2,0,0.3,14.8,0" for i in range(n)]
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def test_full_sample_full_keeps_every_row(spark, scratch):
    a = small_csv(f"{scratch}/a/trips.csv", 1000)
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    assert bi.ingest(a)["rows"] == 1000
    assert 0 < bi.ingest(a, sample_fraction=0.1)["rows"] < 200
    assert bi.bronze().count() == 1000 and bi.ingest(a)["status"] == "SKIPPED"


def test_same_name_changed_shrunk_and_emptied_files(spark, scratch):
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    a, b = small_csv(f"{scratch}/in/a/trips.csv", 150), small_csv(f"{scratch}/in/b/trips.csv", 70, day=2)
    assert [r["rows"] for r in bi.ingest_all([f"{scratch}/in/a", f"{scratch}/in/b"])] == [150, 70]
    assert bi.bronze().count() == 220                                   # one name, two folders
    small_csv(a, 100)
    assert bi.ingest(a)["rows"] == 100 and bi.bronze().count() == 170   # changed content is seen and replaces
    small_csv(b, 0)
    assert bi.ingest(b)["rows"] == 0 and bi.bronze().count() == 100     # an emptied file leaves nothing behind
    small_csv(f"{scratch}/in/a/more trips+1.csv", 5)
    got = bi.ingest_all([f"{scratch}/in/a"])                            # a new file in a folder known already
    assert sorted((r["status"], r["rows"]) for r in got) == [("SKIPPED", 0), ("SUCCESS", 5)]
    assert bi.bronze().count() == 105
    assert bi.ingest(a, force=True)["rows"] == 100 and bi.bronze().count() == 105


def test_sampled_load_does_not_block_full_load(spark, files, scratch):
    a, _, na, _ = files
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    sampled = bi.ingest(a, sample_fraction=0.5)["rows"]
    assert 0 < sampled < na
    full = bi.ingest(a)
    assert full["status"] == "SUCCESS" and full["rows"] == na
    assert bi.bronze().count() == na
    # the sample is stable: same rows on a re-run
    again = bi.ingest(a, sample_fraction=0.5, force=True)["rows"]
    assert again == sampled


def test_failed_load_is_audited_and_raised(spark, scratch):
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    with pytest.raises(Exception):
        bi.ingest(f"{scratch}/does_not_exist.csv")
    rows = bi.audit().collect()
    assert [(r["source_file"], r["status"], r["row_count"]) for r in rows] == [(f"{scratch}/does_not_exist.csv", "FAILED", 0)]


def test_export_single_and_range(spark, scratch):
    lake = fixture_lake(spark, SF0001)
    ingest.export_table(lake.table("trip_cube"), f"{scratch}/cube", range_key=["date_id", "hour"], max_records_per_file=500)
    ingest.export_table(spark.read.parquet(f"{SF0001}/nation.parquet"), f"{scratch}/dim", single_file=True)
    assert len(glob.glob(f"{scratch}/dim/part-*.parquet")) == 1
    parts = sorted(glob.glob(f"{scratch}/cube/part-*.parquet"))
    assert len(parts) > 1
    back = spark.read.parquet(f"{scratch}/cube")
    assert back.count() == lake.table("trip_cube").count()


def test_named_sql_runner(spark, scratch):
    lake = fixture_lake(spark, SF0001)
    text = """
-- name: by_category
SELECT trip_category, COUNT(*) AS n FROM trips GROUP BY trip_category;

-- name: total
SELECT COUNT(*) AS n FROM trips;
"""
    trips = lake.table("fact_trips").filter(F.col("anomaly_reason").isNull())
    res = ingest.run_named_sql(spark, text, {"trips": trips}, out_dir=f"{scratch}/results")
    assert set(res) == {"by_category", "total"}
    assert sum(r["n"] for r in res["by_category"].collect()) == res["total"].first()["n"]
    assert os.path.isdir(f"{scratch}/results/total")


def test_csv_to_gold_matches_driver_tables(spark, files, scratch):
    """The same funnel whether trips come from the driver tables or from raw CSV files."""
    a, b, _, _ = files
    zpath = zone_csv(spark, SF0001, FIXTURE_RULES, f"{scratch}/zones.csv")
    bi = ingest.BronzeIngest(spark, f"{scratch}/bronze", f"{scratch}/audit")
    bi.ingest(a)
    bi.ingest(b)
    bronze = lambda: bi.bronze().drop(*ingest.BRONZE_ONLY)
    lake = TripLake(spark, bronze, lambda: ingest.read_zone_csv(spark, zpath), FIXTURE_RULES,
                    fingerprint=f"csv:{scratch}").build()
    got = {r["reason"]: r["nb_trips"] for r in lake.table("data_quality").collect()}
    want = {r["reason"]: r["nb_trips"] for r in fixture_lake(spark, SF0001).table("data_quality").collect()}
    assert got == want
