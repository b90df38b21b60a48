"""The command line on raw CSV files: pipeline, analyses and export give the
same results as the driver-table build."""

import glob
import os

from pyspark.sql import functions as F

from farebox import cli
from farebox.config import FIXTURE_RULES, TAXI_JANUARY_2019
from farebox.operators.cube import CUBE_GRAIN
from farebox.plans import analyses
from farebox.plans.catalog import all_queries
from farebox.plans.lake import fixture_lake

from .conftest import SF0001
from .helpers import trip_files, write_csv, zone_csv

FIXTURE_ARGS = ["--period-start", "1996-01-01", "--period-end", "2001-01-01", "--airports", "1,8,16",
                "--core", "ASIA"]


def test_cli_pipeline_analyses_export(spark, scratch, capsys):
    a, b, _, _ = trip_files(spark, SF0001, f"{scratch}/raw")
    zones = zone_csv(spark, SF0001, FIXTURE_RULES, f"{scratch}/zones.csv")
    base = ["--zones", zones, "--work", f"{scratch}/work", *FIXTURE_ARGS]
    cli.main(["pipeline", "--trips", f"{scratch}/raw", *base])
    out = f"{scratch}/out"
    cli.main(["analyses", *base, "--out", out, "--only", "global_kpis,quality_funnel,trip_category_mix"])
    assert sorted(os.listdir(out)) == ["global_kpis", "quality_funnel", "trip_category_mix"]
    got = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/global_kpis").first()
    want = analyses.global_kpis(spark, SF0001).first()
    assert got["nb_trips"] == want["nb_trips"] and abs(got["revenue"] - want["revenue"]) < 1e-6
    funnel = {r["reason"]: r["nb_trips"] for r in
              spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/quality_funnel").collect()}
    ref = {r["reason"]: r["nb_trips"] for r in fixture_lake(spark, SF0001).table("data_quality").collect()}
    assert funnel == ref
    cli.main(["analyses", *base, "--out", f"{scratch}/rounded", "--only", "global_kpis", "--round", "2"])
    r = spark.read.option("header", True).option("inferSchema", True).csv(f"{scratch}/rounded/global_kpis").first()
    assert r["avg_basket"] == round(want["avg_basket"], 2)
    cli.main(["export", *base, "--out", f"{scratch}/bi"])
    assert len(glob.glob(f"{scratch}/bi/dim_zone/part-*.parquet")) == 1
    assert spark.read.parquet(f"{scratch}/bi/fact_trips_agg").count() == \
        fixture_lake(spark, SF0001).table("trip_cube").count()
    # a second pipeline run skips both files (audit gate)
    cli.main(["pipeline", "--trips", f"{scratch}/raw", *base])
    assert capsys.readouterr().out.count("'SKIPPED'") == 2


def test_cli_every_analysis_sql_and_gold_on_cent_mile_trips(spark, scratch):
    """Raw trips with two-decimal distances: every analysis gives rows, the cube adds up
    to the fact exactly, gold tables and dimensions are under --work, named SQL runs."""
    a, _, _, _ = trip_files(spark, SF0001, f"{scratch}/raw0")
    raw = spark.read.option("header", True).csv(a)
    miles = F.col("trip_distance").cast("double")
    cents = F.round(miles + F.pmod(F.xxhash64("tpep_pickup_datetime"), F.lit(100)) / 100, 2)
    write_csv(raw.withColumn("trip_distance", F.when(miles > 0, cents).otherwise(miles).cast("string")), f"{scratch}/raw/t.csv")
    base = ["--zones", zone_csv(spark, SF0001, FIXTURE_RULES, f"{scratch}/zones.csv"), "--work", f"{scratch}/work", *FIXTURE_ARGS]
    cli.main(["pipeline", "--trips", f"{scratch}/raw", *base])
    assert {"staged", "silver_trips", "fact_trips", "cells", "counts", "runs", "_snapshots"} <= set(os.listdir(f"{scratch}/work/gold"))
    cli.main(["analyses", *base, "--out", f"{scratch}/out"])
    read = spark.read.option("header", True)
    done = sorted(os.listdir(f"{scratch}/out"))
    assert done == sorted(k for k, f in all_queries().items() if not f.__module__.endswith(".events"))
    assert [n for n in done if read.csv(f"{scratch}/out/{n}").isEmpty()] == []
    gaps = read.csv(f"{scratch}/out/cube_reconciliation")
    assert all(float(r["difference"]) == 0 for r in gaps.collect())
    with open(f"{scratch}/q.sql", "w") as f:
        f.write("-- name: per_hour\nSELECT hour, count(*) AS n FROM trips GROUP BY hour;\n-- name: zones\nSELECT count(*) AS n FROM dim_zone\n")
    cli.main(["sql", *base, "--sql", f"{scratch}/q.sql", "--out", f"{scratch}/sql"])
    assert sorted(os.listdir(f"{scratch}/sql")) == ["per_hour", "zones"]
    cli.main(["export", *base, "--out", f"{scratch}/bi"])
    for part in glob.glob(f"{scratch}/bi/fact_trips_agg/part-*.parquet"):
        grain = spark.read.parquet(part).coalesce(1).select(*CUBE_GRAIN).collect()
        assert grain == sorted(grain)


def test_holidays_follow_the_period():
    assert [str(d) for d, _ in cli._rules(cli_args("--period", "2020-01")).holiday_rows()] == ["2020-01-01", "2020-01-20"]
    assert cli._rules(cli_args()).holiday_rows() == TAXI_JANUARY_2019.holiday_rows()


def cli_args(*argv):
    return cli.parser().parse_args(["pipeline", "--zones", "z", "--work", "w", *argv])
