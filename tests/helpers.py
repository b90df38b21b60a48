"""Test inputs: driver-derived trips written as raw TLC-format CSV files."""

import glob
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from farebox.sources import fixture
from farebox.sources.schemas import TLC_RENAMES, TLC_TRIP_CSV_SCHEMA

CANON_TO_TLC = {v: k for k, v in TLC_RENAMES.items()}


def to_tlc(df):
    out = df
    for canon, tlc in CANON_TO_TLC.items():
        out = out.withColumnRenamed(canon, tlc)
    return out.select(*[F.col(f.name).cast("string").alias(f.name) for f in TLC_TRIP_CSV_SCHEMA])


def write_csv(df, target_file):
    """One header CSV file at ``target_file`` (test fixture only)."""
    tmp = tempfile.mkdtemp(prefix="farebox-csv-")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp + "/out")
    part = glob.glob(tmp + "/out/part-*.csv")[0]
    os.makedirs(os.path.dirname(target_file), exist_ok=True)
    shutil.copyfile(part, target_file)
    return target_file


def trip_files(spark, sf_dir, folder):
    """Two raw files split by pickup year (NULL pickups go to the first)."""
    raw = fixture.raw_trips(spark, sf_dir)
    early = F.coalesce(F.year("pickup_ts"), F.lit(0)) <= 1997
    a = write_csv(to_tlc(raw.filter(early)), f"{folder}/trips_a.csv")
    b = write_csv(to_tlc(raw.filter(~early)), f"{folder}/trips_b.csv")
    return a, b, raw.filter(early).count(), raw.filter(~early).count()


def zone_csv(spark, sf_dir, rules, path):
    z = fixture.zone_lookup(spark, sf_dir, rules).select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"), "service_zone")
    return write_csv(z, path)
