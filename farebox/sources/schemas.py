"""Canonical schemas: raw taxi CSV, canonical trips, zone lookup."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 6)

# Raw TLC yellow-trip CSV header, 18 columns, all nullable. Money and distance
# are parsed straight into DECIMAL so sums stay exact from the first byte.
TLC_TRIP_CSV_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", MONEY),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", MONEY),
    T.StructField("extra", MONEY),
    T.StructField("mta_tax", MONEY),
    T.StructField("tip_amount", MONEY),
    T.StructField("tolls_amount", MONEY),
    T.StructField("improvement_surcharge", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("congestion_surcharge", MONEY),
])
# The same with the text of a line that doesn't fit it.
CORRUPT = "corrupt_line"
TLC_TRIP_CSV_READ = T.StructType([*TLC_TRIP_CSV_SCHEMA, T.StructField(CORRUPT, T.StringType())])

# TLC header name -> canonical column name.
TLC_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}

# Canonical trip columns, in order. `trip_ref` is a lineage id used as the
# last dedup tie-break; `source_file` records where the row came from.
TRIP_COLUMNS = (
    "vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance",
    "rate_code_id", "store_and_fwd_flag", "pu_location_id", "do_location_id",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "trip_ref",
)

MONEY_COLUMNS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
)

ZONE_LOOKUP_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
