"""Stand-in trips and zones derived from the driver's TPC-H-like tables.

Raw monthly taxi files are not part of the test data, so correctness runs on
trips that Spark derives deterministically from ``lineitem ⋈ orders ⋈ supplier
⋈ customer`` (one trip per line item). Zones are nations, boroughs are regions.
A few extra slices are *added* on top of the full base (never filtered out of
it) so that every reject rule, the dedup survivor order and the missing-value
paths are exercised; the base itself is always the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TripRules
from .schemas import MONEY

# Fixed values of the stand-in mapping (multipliers and moduli of the
# deterministic trip generator; the oracle SQL uses the same numbers).
PICKUP_OFFSET_PART_MULT = 7919
PICKUP_OFFSET_ORDER_MULT = 104729
SECONDS_PER_DAY = 86400
DURATION_ORDER_MULT = 31
DURATION_PART_MULT = 17
DURATION_MODULUS = 12000
DURATION_SHIFT = 300
PASSENGER_MODULUS = 7
VENDOR_MODULUS = 3
REFUND_MIN_QUANTITY = 45
COPY_MODULUS = 97         # rows added twice: exact copy and copy with other amounts
MISSING_ZONE_MODULUS = 101
MISSING_TIME_MODULUS = 103

MICRO = "0.000001"  # one micro-unit of money


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that arrives in fewer splits than the cluster has cores.

    A many-file input is already split and is returned untouched (no extra
    shuffle at scale); a single-row-group file would otherwise run every
    downstream narrow operator in one task. Hash partitioning on the row's
    columns is deterministic under retries without the local sort that a
    round-robin repartition performs first.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:       # no RDD view of the plan (remote session): leave as is
        return df
    return df.repartition(cores, *df.columns) if splits < cores else df


def _money(units: Column) -> Column:
    """Integer micro-units -> DECIMAL(18,6), exactly."""
    return (units.cast("decimal(18,0)") * F.lit(MICRO).cast("decimal(7,6)")).cast(MONEY)


def base_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One canonical trip per line item, over the whole tables."""
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag"))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    # Left joins: a line item without its order, supplier or customer stays a
    # trip, whose missing time or zone the rules reject and the funnel counts.
    # Orders meet their customers first, so that the line items cross the
    # network once, for their order, and as the few small values a trip needs.
    # Join kinds are left to the optimizer (sort-merge or, when the scan
    # statistics fit the broadcast threshold, broadcast).
    od = (od.join(cu, od.o_custkey == cu.c_custkey, "left")
            .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey"))
    refund = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > REFUND_MIN_QUANTITY)
    li = li.join(su, li.l_suppkey == su.s_suppkey, "left").select(
        "l_orderkey", "l_partkey", "s_nationkey", "l_quantity",
        (F.col("l_suppkey") % VENDOR_MODULUS + 1).cast("int").alias("vendor_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("_cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("_disc"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("_tax"),
        refund.alias("_refund"))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "left")

    off = (F.col("l_partkey") * PICKUP_OFFSET_PART_MULT
           + F.col("l_orderkey") * PICKUP_OFFSET_ORDER_MULT) % SECONDS_PER_DAY
    dur = (F.col("l_orderkey") * DURATION_ORDER_MULT
           + F.col("l_partkey") * DURATION_PART_MULT) % DURATION_MODULUS - DURATION_SHIFT
    j = j.withColumns({"_off": off, "_dur": dur})
    fare_units = F.col("_cents") * 100
    zero = F.lit(0).cast(MONEY)
    return j.select(
        "vendor_id",
        F.timestamp_add("SECOND", F.col("_off"), F.col("o_orderdate")).alias("pickup_ts"),
        F.timestamp_add("SECOND", F.col("_off") + F.col("_dur"), F.col("o_orderdate")).alias("dropoff_ts"),
        ((F.col("l_orderkey") + F.col("l_partkey")) % PASSENGER_MODULUS).cast("int").alias("passenger_count"),
        ((F.col("l_quantity") - 1) / 2).alias("trip_distance"),
        F.lit(1).cast("int").alias("rate_code_id"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("s_nationkey").cast("int").alias("pu_location_id"),
        F.col("c_nationkey").cast("int").alias("do_location_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        _money(F.when(F.col("_refund"), -fare_units).otherwise(fare_units)).alias("fare_amount"),
        zero.alias("extra"),
        _money(F.col("_cents") * F.col("_tax")).alias("mta_tax"),
        _money(F.col("_cents") * F.col("_disc")).alias("tip_amount"),
        zero.alias("tolls_amount"),
        zero.alias("improvement_surcharge"),
        _money(F.col("_cents") * (100 + F.col("_disc") + F.col("_tax"))).alias("total_amount"),
        zero.alias("congestion_surcharge"),
        F.col("l_orderkey").alias("trip_ref"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole base plus the added test slices (copies and missing values).

    One scan and one join: each base row expands into itself plus the variants
    it qualifies for (a generator, not a union of re-joined branches).
    """
    t = base_trips(spark, sf_dir)
    one = F.lit(1).cast(MONEY)
    ref = F.col("trip_ref")
    variants = F.array_compact(F.array(
        F.lit(0),
        F.when(ref % COPY_MODULUS == 0, F.lit(1)),          # exact copy
        F.when(ref % COPY_MODULUS == 0, F.lit(2)),          # copy with other amounts
        F.when(ref % MISSING_ZONE_MODULUS == 0, F.lit(3)),  # pickup zone missing
        F.when(ref % MISSING_TIME_MODULUS == 0, F.lit(4)),  # pickup time missing
    ))
    v = F.col("_variant")
    return (t.withColumn("_variant", F.explode(variants))
             .withColumns({
                 "tip_amount": F.when(v == 2, (F.col("tip_amount") + one).cast(MONEY)).otherwise(F.col("tip_amount")),
                 "total_amount": F.when(v == 2, (F.col("total_amount") + one).cast(MONEY))
                                  .otherwise(F.col("total_amount")),
                 "pu_location_id": F.when(v == 3, F.lit(None).cast("int")).otherwise(F.col("pu_location_id")),
                 "pickup_ts": F.when(v == 4, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("pickup_ts")),
                 "source_file": F.lit("fixture"),
             })
             .drop("_variant"))


def zone_lookup(spark: SparkSession, sf_dir: str, rules: TripRules) -> DataFrame:
    """Zone lookup in the taxi-zone shape: location_id, borough, zone, service_zone."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    z = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    airports = list(rules.airport_zone_ids)
    return z.select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_nationkey").isin(airports), "Airports")
         .when(F.col("r_name") == rules.core_borough, "Yellow Zone")
         .otherwise("Boro Zone").alias("service_zone"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` seen as trips: ts -> pickup, value -> amount, type -> category, user -> zone."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("pickup_ts"),
        F.col("user_id").alias("location_id"),
        F.col("event_type").alias("category"),
        # value has two decimals: carry it as exact cents so sums do not depend
        # on the order in which partitions are combined.
        (F.round(F.col("value") * 100).cast("bigint").cast("decimal(18,0)")
         * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)").alias("amount"),
    )
