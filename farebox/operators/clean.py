"""Silver layer: validity, quarantine, deduplication, trip metrics, zone enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TripRules
from ..functions import rules as R
from ..sources.schemas import CORRUPT
from .joins import broadcast_if_small, is_small

STATUS_VALID = "valid"
STATUS_REJECTED = "rejected"
STATUS_MALFORMED = "malformed"


def tag_rejects(trips: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (first failed rule) and a ``status`` routing column.

    A line of a raw file that does not fit the schema carries its text in
    ``corrupt_line``; its bad cells are NULL. If a rule rejects it for that, the
    rule counts. If none does (the bad cell is an amount, say), it is malformed:
    kept in quarantine with its text, no trip, in no sum.
    """
    bad_line = F.col(CORRUPT).isNotNull() if CORRUPT in trips.columns else F.lit(False)
    return (trips.withColumn("reject_reason", R.reject_reason())
                 .withColumn("status", F.when(F.col("reject_reason").isNotNull(), STATUS_REJECTED)
                                        .when(bad_line, STATUS_MALFORMED).otherwise(STATUS_VALID)))


def valid_trips(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("status") == STATUS_VALID).drop("reject_reason", "status", CORRUPT)


def rejected_trips(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("status") == STATUS_REJECTED).drop("status")


def malformed_lines(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("status") == STATUS_MALFORMED).drop("reject_reason", "status")


def key_hash(rules: TripRules) -> Column:
    """64 bits of a trip key. Equal keys have equal hashes; the few others that share one are told apart by ``dedup``."""
    return F.xxhash64(*[F.col(k) for k in rules.dedup_keys])


def duplicate_keys(valid: DataFrame, rules: TripRules) -> DataFrame:
    """Hashes of trip keys that occur more than once: a hash aggregate over eight bytes a trip."""
    return (valid.groupBy(key_hash(rules).alias("key_hash")).agg(F.count(F.lit(1)).alias("copies"))
                 .filter(F.col("copies") > 1))


def dedup(valid: DataFrame, rules: TripRules, repeated: DataFrame | None = None) -> DataFrame:
    """One survivor per trip key, chosen by a total order; counts what was removed.

    Only rows whose key's hash is ``repeated`` (``duplicate_keys``; a written
    table lets its real size decide on a broadcast) are compared, by the key
    itself; all others pass through without a shuffle of their columns. A survivor is the minimum of
    ``struct(order columns, every other column)``, so the choice is
    deterministic even when the listed order columns tie. It is an aggregate,
    not a window: copies collapse on the map side, so a key holding a large
    share of the rows never lands whole in one task.
    """
    keys = list(rules.dedup_keys)
    order = [c for c in rules.dedup_order if c in valid.columns]
    rest = [c for c in valid.columns if c not in keys and c not in order]
    fields = order + rest
    if repeated is None:
        repeated = duplicate_keys(valid, rules)
    twice = broadcast_if_small(repeated.select(F.col("key_hash").alias("_hash")))
    same = key_hash(rules) == F.col("_hash")
    single = valid.join(twice, same, "left_anti").withColumn("duplicates_removed", F.lit(0).cast("bigint"))
    agg = (valid.join(twice, same, "left_semi").groupBy(*keys)
                .agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_s"),
                     F.count(F.lit(1)).alias("_n")))
    kept = agg.select(
        *keys,
        *[F.col("_s")[c].alias(c) for c in fields],
        (F.col("_n") - 1).alias("duplicates_removed"),
    )
    return single.select(*valid.columns, "duplicates_removed").union(kept.select(*valid.columns, "duplicates_removed"))


def add_trip_metrics(df: DataFrame) -> DataFrame:
    secs = F.col("trip_duration_seconds")
    minutes = secs / F.lit(60.0)
    return (df.withColumn("trip_duration_seconds", R.trip_seconds())
              .withColumns({
                  "trip_duration_minutes": minutes,
                  "avg_speed_mph": F.when(secs > 0, F.col("trip_distance") / (minutes / F.lit(60.0))),
                  "pickup_hour": F.hour("pickup_ts"),
                  "pickup_dow": R.iso_day_of_week("pickup_ts"),
              }))


def zone_roles(zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The zone lookup as pickup and as dropoff."""
    return (zones.select(F.col("location_id").alias("pu_location_id"),
                         F.col("borough").alias("pickup_borough"),
                         F.col("zone").alias("pickup_zone")),
            zones.select(F.col("location_id").alias("do_location_id"),
                         F.col("borough").alias("dropoff_borough"),
                         F.col("zone").alias("dropoff_zone")))


def enrich_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Left joins with the zone lookup in its two roles (pickup, dropoff).

    The lookup holds one row per zone and is broadcast once its estimated size
    is checked (the trip side is then never shuffled for enrichment); a lookup
    over the limit falls back to a shuffled join.
    """
    pu, do = zone_roles(zones)
    return (df.join(broadcast_if_small(pu), "pu_location_id", "left")
              .join(broadcast_if_small(do), "do_location_id", "left"))


def silver(valid: DataFrame, zones: DataFrame, rules: TripRules, repeated: DataFrame | None = None,
           gather: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Valid trips, deduplicated, with metrics and both zone roles.

    ``gather`` lays the rows out for the write. It moves them before they get
    the metrics and zone names, half of a row's bytes; a lookup too large to be
    broadcast moves rows itself, and they are gathered after it.
    """
    rows = dedup(valid, rules, repeated)
    if gather is None:
        return enrich_zones(add_trip_metrics(rows), zones)
    if all(is_small(role) for role in zone_roles(zones)):
        return enrich_zones(add_trip_metrics(gather(rows)), zones)
    return gather(enrich_zones(add_trip_metrics(rows), zones))
