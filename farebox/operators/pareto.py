"""Ranks and running shares over many keys without a single-task window.

``SUM(v) OVER (ORDER BY v DESC) / SUM(v) OVER ()`` with the default RANGE frame
(ties share one cumulative value) and ``RANK() OVER (ORDER BY v DESC)``:

1. ties collapse: one row per distinct value, with the number of keys;
2. distinct values are range-partitioned on the value, in as many ranges as
   their size needs (Spark samples the bounds), and written with the number of
   their range, so that every reader sees the same ranges;
3. a range's keys and sum are added to all lower ranges (one row per range);
4. inside a range a window adds the running sum and the rank.

No task holds more than one range, however many keys there are, and no key list
reaches the driver. Values that fit one range (by the optimizer's estimate) are
ranked by a plain window, without the write.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .joins import estimated_bytes

RANGE_BYTES = 32 << 20


def ranges_needed(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """Ranges of about ``range_bytes``; the estimate is of stored bytes, taken as four times smaller than rows in a task."""
    size = estimated_bytes(rows)
    return max(1, math.ceil(4 * size / range_bytes)) if size is not None and size < 1 << 50 else rows.sparkSession.sparkContext.defaultParallelism


def by_range(rows: DataFrame, value: str, ranges: int) -> DataFrame:
    """``rows`` with ``part``: the range of their value, 0 for the largest. Written to the shared checkpoint folder."""
    spark = rows.sparkSession
    path = f"{checkpoint_root(spark)}/farebox-ranges/{uuid.uuid4().hex}"
    rows.repartitionByRange(ranges, F.col(value).desc()).withColumn("part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def ranked_values(per_key: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """One row per distinct ``value``: n_keys, rank (1 + keys of larger values), running (ties included) and total."""
    values = (per_key.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n_keys"))
              .withColumn("_mass", F.col(value) * F.col("n_keys")))
    if (ranges or ranges_needed(values)) == 1:
        upto = Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return values.select(value, "n_keys", (F.sum("n_keys").over(upto) - F.col("n_keys") + 1).alias("rank"),
                             F.sum("_mass").over(upto).alias("running"), F.sum("_mass").over(Window.partitionBy()).alias("total"))
    placed = by_range(values, value, ranges or ranges_needed(values))
    lower = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.sum("_mass").alias("mass"), F.sum("n_keys").alias("keys")).select(
        "part", F.coalesce(F.sum("mass").over(lower), F.lit(0)).alias("_mass_before"),
        F.coalesce(F.sum("keys").over(lower), F.lit(0)).alias("_keys_before"), F.sum("mass").over(Window.partitionBy()).alias("total"))
    upto = Window.partitionBy("part").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.join(F.broadcast(offsets), "part")            # one row per range
            .select(value, "n_keys", (F.col("_keys_before") + F.sum("n_keys").over(upto) - F.col("n_keys") + 1).alias("rank"),
                    (F.col("_mass_before") + F.sum("_mass").over(upto)).alias("running"), "total"))


def running_share(per_key: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """``ranked_values`` with the share of the total that the value and all larger ones make."""
    return ranked_values(per_key, value, ranges).withColumn(
        "share", F.try_divide(F.col("running").cast("double"), F.col("total").cast("double")))


def ranked_keys(per_key: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """``per_key`` with the ``rank`` of its value (ties share the lowest, as RANK does); null values rank last.

    The rows meet the ranks on the value; a value that many keys share is split by the adaptive skew join.
    """
    if (ranges or ranges_needed(per_key)) == 1:
        return per_key.withColumn("rank", F.rank().over(Window.orderBy(F.col(value).desc())))
    ranks = ranked_values(per_key, value, ranges).select(F.col(value).alias("_value"), F.col("rank").cast("int").alias("rank"))
    last = per_key.agg((F.count(value) + 1).cast("int")).scalar()
    return (per_key.join(ranks, F.col(value) == F.col("_value"), "left").drop("_value")
            .withColumn("rank", F.coalesce("rank", last)))


def threshold_counts(per_key: DataFrame, value: str, thresholds: Sequence[float], label: str,
                     ranges: int | None = None) -> DataFrame:
    """Keys needed to reach each share: count(share <= t) + 1, and the active keys."""
    rs = running_share(per_key, value, ranges)
    aggs = [F.coalesce(F.sum("n_keys"), F.lit(0)).alias(f"active_{label}")]
    for t in thresholds:
        pct = round(t * 100)
        # published definition: keys at or under the threshold, plus the one crossing it
        aggs.append((F.coalesce(F.sum(F.when(F.col("share") <= F.lit(float(t)), F.col("n_keys"))), F.lit(0))
                     + 1).alias(f"{label}_for_{pct}pct"))
        # keys needed to reach the threshold (differs only when a share equals it exactly)
        aggs.append((F.coalesce(F.sum(F.when(F.col("share") < F.lit(float(t)), F.col("n_keys"))), F.lit(0))
                     + 1).alias(f"{label}_to_reach_{pct}pct"))
    return rs.agg(*aggs)
