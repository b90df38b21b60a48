"""Structured Streaming versions of the ingest and hourly analyses.

* S1 ``ingest_files``: file source -> bronze Parquet, append, each file once
  (the checkpoint is the incremental gate), run to completion with
  ``availableNow``.
* S2 ``dedup_within_watermark``: the dedup keys, state bounded by a watermark.
  ``lanes`` does the same keeping what this leaves out, late rows too.
* S3 ``route_batches``: ``foreachBatch`` writes a micro-batch once, partitioned by
  status, with an audit row keyed on query and batch id, so a replayed batch
  is not counted twice and two checkpoints never take each other's batches for replays.
* S4 ``hourly_zone_demand``: tumbling one-hour windows per pickup zone, in
  append mode (closed windows); ``window_log`` has update mode (every window).

The period rule runs *before* every watermark: a stray future timestamp would
otherwise advance the watermark and drop later valid rows. Rows it leaves out
are ``stray_rows``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import TripRules
from ..functions import rules as R
from ..operators.clean import tag_rejects
from ..session import path_exists
from ..sources.ingest import canonical_trips
from ..sources.schemas import TLC_TRIP_CSV_SCHEMA


def read_trip_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(TLC_TRIP_CSV_SCHEMA).option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.csv(source_dir).withColumn("source_file", F.col("_metadata.file_path"))
    return canonical_trips(raw)


def ingest_files(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str) -> StreamingQuery:
    """S1: append every new file once; returns the (finished) query."""
    q = (read_trip_stream(spark, source_dir)
         .withColumn("ingested_at", F.current_timestamp())
         .writeStream.format("parquet").option("path", bronze_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def event_time(df: DataFrame) -> DataFrame:
    """Watermarks need TIMESTAMP: pickup times are read as UTC, whatever the session's zone."""
    return df.withColumn("event_ts", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("pickup_ts")).cast("timestamp"))


def in_period(rules: TripRules):
    start = F.lit(rules.period_start).cast("timestamp_ntz")
    end = F.lit(rules.period_end).cast("timestamp_ntz")
    return (F.col("pickup_ts") >= start) & (F.col("pickup_ts") < end)


def stray_rows(df: DataFrame, rules: TripRules) -> DataFrame:
    """Rows without a pickup time inside the analysed period."""
    return df.filter(~F.coalesce(in_period(rules), F.lit(False)))


def dedup_within_watermark(df: DataFrame, rules: TripRules, delay: str = "2 hours") -> DataFrame:
    """S2: drop copies of a trip key seen within the watermark delay; strays never reach the watermark."""
    return (event_time(df.filter(in_period(rules))).withWatermark("event_ts", delay)
            .dropDuplicatesWithinWatermark(list(rules.dedup_keys)))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint: another checkpoint has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def route_batches(spark: SparkSession, stream: DataFrame, out_path: str, audit_path: str, checkpoint: str) -> StreamingQuery:
    """S3: one sink partitioned by (query_id, batch_id, status) and an idempotent audit row per batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = query_id(spark, checkpoint)
        if path_exists(spark, audit_path):
            seen = spark.read.parquet(audit_path).filter((F.col("query_id") == query) & (F.col("batch_id") == batch_id))
            if not seen.isEmpty():
                return
        # a batch that died between the sink and the audit row is rewritten, never doubled
        seen = Observation(f"routed_{query}_{batch_id}")
        tagged = tag_rejects(batch).observe(seen, F.count_if(F.col("reject_reason").isNull()).alias("valid"),
                                            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))
        (tagged.withColumns({"query_id": F.lit(query), "batch_id": F.lit(batch_id).cast("long")})
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("query_id", "batch_id", "status").parquet(out_path))
        counts = seen.get
        (spark.range(1).select(F.lit(query).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"),
                               F.lit(counts["valid"]).cast("long").alias("valid"), F.lit(counts["rejected"]).cast("long").alias("rejected"),
                               F.current_timestamp().alias("processed_at"))
              .write.mode("append").parquet(audit_path))

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def routed(spark: SparkSession, out_path: str, status: str) -> DataFrame:
    """Rows of a status from a routed sink (partition pruning)."""
    return spark.read.parquet(out_path).filter(F.col("status") == status)


def hourly_zone_demand(stream: DataFrame, rules: TripRules, delay: str = "1 hour") -> DataFrame:
    """S4: trips and revenue per (pickup zone, one-hour window).

    Input: canonical trips. Invalid and out-of-period rows are filtered before
    the watermark is declared.
    """
    clean = stream.filter(R.reject_reason().isNull() & in_period(rules))
    return (event_time(clean).withWatermark("event_ts", delay)
            .groupBy(F.window("event_ts", "1 hour").alias("w"), F.col("pu_location_id"))
            .agg(F.count(F.lit(1)).alias("nb_trips"), F.sum("total_amount").alias("revenue"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "pu_location_id", "nb_trips", "revenue"))


def run_hourly_zone_demand(spark: SparkSession, source_dir: str, rules: TripRules, out_path: str,
                           checkpoint: str, delay: str = "1 hour", max_files_per_trigger: int | None = None) -> StreamingQuery:
    q = (hourly_zone_demand(read_trip_stream(spark, source_dir, max_files_per_trigger), rules, delay)
         .writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
