"""Deduplicated trips from a stream with nothing lost (S2).

Every micro-batch is split into lanes before any state is asked:

* ``stray``: no pickup time in the analysed period; it never moves the watermark;
* ``rejected``: a validity rule fails;
* ``late``: picked up before the batch's watermark, i.e. more than ``delay``
  before the latest pickup of all batches before it;
* ``duplicate``: its trip key was kept before, or stands for further copies;
* ``kept``: one row per trip key (the smallest by the dedup order, as in batch).

A batch is one folder of the sink with a folder per lane, written over if the
batch is replayed, and a log entry that holds its counts, the latest pickup so
far and the batches that later ones have to look at. The pickup time is part of
the trip key, so copies of a row that isn't late were kept at its very time:
only batches that reach beyond the watermark are compared, which bounds the
state by ``delay`` and not by the length of the stream.

in = kept + duplicates + late + rejected + stray, for every batch. Rows of one key are
combined on the map side, so a key that holds much of a batch isn't one task.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import TripRules
from ..functions import rules as R
from ..session import read_text, write_text
from .trips_stream import event_time, in_period, query_id, read_trip_stream

LANES = ("kept", "duplicate", "late", "rejected", "stray")
COUNTS = ("kept", "duplicates", "late", "rejected", "stray")


def _split(batch: DataFrame, rules: TripRules, watermark) -> DataFrame:
    lane = (F.when(~F.coalesce(in_period(rules), F.lit(False)), "stray")
            .when(R.reject_reason().isNotNull(), "rejected")
            .when(F.col("event_ts") < watermark, "late").otherwise("kept"))
    return event_time(batch).withColumn("lane", lane)


def _one_per_key(rows: DataFrame, rules: TripRules) -> DataFrame:
    """The smallest row of each trip key and how many copies it stands for."""
    keys = list(rules.dedup_keys)
    order = [c for c in rules.dedup_order if c in rows.columns]
    rest = [c for c in rows.columns if c not in keys and c not in order]
    g = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_s"), F.count(F.lit(1)).alias("copies"))
    return g.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in [*order, *rest]], "copies").select(*rows.columns, "copies")


class Lanes:
    """The sink of a stream and what its batches have left there."""

    def __init__(self, spark: SparkSession, sink: str, checkpoint: str):
        self.spark, self.sink, self.checkpoint = spark, sink.rstrip("/"), checkpoint

    def _folder(self, query: str, batch: int) -> str:
        return f"{self.sink}/rows/query_id={query}/batch_id={batch}"

    def log(self, query: str, batch: int) -> dict | None:
        text = read_text(self.spark, f"{self.sink}/log/{query}/{batch}.json")
        return json.loads(text) if text else None

    def handle(self, batch: DataFrame, batch_id: int, rules: TripRules, delay_seconds: int) -> None:
        query = query_id(self.spark, self.checkpoint)
        if self.log(query, batch_id):
            return                                        # replayed after its log entry
        before = self.log(query, batch_id - 1) or {"latest": None, "open": []}
        latest = before["latest"]                          # microseconds, over all batches before
        mark = None if latest is None else latest - delay_seconds * 1_000_000
        watermark = F.timestamp_micros(F.lit(mark).cast("bigint"))
        rows = _split(batch, rules, watermark)
        on_time = _one_per_key(rows.filter("lane = 'kept'"), rules)
        open_batches = [b for b in before["open"] if mark is not None and b[1] >= mark]
        if open_batches:
            keys = list(rules.dedup_keys)
            paths = [f"{self._folder(query, b)}/lane=kept" for b, _ in open_batches]
            known = (self.spark.read.schema(batch.select(*keys).schema).parquet(*paths)
                     .select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_known")))
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            on_time = (on_time.join(known, same, "left").withColumn("lane", F.when(F.col("_known"), "duplicate").otherwise("kept"))
                       .select(*on_time.columns))
        out = on_time.unionByName(rows.filter("lane <> 'kept'").withColumn("copies", F.lit(1).cast("bigint")))
        seen = Observation(f"lanes_{query}_{batch_id}")
        lane, n = F.col("lane"), F.col("copies")
        total = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0))
        copies = total(lane == "kept", n - 1) + total(lane == "duplicate", n)
        out = out.observe(seen, total(lane == "kept", F.lit(1)).alias("kept"), copies.alias("duplicates"),
                          *[total(lane == x, F.lit(1)).alias(x) for x in ("late", "rejected", "stray")],
                          F.max(F.when(lane.isin("kept", "duplicate"), F.unix_micros("event_ts"))).alias("latest"))
        out.write.mode("overwrite").partitionBy("lane").parquet(self._folder(query, batch_id))
        got = seen.get
        mine = [[batch_id, got["latest"]]] if got["kept"] else []
        newest = max([x for x in (latest, got["latest"]) if x is not None], default=None)
        write_text(self.spark, f"{self.sink}/log/{query}/{batch_id}.json", json.dumps(
            {"counts": {c: got[c] for c in COUNTS}, "latest": newest, "open": open_batches + mine}))

    def counts(self) -> list[dict]:
        """Counts of every logged batch."""
        query, out = query_id(self.spark, self.checkpoint), []
        while (entry := self.log(query, len(out))) is not None:
            out.append(entry["counts"])
        return out

    def lane(self, name: str) -> DataFrame:
        """Rows of a lane (partition pruning); ``copies`` is how many rows of the stream one stands for."""
        return self.spark.read.parquet(f"{self.sink}/rows").filter(F.col("lane") == name)


def run_dedup(spark: SparkSession, source_dir: str, rules: TripRules, sink: str, checkpoint: str, delay_seconds: int = 7200,
              max_files_per_trigger: int | None = None) -> dict[str, int]:
    """Runs the stream over all pending files; counts over all batches of this checkpoint."""
    lanes = Lanes(spark, sink, checkpoint)
    q = (read_trip_stream(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(lambda batch, batch_id: lanes.handle(batch, batch_id, rules, delay_seconds))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    done = lanes.counts()
    return {c: sum(b[c] for b in done) for c in COUNTS}
