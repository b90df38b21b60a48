"""Hourly windows in update mode (S4): a log of changes over a compacted base.

Every micro-batch writes the windows it changed into its own folder (written
over on replay). Compaction folds base and changes into a new base, the newest
version of each window and zone, and publishes it as a snapshot that says which
batches it holds. Readers read the base and the batches after it, however long
the stream has run; ``vacuum`` removes folded batches and old bases by age.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TripRules
from ..sources.snapshots import Snapshots, remove, subfolders
from .trips_stream import StreamingQuery, hourly_zone_demand, query_id, read_trip_stream

KEYS = ("window_start", "window_end", "pu_location_id")
VALUES = ("nb_trips", "revenue")
COMPACT_EVERY = 50
_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()), T.StructField("pu_location_id", T.IntegerType()),
    T.StructField("nb_trips", T.LongType()), T.StructField("revenue", T.DecimalType(28, 6)),
    T.StructField("written_at", T.TimestampType()), T.StructField("batch_id", T.LongType())])


class WindowLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.snapshots = Snapshots(spark, path)

    def _delta(self, query: str, batch: int) -> str:
        return f"{self.path}/delta/query_id={query}/batch={batch}"

    def append(self, changed: DataFrame, query: str, batch_id: int) -> None:
        rows = changed.withColumns({"written_at": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("long")})
        rows.select(*[F.col(f.name).cast(f.dataType) for f in _SCHEMA]).write.mode("overwrite").parquet(self._delta(query, batch_id))

    def _batches(self) -> dict[str, list[int]]:
        out = {}
        for q in subfolders(self.spark, f"{self.path}/delta"):
            name = q.split("=", 1)[1]
            out[name] = sorted(int(b.split("=", 1)[1]) for b in subfolders(self.spark, f"{self.path}/delta/{q}"))
        return out

    def open_batches(self, manifest: dict | None) -> dict[str, list[int]]:
        """Batches that the base of ``manifest`` doesn't hold."""
        upto = manifest["upto"] if manifest else {}
        return {q: [b for b in have if b > upto.get(q, -1)] for q, have in self._batches().items()}

    def paths(self, manifest: dict | None) -> list[str]:
        """What a reader of ``manifest`` touches."""
        base = [f"{self.path}/base/build={manifest['base']}"] if manifest else []
        return base + [self._delta(q, b) for q, have in self.open_batches(manifest).items() for b in have]

    def _latest(self, manifest: dict | None) -> DataFrame:
        paths = self.paths(manifest)
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], _SCHEMA)
        newest = F.max_by(F.struct(*VALUES, "written_at", "batch_id"), F.struct("written_at", "batch_id")).alias("v")
        return rows.groupBy(*KEYS).agg(newest).select(*KEYS, "v.*")

    def read(self) -> DataFrame:
        """Newest version of each window and zone, of several queries the last writer's."""
        return self._latest(self.snapshots.latest()).select(*KEYS, *VALUES)

    def compact(self) -> dict:
        """Folds all batches there are into a new base and publishes it; batches that come meanwhile stay open."""
        parent, base = self.snapshots.latest(), uuid.uuid4().hex
        todo = self.open_batches(parent)
        upto = (parent["upto"] if parent else {}) | {q: have[-1] for q, have in todo.items() if have}
        self._latest(parent).write.parquet(f"{self.path}/base/build={base}")
        return self.snapshots.publish({"base": base, "upto": upto, "builds": [base]}, parent)

    def vacuum(self, older_than_seconds: float, now: float | None = None) -> None:
        """Removes bases that expired, and batches that every base left holds."""
        now = time.time() if now is None else now
        self.snapshots.expire(older_than_seconds, now)
        left = [self.snapshots.read(n) for n in self.snapshots.numbers()]
        if not left or left[0]["published"] > now - older_than_seconds:
            return                       # a reader may have begun before the oldest base was there
        for q, have in self._batches().items():
            for b in have:
                if b <= left[0]["upto"].get(q, -1):
                    remove(self.spark, self._delta(q, b))


def run_hourly_zone_demand_updates(spark: SparkSession, source_dir: str, rules: TripRules, out_path: str, checkpoint: str, delay: str = "1 hour",
                                   max_files_per_trigger: int | None = None, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Every micro-batch's changed windows go to the log; every ``compact_every``-th folds it. Open windows are visible too."""
    log = WindowLog(spark, out_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, query_id(spark, checkpoint), batch_id)
        if (batch_id + 1) % compact_every == 0:
            log.compact()

    q = (hourly_zone_demand(read_trip_stream(spark, source_dir, max_files_per_trigger), rules, delay)
         .writeStream.outputMode("update").foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest_hourly_zone_demand(spark: SparkSession, out_path: str) -> DataFrame:
    return WindowLog(spark, out_path).read()
