"""Medallion build: raw trips -> staged (bronze + reject tags) -> silver -> gold.

Each layer is a Spark job writing Parquet under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``). Written tables cut the lineage,
so a lost executor only recomputes from the last written layer, and every
analysis reads the gold tables with column pruning and filter pushdown, as the
SQL layer of a warehouse would.

A build is keyed by its inputs (paths, sizes, modification times), the rule
parameters and an explicit version, so a finished build is reused and any change
rebuilds.
"""

from __future__ import annotations

import hashlib
import os
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_RULES, TripRules
from ..operators import clean, cube, days, quality, star
from ..session import checkpoint_root, file_fingerprint, path_exists, session_conf
from ..sources import fixture

TABLES = ("staged", "silver_trips", "fact_trips", "trip_cube", "day_states", "data_quality")


#: Version of the rules' code and of the layers' layout: raise it when either changes results.
BUILD_VERSION = "6"
#: Partition columns of silver and fact: the month of the pickup.
MONTH = ("pickup_year", "pickup_month")

#: Layers are read a few times and hold every trip: fewer bytes on the shared storage.
CODEC = "zstd"
#: Trips are sorted into fact files by splits of this size, about a million rows: no sort outgrows a task's memory.
SORT_SPLIT = "32m"


def by_month(trips: DataFrame) -> DataFrame:
    """``trips`` with their month, gathered by it: AQE joins small months and splits large ones, so a month is a few
    files and a hot month is never one task."""
    dated = trips.withColumns({MONTH[0]: F.year("pickup_ts"), MONTH[1]: F.month("pickup_ts")})
    return dated.hint("rebalance", *[F.col(c) for c in MONTH])


class TripLake:
    """The built tables of one trip source under one set of rules."""

    def __init__(self, spark: SparkSession, raw: Callable[[], DataFrame], zones: Callable[[], DataFrame],
                 rules: TripRules, fingerprint: str):
        self.spark = spark
        self.rules = rules
        self._raw = raw
        self._zones = zones
        key = hashlib.sha1(f"{fingerprint}|{rules!r}|{BUILD_VERSION}".encode()).hexdigest()[:20]
        self.root = f"{checkpoint_root(spark)}/farebox-lake/{key}"
        self.metrics: dict[str, dict] = {}
        self._handles: dict[str, DataFrame] = {}
        self._zone_df: DataFrame | None = None

    # -- construction -------------------------------------------------------
    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, rules: TripRules = FIXTURE_RULES) -> TripLake:
        sf_dir = os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir
        names = ("lineitem", "orders", "supplier", "customer", "nation", "region")
        fp = "|".join(file_fingerprint(spark, f"{sf_dir}/{n}.parquet") for n in names)
        return cls(spark, lambda: fixture.raw_trips(spark, sf_dir),
                   lambda: fixture.zone_lookup(spark, sf_dir, rules), rules, fp)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def complete_marker(self) -> str:
        return f"{self.root}/_COMPLETE"

    def is_built(self) -> bool:
        return path_exists(self.spark, self.complete_marker)

    def zones(self) -> DataFrame:
        if self._zone_df is None:
            self._zone_df = self._zones()
        return self._zone_df

    # -- build ---------------------------------------------------------------
    def _write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), force: bool = False) -> None:
        """Write one layer. A layer already finished under this build key (same
        inputs, rules and version) is kept, so an interrupted build resumes."""
        if not force and path_exists(self.spark, f"{self.path(name)}/_SUCCESS"):
            self.metrics[name] = {"reused": True}
            return
        obs = Observation(name)
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", CODEC)
        if partition_by:
            w = w.partitionBy(*partition_by)
        t0 = time.perf_counter()
        w.parquet(self.path(name))
        self.metrics[name] = dict(obs.get, seconds=round(time.perf_counter() - t0, 3))

    def build(self, force: bool = False) -> TripLake:
        if self.is_built() and not force:
            return self
        self._handles.clear()
        spark, rules = self.spark, self.rules
        # bronze + reject tags, written once and routed by partition (one scan
        # of the source serves both the quarantine and the valid path)
        # two partition values: concurrent writers instead of sorting each task by status
        with session_conf(spark, spark__sql__maxConcurrentOutputFileWriters="4"):
            self._write(clean.tag_rejects(self._raw()), "staged", partition_by=("status",), force=force)
        staged = spark.read.parquet(self.path("staged"))
        valid = clean.valid_trips(staged)
        self._write(clean.duplicate_keys(valid, rules), "duplicate_keys", force=force)
        repeated = spark.read.parquet(self.path("duplicate_keys"))
        self._write(clean.silver(valid, self.zones(), rules, repeated, gather=by_month), "silver_trips", partition_by=MONTH, force=force)
        silver = spark.read.parquet(self.path("silver_trips"))
        # clustered by day inside each file: date ranges skip row groups
        with session_conf(spark, spark__sql__files__maxPartitionBytes=SORT_SPLIT):
            self._write(star.fact_trips(silver, rules, *MONTH).sortWithinPartitions(*MONTH, "date_id"), "fact_trips", partition_by=MONTH, force=force)
        fact = spark.read.parquet(self.path("fact_trips"))
        self._write(cube.build_trip_cube(fact).sortWithinPartitions("date_id"), "trip_cube", force=force)
        cells = spark.read.parquet(self.path("trip_cube"))
        # few hundred states, however many trips: one file
        self._write(days.day_states(cells, star.dim_date(spark, rules), rules).coalesce(1), "day_states", force=force)
        self._write(quality.funnel(staged, fact), "data_quality", force=force)
        # completion marker, written through Spark so it works on any file system
        spark.range(1).write.mode("overwrite").parquet(self.complete_marker)
        return self

    def table(self, name: str) -> DataFrame:
        """A built table. Tables are immutable once the build is complete, so one
        handle (file listing and footer schema) is reused by every query."""
        if name not in TABLES:
            raise KeyError(name)
        df = self._handles.get(name)
        if df is None:
            self.build()
            df = self._handles[name] = self.spark.read.parquet(self.path(name))
        return df


_LAKES: dict[tuple, TripLake] = {}
_LOCK = threading.Lock()


def fixture_lake(spark: SparkSession, sf_dir: str, rules: TripRules = FIXTURE_RULES) -> TripLake:
    """Memoised per session and state of the input files; concurrent callers share one build."""
    fresh = TripLake.from_fixture(spark, sf_dir, rules)
    k = (id(spark), fresh.root)
    lake = _LAKES.get(k)
    if lake is not None and lake.is_built():
        return lake
    with _LOCK:
        lake = _LAKES.get(k)
        if lake is None or not lake.is_built():
            lake = _LAKES[k] = fresh.build()
    return lake
