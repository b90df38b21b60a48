"""The lake by months: a load rebuilds the months it touches and nothing else.

A trip's month is that of its pickup, and so is its duplicates' (the pickup time
is a dedup key), so a month's layers depend on that month's raw rows alone:

    runs that count now and didn't, or did and don't  ->  months with their rows
    -> staged, silver, fact of these months, written anew (year and month folders)
    -> cube: cells of the new month less the cells of the old one; only cells that changed are written
    -> counts behind the quality funnel
    -> one manifest, published in one step (``sources.snapshots``)

Readers pin a snapshot. A month's cube is a base and the differences since; when
there are ``MOST_DIFFERENCES`` of them, the next build writes the month's cells
whole. Distances and money are DECIMAL and durations whole seconds, so adding
and retracting is exact and equals a full rebuild.

A trip without a pickup time lies in the month ``none``. Months come from the
data, so a stray date makes a month of its own. What the driver holds is names
of months and builds; rows never reach it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TripRules
from ..operators import clean, cube, days, quality, star
from ..session import file_fingerprint, session_conf
from ..sources.ingest import BRONZE_ONLY, BronzeIngest
from ..sources.snapshots import Conflict, Snapshots, partition_folders, remove
from .lake import BUILD_VERSION, MONTH, SORT_SPLIT, by_month

MOST_DIFFERENCES = 4
TABLES = ("staged", "silver_trips", "fact_trips", "cells", "counts")
RUNS = "run_id string, source_file string"


def month_key(folder: str) -> str:
    """``pickup_year=2019/pickup_month=1`` -> ``2019-01``; ``none`` for trips without a pickup time."""
    year, month = (p.split("=", 1)[1] for p in folder.split("/")[:2])
    return f"{int(year):04d}-{int(month):02d}" if year.lstrip("-").isdigit() and month.isdigit() else "none"


def in_months(months: list[str]):
    """A predicate on the partition columns."""
    ids = [int(m[:-3]) * 100 + int(m[-2:]) for m in months if m != "none"]
    known = (F.col(MONTH[0]) * 100 + F.col(MONTH[1])).isin(ids)
    return known | F.col(MONTH[0]).isNull() if "none" in months else known


class MonthlyLake:
    """The tables of a folder of raw loads; serves the registered queries like any built lake."""

    def __init__(self, spark: SparkSession, root: str, ingest: BronzeIngest, zones: Callable[[], DataFrame], rules: TripRules,
                 zones_path: str = ""):
        self.spark, self.root, self.ingest, self.rules = spark, root.rstrip("/"), ingest, rules
        self._zones, self._zone_df = zones, None
        self.snapshots = Snapshots(spark, root)
        zone_state = file_fingerprint(spark, zones_path) if zones_path else ""
        self.version = hashlib.sha1(f"{rules!r}|{zone_state}|{BUILD_VERSION}".encode()).hexdigest()[:20]
        self.metrics: dict[str, dict] = {}
        self.pinned: dict | None = None
        self._handles: dict[tuple, DataFrame] = {}       # a snapshot's tables never change

    # -- what has changed -----------------------------------------------------------
    def changed_months(self, now: DataFrame, parent: dict | None) -> list[str]:
        """Months with rows of a (run, file) that counts ``now`` or counted in ``parent``, but not both."""
        then = self._read_runs(parent)
        if parent is None or parent["version"] != self.version:
            changed = now.unionByName(then).distinct()           # everything, and months that are no more
        else:
            changed = now.exceptAll(then).unionByName(then.exceptAll(now))
        rows = self.ingest.rows_of(changed).select(*MONTH).distinct().collect()      # names of months
        return sorted("none" if r[0] is None else f"{r[0]:04d}-{r[1]:02d}" for r in rows)

    def _read_runs(self, manifest: dict | None) -> DataFrame:
        if manifest is None:
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).parquet(self._runs_path(manifest["runs"]))

    def _runs_path(self, build: str) -> str:
        return f"{self.root}/runs/build={build}"

    # -- build ------------------------------------------------------------------------
    def build(self, force: bool = False, attempts: int = 3) -> MonthlyLake:
        """Brings the lake up to the loads; a builder that was overtaken starts again from the newer snapshot."""
        for left in reversed(range(attempts)):
            parent = self.snapshots.latest()
            if force and parent is not None:
                parent = parent | {"version": "forced"}
            # what counts is read once and kept: loads that end meanwhile wait for the next build
            build = uuid.uuid4().hex
            self.ingest.live_runs().select("run_id", "source_file").coalesce(1).write.parquet(self._runs_path(build))
            live = self._read_runs({"runs": build})
            months = self.changed_months(live, parent)
            if parent is not None and not months and parent["version"] == self.version:
                remove(self.spark, self._runs_path(build))
                self.pinned = parent
                return self
            try:
                self.pinned = self.snapshots.publish(self._build_months(build, live, months, parent), parent)
                return self
            except Conflict:
                if not left:
                    raise
        return self

    def _build_months(self, build: str, live: DataFrame, months: list[str], parent: dict | None) -> dict:
        spark, rules = self.spark, self.rules
        old = {t: dict(parent["tables"][t]) if parent else {} for t in TABLES}
        fresh = parent is None or parent["version"] != self.version
        schemas: dict[str, str] = {}

        def write(name: str, df: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
            path = f"{self.root}/{name}/build={build}"
            schemas[name] = T.StructType([f for f in df.schema if f.name not in MONTH]).json()
            # dynamic: a repeated write of this build replaces its months and leaves others alone
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH, *more).parquet(path)
            found = {month_key(f): f for f in partition_folders(spark, path, 2)}
            for m in months:
                old[name].pop(m, None)
            old[name] |= {m: [[build, f]] for m, f in found.items()}
            self.metrics[name] = {"months": sorted(found)}
            return self._read(name, {m: [[build, f]] for m, f in found.items()}, schemas[name])

        before = {k: v for k, v in old["cells"].items() if k in months} if not fresh else {}
        old_schema = parent["schemas"]["cells"] if parent else None
        raw = self.ingest.rows_of(live).filter(in_months(months)).drop(*[c for c in BRONZE_ONLY if c not in MONTH])
        with session_conf(spark, spark__sql__maxConcurrentOutputFileWriters="8"):
            staged = write("staged", clean.tag_rejects(raw), ("status",))
        valid = clean.valid_trips(staged).drop(*MONTH)
        silver = write("silver_trips", clean.silver(valid, self.zones(), rules, gather=by_month))
        with session_conf(spark, spark__sql__files__maxPartitionBytes=SORT_SPLIT):
            fact = write("fact_trips", star.fact_trips(silver, rules, *MONTH).sortWithinPartitions(*MONTH, "date_id"))
        write("counts", self._month_counts(staged, fact))
        cells = cube.build_cells(fact, *MONTH)
        if not before:
            write("cells", cells.sortWithinPartitions(*MONTH, "date_id"))
        else:
            self._write_difference(cells, before, old, old_schema, build, months, schemas, write)
        builds = sorted({b for t in TABLES for parts in old[t].values() for b, _ in parts} | {build})
        return {"version": self.version, "runs": build, "tables": old, "schemas": schemas, "builds": builds}

    def _write_difference(self, cells: DataFrame, before: dict, old: dict, old_schema: str, build: str, months: list[str],
                          schemas: dict, write) -> None:
        then = cube.merge_cells(self._read("cells", before, old_schema), *MONTH)
        # months with many differences are written whole, the others as a difference
        whole = [m for m in months if len(before.get(m, [])) > MOST_DIFFERENCES or m not in before]
        old["cells"] |= {m: parts for m, parts in before.items() if m not in whole}
        parts = cube.difference(cells, then.filter(~in_months(whole)) if whole else then, *MONTH)
        kept = dict(old["cells"])
        write("cells", parts.sortWithinPartitions(*MONTH, "date_id"))
        for m in months:
            if m in whole:
                continue
            old["cells"][m] = [*kept[m], *old["cells"].get(m, [])]

    @staticmethod
    def _month_counts(staged: DataFrame, fact: DataFrame) -> DataFrame:
        tagged = staged.groupBy(*MONTH, F.col("status").alias("kind"), F.col("reject_reason").alias("reason")).agg(
            F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("duplicates"))
        kept = fact.groupBy(*MONTH, F.lit(quality.IN_FACT).alias("kind"), F.col("anomaly_reason").alias("reason")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("duplicates_removed").cast("bigint").alias("duplicates"))
        return tagged.unionByName(kept.select(tagged.columns)).coalesce(1)

    # -- read -----------------------------------------------------------------------------
    def _read(self, name: str, parts: dict[str, list], schema: str) -> DataFrame:
        types = T.StructType.fromJson(json.loads(schema))
        full = T.StructType([*types.fields, *[T.StructField(c, T.IntegerType()) for c in MONTH]])
        paths = [f"{self.root}/{name}/build={b}/{f}" for found in parts.values() for b, f in found]
        if not paths:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return rows.select(*full.names)

    def refresh(self) -> MonthlyLake:
        """Pins the newest snapshot."""
        self.pinned = self.snapshots.latest()
        return self

    def table(self, name: str) -> DataFrame:
        """A table of the pinned snapshot."""
        if self.pinned is None:
            self.refresh()
        if self.pinned is None:
            self.build()
        pin = self.pinned
        key = (pin["number"], name)
        if key not in self._handles:
            self._handles[key] = self._table(pin, name)
        return self._handles[key]

    def _table(self, pin: dict, name: str) -> DataFrame:
        read = lambda t: self._read(t, pin["tables"][t], pin["schemas"][t])
        if name == "trip_cube":
            return cube.as_cube(self.cells()).drop(*MONTH)
        if name == "day_states":
            return days.day_states(self.cells(), star.dim_date(self.spark, self.rules), self.rules)
        if name == "data_quality":
            return quality.from_counts(read("counts"))
        return read(name)

    def cells(self) -> DataFrame:
        """Cells of the pinned snapshot: months without differences as they lie, the others added up."""
        pin = self.pinned
        parts, schema = pin["tables"]["cells"], pin["schemas"]["cells"]
        plain = {m: p for m, p in parts.items() if len(p) == 1}
        summed = {m: p for m, p in parts.items() if len(p) > 1}
        rows = self._read("cells", plain, schema)
        if not summed:
            return rows
        return rows.unionByName(cube.merge_cells(self._read("cells", summed, schema), *MONTH))

    def zones(self) -> DataFrame:
        if self._zone_df is None:
            self._zone_df = self._zones()
        return self._zone_df
