"""Batch ingestion of raw trip files into bronze, with an audit log.

* typed CSV scan (explicit 18-column schema: no inference pass), canonical
  column names, lineage from the file metadata; a line that does not fit the
  schema keeps its text in ``corrupt_line`` (its bad cells are NULL);
* a file is known by its full path, size and modification time. It is pending
  unless the audit holds a SUCCESS for all three, the sample fraction and the
  rules version; forcing reloads it;
* all pending files are loaded by one job into a run of their own
  (``run_id`` partition). Nothing is overwritten: the audit says which run holds
  a file's rows, the newest full load or, only if there is none, the newest
  sample. A shrunk or emptied file so replaces all its old rows, a sample never
  hides a full load, and a failed run is never read;
* on failure a FAILED audit row per file is written and the error re-raised, so
  later stages never run on a half-loaded batch.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_if_small, null_safe_anti
from ..session import list_files, path_exists
from .schemas import CORRUPT, TLC_RENAMES, TLC_TRIP_CSV_READ, TLC_TRIP_CSV_SCHEMA, TRIP_COLUMNS, ZONE_LOOKUP_CSV_SCHEMA

AUDIT_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("modified", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("sample_fraction", T.DoubleType()),
    T.StructField("rules_version", T.StringType()),
])
SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"
RULES_VERSION = "2"


def canonical_trips(raw: DataFrame) -> DataFrame:
    """TLC header names -> canonical names; lineage id from the row content."""
    df = raw
    for src, dst in TLC_RENAMES.items():
        df = df.withColumnRenamed(src, dst)
    content = [F.col(c) for c in df.columns if c in TRIP_COLUMNS]
    return df.withColumn("trip_ref", F.xxhash64(*content)).select(*TRIP_COLUMNS, *[
        c for c in df.columns if c not in TRIP_COLUMNS])


def read_trip_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Typed header CSV scan. A bad cell becomes NULL and the line's text is kept in
    ``corrupt_line``; ``source_file`` is the full path from the file metadata."""
    raw = (spark.read.schema(TLC_TRIP_CSV_READ).option("header", True)
           .option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    return canonical_trips(raw)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    z = spark.read.schema(ZONE_LOOKUP_CSV_SCHEMA).option("header", True).csv(path)
    return z.select(F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"),
                    F.col("Zone").alias("zone"), "service_zone")


def hash_sample(df: DataFrame, key_cols, fraction: float, buckets: int = 10000) -> DataFrame:
    """Keep rows whose key hash falls under ``fraction``: stable under
    repartitioning, retries and re-runs (unlike a seeded random sample)."""
    h = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(buckets))
    return df.filter(h < F.lit(int(round(fraction * buckets))))


class BronzeIngest:
    """Load raw trip files into a bronze table; the audit decides which rows count."""

    def __init__(self, spark: SparkSession, bronze_path: str, audit_path: str):
        self.spark = spark
        self.bronze_path = bronze_path
        self.audit_path = audit_path

    def audit(self) -> DataFrame:
        if not path_exists(self.spark, self.audit_path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.audit_path)

    def pending(self, files: DataFrame, fraction: float | None = None) -> DataFrame:
        """Files (source_file, size, modified) without a SUCCESS for this state of the
        file, this fraction and rules version: a left-anti join against the audit log."""
        frac = float(fraction) if fraction else 1.0
        done = self.audit().filter(
            (F.col("status") == SUCCESS) & (F.col("sample_fraction") == frac)
            & (F.col("rules_version") == RULES_VERSION)).select("source_file", "size", "modified")
        return null_safe_anti(files, done, ["source_file", "size", "modified"])

    def live_runs(self) -> DataFrame:
        """(run_id, source_file): the run that holds each file's rows."""
        newest = F.struct((F.col("sample_fraction") == 1.0).alias("full"), "processed_at", "run_id")
        return (self.audit().filter(F.col("status") == SUCCESS).groupBy("source_file")
                .agg(F.max(newest).alias("r")).select(F.col("r.run_id").alias("run_id"), "source_file"))

    def _write_audit(self, rows: list[tuple]) -> None:
        """One append for a run: (file, run, status, rows, fraction)."""
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        recs = [(f["source_file"], f["size"], f["modified"], run, status, int(n), now, frac, RULES_VERSION)
                for f, run, status, n, frac in rows]
        self.spark.createDataFrame(recs, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.audit_path)

    def ingest_all(self, paths: list[str], sample_fraction: float | None = None, force: bool = False) -> list[dict]:
        """Load every pending file among ``paths`` (files or folders) in one job."""
        frac = float(sample_fraction) if sample_fraction else 1.0
        run = uuid.uuid4().hex
        try:
            files = list_files(self.spark, paths)
        except FileNotFoundError as e:
            self._write_audit([({"source_file": str(e), "size": None, "modified": None}, run, FAILED, 0, frac)])
            raise
        if not files:
            return []
        todo = files
        if not force:
            listing = self.spark.createDataFrame([(f["source_file"], f["size"], f["modified"]) for f in files],
                                                 "source_file string, size long, modified long")
            names = {r["source_file"] for r in self.pending(listing, frac).collect()}     # one row per listed file at most
            todo = [f for f in files if f["source_file"] in names]
        counts: dict[str, int] = {}
        if todo:
            try:
                df = read_trip_csv(self.spark, [f["source_file"] for f in todo])
                if sample_fraction:
                    df = hash_sample(df, ("trip_ref",), frac)
                target = f"{self.bronze_path}/run_id={run}"
                (df.withColumns({"pickup_year": F.year("pickup_ts"), "pickup_month": F.month("pickup_ts"),
                                 "ingested_at": F.current_timestamp()})
                   .write.partitionBy("pickup_year", "pickup_month").parquet(target))
                written = self.spark.read.schema(_BRONZE_FILE).parquet(target)
                counts = {r["source_file"]: r["n"] for r in
                          written.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()}
            except Exception:
                self._write_audit([(f, run, FAILED, 0, frac) for f in todo])
                raise
            by_path = {_plain(k): n for k, n in counts.items()}
            counts = {f["source_file"]: by_path.get(_plain(f["source_file"]), 0) for f in todo}
            self._write_audit([(f, run, SUCCESS, counts[f["source_file"]], frac) for f in todo])
        return [{"source_file": f["source_file"], "status": SUCCESS if f["source_file"] in counts else SKIPPED,
                 "rows": counts.get(f["source_file"], 0)} for f in files]

    def ingest(self, path: str, sample_fraction: float | None = None, force: bool = False) -> dict:
        return self.ingest_all([path], sample_fraction, force)[0]

    def bronze(self) -> DataFrame:
        """Rows of the runs that count (partition pruning on ``run_id``)."""
        return self.rows_of(self.live_runs())

    def rows_of(self, runs: DataFrame) -> DataFrame:
        """Rows of (run_id, source_file) pairs."""
        live = runs.select("run_id", plain_path(F.col("source_file")).alias("live_file"))
        if not path_exists(self.spark, self.bronze_path):
            return self.spark.createDataFrame([], _BRONZE)
        rows = self.spark.read.option("basePath", self.bronze_path).schema(_BRONZE).parquet(self.bronze_path)
        return (rows.join(broadcast_if_small(live), (rows["run_id"] == live["run_id"])
                          & (plain_path(F.col("source_file")) == F.col("live_file")), "left_semi"))


def _plain(path: str) -> str:
    """A path without scheme and encoding: listings and file metadata spell it differently."""
    from urllib.parse import unquote, urlsplit
    u = urlsplit(path)
    return unquote(u.path) if u.scheme == "file" else unquote(path)


def plain_path(path):
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "[+]", "%2B"))


_BRONZE_FILE = "source_file string"
_TYPES = {TLC_RENAMES.get(f.name, f.name): f.dataType for f in TLC_TRIP_CSV_SCHEMA} | {"trip_ref": T.LongType()}
_BRONZE = T.StructType([
    *[T.StructField(c, _TYPES[c]) for c in TRIP_COLUMNS],
    T.StructField(CORRUPT, T.StringType()), T.StructField("source_file", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()), T.StructField("run_id", T.StringType()),
    T.StructField("pickup_year", T.IntegerType()), T.StructField("pickup_month", T.IntegerType()),
])
BRONZE_ONLY = ("pickup_year", "pickup_month", "ingested_at", "run_id")


def export_table(df: DataFrame, path: str, single_file: bool = False, range_key: str | list[str] | None = None,
                 max_records_per_file: int = 1_000_000) -> None:
    """BI export. Small dimensions go to one file; the large rollup is range-
    partitioned and sorted on its grain and capped per file, so the write stays
    parallel instead of funnelling through one task."""
    if single_file:
        df.coalesce(1).write.mode("overwrite").option("compression", "snappy").parquet(path)
        return
    n = df.sparkSession.sparkContext.defaultParallelism
    keys = [range_key] if isinstance(range_key, str) else list(range_key or [])
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) if keys else df
    (out.write.mode("overwrite").option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file).parquet(path))


def split_named_sql(text: str) -> dict[str, str]:
    """Split a file of ``-- name: x`` blocks into {name: sql}."""
    out: dict[str, str] = {}
    name, buf = None, []
    for line in text.splitlines():
        s = line.strip()
        if s.lower().startswith("-- name:"):
            if name:
                out[name] = "\n".join(buf).strip().rstrip(";")
            name, buf = s.split(":", 1)[1].strip(), []
        elif name is not None:
            buf.append(line)
    if name:
        out[name] = "\n".join(buf).strip().rstrip(";")
    return out


def run_named_sql(spark: SparkSession, text: str, views: dict[str, DataFrame],
                  out_dir: str | None = None) -> dict[str, DataFrame]:
    """Register views, run each named query with Spark SQL; optionally write
    one header CSV folder per result."""
    for v, df in views.items():
        df.createOrReplaceTempView(v)
    results = {n: spark.sql(q) for n, q in split_named_sql(text).items()}
    if out_dir:
        for n, df in results.items():
            df.write.mode("overwrite").option("header", True).csv(f"{out_dir.rstrip('/')}/{n}")
    return results
