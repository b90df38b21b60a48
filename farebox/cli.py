"""Command line: run the pipeline, the analyses and the BI export on raw trip files.

    python -m farebox.cli pipeline --trips DIR_OR_CSV [...] --zones ZONES.csv --work DIR [--period 2019-01]
    python -m farebox.cli analyses --work DIR --zones ZONES.csv --out DIR [--only a,b]
    python -m farebox.cli export   --work DIR --zones ZONES.csv --out DIR
    python -m farebox.cli sql      --work DIR --zones ZONES.csv --sql FILE --out DIR

``pipeline`` loads each CSV file once into bronze (audit gate; ``--force`` to
reload, ``--fraction`` for a stable hash sample) and builds the gold tables.
A build rewrites the months that the loads touch and publishes a snapshot of all tables under ``--work``/gold
in one step; ``--keep-days`` removes older ones.
``analyses`` runs every registered query over that build and writes one CSV
folder per result; ``sql`` runs the named queries of a file. Rule parameters default to the January-2019 taxi month.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from .config import TAXI_JANUARY_2019, TripRules
from .functions.holidays import holidays_between
from .operators.cube import CUBE_GRAIN, analysed
from .session import get_spark

LAKE_NAME = "cli"


def _rules(a: argparse.Namespace) -> TripRules:
    r = TAXI_JANUARY_2019
    kw = {}
    if a.period:
        y, m = (int(x) for x in a.period.split("-"))
        kw["period_start"] = dt.date(y, m, 1)
        kw["period_end"] = dt.date(y + m // 12, m % 12 + 1, 1)
    if a.period_start:
        kw["period_start"] = dt.date.fromisoformat(a.period_start)
    if a.period_end:
        kw["period_end"] = dt.date.fromisoformat(a.period_end)
    if a.period or a.period_start or a.period_end:
        kw["holidays"] = holidays_between(kw.get("period_start", r.period_start), kw.get("period_end", r.period_end))
    if a.airports:
        kw["airport_zone_ids"] = tuple(int(x) for x in a.airports.split(","))
    if a.core:
        kw["core_borough"] = a.core
    return TripRules(**{**r.__dict__, **kw})


def _lake(spark, a: argparse.Namespace):
    from .plans.common import register_lake
    from .plans.monthly import MonthlyLake
    from .sources.ingest import BronzeIngest, read_zone_csv

    bi = BronzeIngest(spark, f"{a.work}/bronze", f"{a.work}/audit")
    lake = MonthlyLake(spark, f"{a.work}/gold", bi, lambda: read_zone_csv(spark, a.zones), _rules(a), a.zones)
    register_lake(LAKE_NAME, lake)
    return bi, lake


def cmd_pipeline(spark, a) -> None:
    bi, lake = _lake(spark, a)
    for loaded in bi.ingest_all(a.trips, sample_fraction=a.fraction, force=a.force) if a.trips else []:
        print(loaded)
    lake.build(force=a.force)
    for name, m in lake.metrics.items():
        print(f"[build] {name:<13} {m}")
    print(f"[snapshot] {lake.pinned['number']}")
    if a.keep_days is not None:
        print(f"[expired] {lake.snapshots.expire(a.keep_days * 86400)}")
    lake.table("data_quality").orderBy("step_order", "reason").show(50, truncate=False)


def cmd_analyses(spark, a) -> None:
    from .plans.catalog import all_queries
    _, lake = _lake(spark, a)
    lake.build()
    only = set(a.only.split(",")) if a.only else None
    for name, fn in sorted(all_queries().items()):
        if fn.__module__.endswith(".events") or (only and name not in only):
            continue          # `events` analyses read the events table, not trips
        df = fn(spark, LAKE_NAME)
        if a.round is not None:       # display rounding only; computations stay exact
            df = df.withColumns({c: F.round(c, a.round) for c, t in df.dtypes if t == "double"})
        df.write.mode("overwrite").option("header", True).csv(f"{a.out}/{name}")
        print(f"[analyses] {name}")


def cmd_export(spark, a) -> None:
    from .sources.ingest import export_table
    _, lake = _lake(spark, a)
    lake.build()
    export_table(lake.table("trip_cube"), f"{a.out}/fact_trips_agg", range_key=list(CUBE_GRAIN))
    for name, df in {**_dims(spark, lake), "data_quality": lake.table("data_quality")}.items():
        export_table(df, f"{a.out}/{name}", single_file=True)
        print(f"[export] {name}")


def _dims(spark, lake) -> dict:
    from .operators import star
    r = lake.rules
    return {"dim_date": star.dim_date(spark, r), "dim_hour": star.dim_hour(spark),
            "dim_zone": star.dim_zone(lake.zones(), r), "dim_payment": star.dim_payment(spark, r)}


def cmd_sql(spark, a) -> None:
    """Run a file of ``-- name: x`` queries on the lake's tables and the ``trips`` view."""
    from .sources.ingest import run_named_sql
    _, lake = _lake(spark, a)
    lake.build()
    fact = lake.table("fact_trips")
    views = {"fact_trips": fact, "trips": analysed(fact), "fact_trips_agg": lake.table("trip_cube"),
             "data_quality": lake.table("data_quality"), **_dims(spark, lake)}
    with open(a.sql, encoding="utf-8") as f:
        for name in run_named_sql(spark, f.read(), views, out_dir=a.out):
            print(f"[sql] {name}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="farebox")
    p.add_argument("command", choices=("pipeline", "analyses", "export", "sql"))
    p.add_argument("--trips", nargs="*", default=[])
    p.add_argument("--zones", required=True)
    p.add_argument("--work", required=True)
    p.add_argument("--out")
    p.add_argument("--only")
    p.add_argument("--sql", help="file of `-- name: x` queries")
    p.add_argument("--fraction", type=float)
    p.add_argument("--round", type=int, help="round double outputs to N decimals (display)")
    p.add_argument("--force", action="store_true")
    p.add_argument("--keep-days", type=float, help="remove snapshots older than this")
    p.add_argument("--period", help="YYYY-MM")
    p.add_argument("--period-start")
    p.add_argument("--period-end")
    p.add_argument("--airports", help="comma-separated zone ids")
    p.add_argument("--core", help="core borough name")
    p.add_argument("--master")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = get_spark("farebox-cli", master=a.master)
    {"pipeline": cmd_pipeline, "analyses": cmd_analyses, "export": cmd_export, "sql": cmd_sql}[a.command](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
