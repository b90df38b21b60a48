"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is the equivalent DuckDB SQL (a string or a thunk building it);
    omit it for operators whose output is engine-specific (hash sampling).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle if callable(oracle) else (lambda s=oracle: s)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from . import analyses, dashboards, events, layers, measures, reports  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    load_all()
    return {k: f() for k, f in ORACLES.items()}
