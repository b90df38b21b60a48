"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup above this estimated size is joined with a shuffle instead.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (no job runs), or None if unknown."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:
        return None


def is_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the estimate is known and under the limit."""
    size = estimated_bytes(df)
    return size is not None and 0 <= size <= limit_bytes


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the estimate is known and under the limit; otherwise
    leave the choice to the planner (sort-merge or shuffled hash join, AQE may
    still convert at run time from real sizes)."""
    return F.broadcast(df) if is_small(df, limit_bytes) else df


def null_safe_anti(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` are not in ``known``; a NULL key equals a NULL key, so it is neither lost nor always new.

    An equality of all keys, hence a hash or sort-merge anti join, whatever the keys hold.
    """
    there = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return rows.join(there, same, "left_anti")
