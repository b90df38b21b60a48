"""Quality funnel: every raw row ends in exactly one bucket.

raw = malformed lines + rejected (by reason) + duplicates + anomalies (by reason) + analysed.
Built from small grouped counts of the staged and fact tables, which add up over
months; nothing goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .clean import STATUS_MALFORMED, STATUS_REJECTED

IN_FACT = "fact"


def counts(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Additive counts (kind, reason, n, duplicates) behind the funnel: they add up over months or runs."""
    tagged = staged.groupBy("status", "reject_reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("status").alias("kind"), F.col("reject_reason").alias("reason"), "n", F.lit(0).cast("bigint").alias("duplicates"))
    kept = fact.groupBy("anomaly_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("duplicates_removed").alias("duplicates")).select(
        F.lit(IN_FACT).alias("kind"), F.col("anomaly_reason").alias("reason"), "n", F.col("duplicates").cast("bigint").alias("duplicates"))
    return tagged.unionByName(kept)


def from_counts(parts: DataFrame) -> DataFrame:
    """The published funnel of (kind, reason, n, duplicates) rows, any number per kind and reason."""
    n = parts.groupBy("kind", "reason").agg(F.sum("n").alias("n"), F.sum("duplicates").alias("duplicates"))
    in_fact = F.col("kind") == IN_FACT

    def step(order, step, category, reason, rows, measure):
        return rows.select(F.lit(order).alias("step_order"), F.lit(step).alias("step"), F.lit(category).alias("category"),
                           (reason if reason is not None else F.col("reason")).alias("reason"), measure.alias("nb_trips"))

    def total(order, label, category, reason, pred, measure="n"):
        one = n.agg(F.coalesce(F.sum(F.when(pred, F.col(measure))), F.lit(0)).alias("n"))
        return step(order, label, category, F.lit(reason), one, F.col("n"))

    rejected, malformed = F.col("kind") == STATUS_REJECTED, F.col("kind") == STATUS_MALFORMED
    raw_total = total(1, C.FUNNEL_STEP_INPUT, C.FUNNEL_CAT_INPUT, C.FUNNEL_REASON_INPUT, ~in_fact)
    parts_of_raw = [
        # lines that don't fit the file format stand apart from the published reasons, and only where there are any
        step(1, C.FUNNEL_STEP_INPUT, C.FUNNEL_CAT_MALFORMED, F.lit(C.FUNNEL_REASON_MALFORMED), n.filter(malformed), F.col("n")),
        step(2, C.FUNNEL_STEP_CLEAN, C.FUNNEL_CAT_REJECT, None, n.filter(rejected), F.col("n")),
        total(2, C.FUNNEL_STEP_CLEAN, C.FUNNEL_CAT_REJECT, C.FUNNEL_REASON_DUPLICATE, in_fact, "duplicates"),
        step(3, C.FUNNEL_STEP_QUALITY, C.FUNNEL_CAT_ANOMALY, None, n.filter(in_fact & F.col("reason").isNotNull()), F.col("n")),
        total(4, C.FUNNEL_STEP_OUTPUT, C.FUNNEL_CAT_OUTPUT, C.FUNNEL_REASON_OUTPUT, in_fact & F.col("reason").isNull()),
    ]
    rows = raw_total
    for p in parts_of_raw:
        rows = rows.unionByName(p)
    raw = raw_total.select(F.col("nb_trips")).scalar()       # one row
    return rows.select("step_order", "step", "category", "reason", F.col("nb_trips").cast("bigint").alias("nb_trips"),
                       F.try_divide(F.col("nb_trips").cast("double"), raw.cast("double")).alias("pct_of_raw"))


def funnel(staged: DataFrame, fact: DataFrame) -> DataFrame:
    return from_counts(counts(staged, fact))
