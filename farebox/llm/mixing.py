"""Mixing sources to target weights (5): a time-varying curriculum.

Every source has a weight schedule over training time 0..1: knots of relative
intensity, linear between them. Its integral, scaled to the source's target, is
the source's cumulative demand for words. A source's documents stand in a fixed
pseudo-random order (MD5 of id, then id, then MD5 of the text) and supply words one after the
other, epoch after epoch. A copy whose words begin at supply c is due when
demand reaches c: inverting the cumulative demand gives its training position,
and the mix is all copies, range-sorted by position.

Targets: the budget is shared by weight; a target above ``max_epochs`` times its
source's size stops there, and the excess is shared again by weight until none
is above. The closed form sorts sources by size per weight and finds the level
at which capped and uncapped sources add up to the budget.

A copy is taken if its middle word lies before the target, so a source's taken
words differ from the target by at most half of one document, and no document
is taken more than ``max_epochs`` times. Whole documents are taken.

Scale: a source's prefix sums go through about sqrt(rows) bins of the order, so
neither a hot source nor the whole table is ever one group; only bin totals
(sqrt(rows) per source) and source totals meet in one task.

Defined cases: a null text has size 0 and is taken as often as its place in the
order says, with no words; a null source is a source of its own, sorted last;
null ids come before others in the order; exactly repeated rows are separate
documents with neighbouring places. Sources without words have target 0. Extra
columns are kept by ``training_order`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import n_groups, table

WEIGHTS = (3, 1, 2)
#: Intensity knots by a source's place, repeating: steady, rising, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 1.5), (0.25, 1.5), (1.0, 0.5)))
SHARE = 1.5
MAX_EPOCHS = 2
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds place and target to (source, source_size, ...), one row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs))
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy((F.col("cap") / F.col("weight")), "place")
    rows = (rows.withColumn("budget", F.sum("source_size").over(total) * share)
            .withColumn("capped", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            # the level if this source and all after it in the order stay below their caps
            .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
            .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    level = F.min(F.when(F.col("fits"), F.struct("capped", "level"))).over(total)["level"]
    return rows.withColumn("final", level).select(
        *sizes.columns, "place", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"))


def _schedule(knots) -> tuple[list[float], list[float], list[float], list[float]]:
    """Begin, width, intensity and its slope of each segment, scaled to integral 1, and the integral before it."""
    t, y = [k[0] for k in knots], [float(k[1]) for k in knots]
    area = sum((y[i] + y[i + 1]) / 2 * (t[i + 1] - t[i]) for i in range(len(t) - 1))
    y = [v / area for v in y]
    before, out = 0.0, []
    for i in range(len(t) - 1):
        out.append((t[i], y[i], (y[i + 1] - y[i]) / (t[i + 1] - t[i]), before))
        before += (y[i] + y[i + 1]) / 2 * (t[i + 1] - t[i])
    return out


def position(place: Column, done: Column, schedules=SCHEDULES) -> Column:
    """Training time at which a share ``done`` (0..1) of a source's demand is reached."""
    out = F.lit(None).cast("double")
    for s, knots in enumerate(schedules):
        here = F.lit(None).cast("double")
        for begin, y, slope, before in _schedule(knots):
            rest = done - F.lit(before)
            # solves y*u + slope*u*u/2 = rest without cancellation
            root = 2 * rest / (F.lit(y) + F.sqrt(F.greatest(F.lit(y * y) + 2 * slope * rest, F.lit(0.0))))
            here = F.when(done >= F.lit(before), F.lit(begin) + root).otherwise(here)
        out = F.when(place % len(schedules) == s, F.least(here, F.lit(1.0))).otherwise(out)
    return out


def _md5(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def plan(docs: DataFrame, carry: bool = False, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
         schedules=SCHEDULES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): its size, its source's numbers and its copies' positions.

    Columns: doc_id, size, source_size, target, taken, positions; with ``carry`` also the whole ``row``.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
                       word_count(F.col("text")).alias("size"), _md5(F.col("doc_id")).alias("order_key"),
                       _md5(F.col("text")).alias("text_key"), *whole)
    # about sqrt(rows) bins of the order; a row's stored size is taken as 1 KB
    bins = max(16, int(n_groups(docs.select("text"), 1 << 10) ** 0.5))
    rows = rows.withColumn("bin", F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") * bins / float(1 << 32)))
    by_bin = rows.groupBy("key", "bin").agg(F.sum("size").alias("words"))
    source = F.when(F.col("key") != "", F.substr("key", F.lit(2)))
    goals = targets(by_bin.groupBy("key").agg(F.sum("words").alias("source_size")).withColumn("source", source),
                    weights, share, max_epochs)
    earlier = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    by_bin = by_bin.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(goals, "key").drop("words")
    inside = (Window.partitionBy("key", "bin").orderBy("order_key", F.col("doc_id").asc_nulls_first(), "text_key")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(by_bin, ["key", "bin"])
    start = F.col("before") + F.col("inside")
    begins = F.array(*[start + F.col("source_size") * e for e in range(max_epochs)])
    due = F.filter(begins, lambda c: c + F.col("size") / 2.0 < F.col("target"))
    rows = rows.withColumn("positions", F.transform(due, lambda c: position(F.col("place"), c / F.col("target"), schedules)))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("positions")).alias("taken"),
                       "positions", *(["row"] if carry else []))


def range_sorted(rows: DataFrame, parts: int, *by: str) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in by]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def training_order(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` as often as they are taken, with their ``position``, range-sorted by it."""
    copies = plan(docs, carry=True, **settings).select("row", F.explode("positions").alias("position"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c != "position"]
    return range_sorted(copies.select(*kept, "position"), n_groups(docs, 4 << 20), "position", "doc_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = plan(docs).select("doc_id", "size", "source_size", "target", "taken",
                            F.get("positions", F.lit(0)).alias("first_position"), F.size("positions").alias("copies"))
    return range_sorted(mix, n_groups(docs, 16 << 20), "first_position", "doc_id")


def _position_sql(schedules=SCHEDULES) -> str:
    """DuckDB: the share of training time at which the share ``done`` of demand is reached."""
    cases = []
    for s, knots in enumerate(schedules):
        parts = " ".join(f"WHEN done >= {before!r} THEN {float(begin)!r} + 2 * (done - {before!r}) / ({y!r} + sqrt(greatest({y * y!r} + 2 * {slope!r} * (done - {before!r}), 0.0)))"
                         for begin, y, slope, before in reversed(_schedule(knots)))
        cases.append(f"WHEN place % {len(schedules)} = {s} THEN least(CASE {parts} END, 1.0)")
    return "CASE " + " ".join(cases) + " END"


ORACLE = f"""
WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key, md5(coalesce(text, '')) AS text_key FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes),
weighed AS (SELECT *, [{', '.join(f'{float(w)}::DOUBLE' for w in WEIGHTS)}][(place % {len(WEIGHTS)} + 1)::INT] AS weight,
    source_size * {float(MAX_EPOCHS)}::DOUBLE AS cap, sum(source_size) OVER () * {SHARE}::DOUBLE AS budget FROM placed),
levels AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goals AS (SELECT *, coalesce(least(cap, (SELECT arg_min(level, cap / weight) FROM levels WHERE level * weight <= cap) * weight), cap) AS target FROM levels),
supply AS (SELECT r.doc_id, r.size, g.source_size, g.target, g.place, coalesce(sum(r.size) OVER (PARTITION BY r.source
    ORDER BY r.order_key, r.doc_id NULLS FIRST, r.text_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source),
counted AS (SELECT *, {' + '.join(f'(start + {e} * source_size + size / 2.0::DOUBLE < target)::INT' for e in range(MAX_EPOCHS))} AS copies, start / target AS done FROM supply)
SELECT doc_id, size, source_size, target, size * copies AS taken, CASE WHEN copies > 0 THEN {_position_sql()} END AS first_position, copies FROM counted
"""

QUERIES = {"op5_source_mixing": op5_source_mixing}
ORACLES = {"op5_source_mixing": ORACLE}
