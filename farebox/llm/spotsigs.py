"""SpotSigs document fingerprints (4), with DataFrame and SQL functions only.

Words are lower-cased runs of letters. Common words (``ANCHORS``) are anchors; every
run of anchors, and the start of the text, begins a chain of the next ``CHAIN``
words that are no anchors, and the 64-bit hash of such a chain is a signature. A text's
fingerprint is the set of its signatures, written as its size and the SHA-256 of
the sorted set; the likeness of two fingerprints is the Jaccard similarity of the sets.

``similar`` finds all pairs of distinct fingerprints above a threshold t. Sets
are partitioned by length: sets of likeness t are in one range of lengths or in
neighbouring ones, so a set meets only these, by the join's key. Within that, a set is filed under its rarest
signatures only: as many as must contain one that is shared. Candidates are pruned once more by the best Jaccard
that their places in the order still allow, then compared exactly. Signatures rarer first keep
common ones, which would give all pairs, out of the index; the sets that share all of theirs are one set.

``edited_likeness`` compares each text with its edited form (the last
floor(n/2) code points replaced by the first as many, or all, of the next
document's) and with the next document, in ascending order of doc_id, the first
after the last. Documents are dealt into ranges of ids; the first document of a
range is also sent to the range before, so that no window spans the whole table.

Defined cases: null texts are empty; texts without letters have the empty set,
and two empty sets have likeness 1; null ids sort last; documents with one id
(null ids too) follow each other by their text's hash, equal rows in any order; a single document is its own next one.
Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_groups, table, written

CHAIN = 2
#: Anchors: common words of the four languages (fixed values).
ANCHORS = ("the of and to in a is that it for on was with as by at from this be are or an "
           "der die das und ist nicht ein eine mit von zu den dem des im auf sich für als "
           "le la les de du un une et est que qui dans pour par sur pas avec "
           "el los las en y se no con una su al lo").split()
WORD = "[^\\p{L}]+"
#: Ranges of ids at most; beyond, they grow (their windows sort and spill as any other).
MOST_RANGES = 20_000


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda evaluates outer expressions anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def signatures(text: Column) -> Column:
    """Distinct sorted signature hashes of a text."""
    gap = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WORD, " ")), F.lit(" "))
    # pieces between anchors (empty ones within a run of them go): the words after a run; the first those before any
    runs = F.split(gap, " (?:" + "|".join(sorted(set(ANCHORS))) + ")(?= )")
    runs = F.filter(F.transform(runs, lambda p: F.trim(p)), lambda p: p != "")

    # anchors end a piece, but a chain reads on: a one-word piece takes the next piece's first word
    def chain(p, after):
        return F.when(F.instr(p, " ") > 0, F.substring_index(p, " ", CHAIN)).otherwise(
            F.concat_ws(" ", p, F.substring_index(after, " ", CHAIN - 1)))

    chains = _let(runs, lambda r: F.zip_with(r, F.slice(r, F.lit(2), F.greatest(F.size(r), F.lit(1))), lambda p, after: F.when(p.isNotNull(), F.xxhash64(chain(p, after)))))
    return F.array_sort(F.array_distinct(chains))


def fingerprint(sigs: Column) -> Column:
    return F.concat(F.size(sigs).cast("string"), F.lit(":"), F.sha2(F.array_join(F.transform(sigs, lambda s: s.cast("string")), ",").cast("binary"), 256))


def jaccard(a: Column, b: Column) -> Column:
    """Likeness of two sets; an empty one is like an empty one only."""
    def like(sizes):
        union = sizes[0] + sizes[1] - sizes[2]
        return F.when(union == 0, 1.0).otherwise(sizes[2] / union)

    return _let(F.array(F.size(a), F.size(b), F.size(F.array_intersect(a, b))), like)


# ---- near-duplicates ---------------------------------------------------------------

def length_range(n: Column, threshold: float) -> Column:
    """The range of set lengths that ``n`` is in: sets of likeness ``threshold`` are in one range or in neighbouring ones."""
    return F.floor(F.log(n) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")


def similar(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): (doc_id, fp) of every row, and (a, b, likeness) of distinct fingerprints."""
    rows = written(docs.select("doc_id", signatures(F.col("text")).alias("sigs")).withColumn("fp", fingerprint(F.col("sigs"))), "signatures")
    sets = rows.groupBy("fp").agg(F.first("sigs").alias("sigs")).where(F.size("sigs") > 0)
    each = sets.select("fp", F.explode("sigs").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("df"))
    ordered = each.join(often, "s").groupBy("fp").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
    ordered = written(ordered.withColumn("n", F.size("o")).withColumn("span", length_range(F.col("n"), threshold)), "ordered")
    # two sets of likeness t share one of their first n - ceil(t*n) + 1 signatures
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    filed = (ordered.select("fp", "n", "span", F.posexplode(F.slice("o", F.lit(1), prefix.cast("int"))).alias("at", "x"))
             .select("fp", "n", "span", "at", F.col("x.s").alias("s")))
    # the smaller set asks in its own range; the larger one answers there and in the range below
    a = filed.alias("a")
    b = filed.withColumn("asked", F.explode(F.array(F.col("span"), F.col("span") - 1))).alias("b")
    fits = (F.col("a.n") <= F.col("b.n")) & (F.col("a.n") >= F.col("b.n") * threshold - 1e-9) & ((F.col("a.n") < F.col("b.n")) | (F.col("a.fp") < F.col("b.fp")))
    # nothing before this first shared signature is shared: what is left must suffice
    left = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    enough = left >= F.ceil((F.col("a.n") + F.col("b.n")) * threshold / (1 + threshold) - 1e-9)
    found = (a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.span") == F.col("b.asked"))).where(fits)
             .groupBy(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).agg(F.max(enough).alias("enough")).where("enough"))
    both = found.join(sets.select(F.col("fp").alias("a"), F.col("sigs").alias("sa")), "a").join(sets.select(F.col("fp").alias("b"), F.col("sigs").alias("sb")), "b")
    pairs = both.select("a", "b", jaccard(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= threshold)
    return rows.select("doc_id", "fp"), pairs


# ---- edited texts ------------------------------------------------------------------

def _texts(values: list[str]) -> Column:
    """A constant array: one literal, cut when the plan is made, not an expression for each value."""
    return F.split(F.lit(",".join(values)), ",")


def _range_of(key: Column, firsts: list[str]) -> Column:
    """The place of the last of the sorted ``firsts`` that is at most ``key``: a coarse search, then one within a stretch."""
    step = max(1, int(len(firsts) ** 0.5))
    reached = lambda stretch: F.size(F.filter(stretch, lambda e: e <= key))
    base = F.greatest(reached(_texts(firsts[::step])) - 1, F.lit(0)) * step
    return _let(base, lambda low: low + reached(F.slice(_texts(firsts), low + 1, F.lit(step))) - 1)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, text, next_text) in ascending order of doc_id, the first after the last.

    Spark's range partitioning cuts the keys (id, hash of the text), so that an id of many texts is cut too. Each range's
    smallest key comes to the driver, as Spark's own range bounds do: at most ``MOST_RANGES``, whatever the input.
    """
    id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    # hex digits in the order of the numbers: the sign bit turned over; null ids behind all
    digits = lambda x: F.lpad(F.hex(x.bitwiseXOR(F.lit(-1 << 63))), 16, "0")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    key = F.concat(F.when(id.isNull(), "~").otherwise(digits(id)), digits(F.col("h")))
    ranges = ranges or min(MOST_RANGES, max(16, int(4 * n_groups(docs.select("text"), 64 << 10) ** 0.5)))
    cut = rows.select(key.alias("key")).repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("first"))
    firsts = sorted(r["first"] for r in cut.collect()) or [""]
    # a range's first document also goes to the range before, as a guest behind all others
    part = F.col("part")
    previous = F.when(part == 0, len(firsts) - 1).otherwise(part - 1)
    own, guest = F.struct(part.alias("part"), F.lit(0).alias("guest")), F.struct(previous.alias("part"), F.lit(1).alias("guest"))
    sent = (rows.withColumn("part", _let(key, lambda k: _range_of(k, firsts)))
            .withColumn("to", F.explode(F.when(F.get(_texts(firsts), part) == key, F.array(own, guest)).otherwise(F.array(own))))
            .select("doc_id", "h", "text", F.col("to.part").alias("part"), F.col("to.guest").alias("guest")))
    inside = Window.partitionBy("part").orderBy("guest", id.asc_nulls_last(), "h")
    return sent.withColumn("next_text", F.lead("text").over(inside)).where("guest = 0").select("doc_id", "text", "next_text")


def edited_text(text: Column, other: Column) -> Column:
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(other, F.lit(1), half))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = with_next(docs).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("other"), signatures(F.col("next_text")).alias("after"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
                       jaccard(F.col("own"), F.col("other")).alias("near_edited"), jaccard(F.col("own"), F.col("after")).alias("near_next"))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op4_spotsigs": op4_spotsigs}
ORACLES: dict[str, str] = {}
