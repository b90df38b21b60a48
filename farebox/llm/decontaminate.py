"""Benchmark decontamination (6), with DataFrame and SQL functions only.

A benchmark item of n words is looked for in item-sized windows of a document's
words (lower-cased runs of letters and digits); a document of fewer words is one
window, whole. Windows and items are
SimHashed over their shingles of five words (repeats weigh more; fewer words: all of them as one shingle).
Multi-index Hamming search: the 64 bits are cut into five blocks of 13 or 12
bits, and of two fingerprints within ``RADIUS`` = 19 bits some block differs in at most
3. Items are filed under every value within 3 bits of each block, a window asks
with its own blocks, so no fingerprint within the radius is missed. Then the exact weighted
similarity of the shingles themselves, sum of least over sum of greatest
counts, decides: 0.8 or more is a match.

Which windows are worth it: of the s shingles of an item-sized window of
similarity 0.8, at most s/9 are not the item's. So among any s/9 + 1 of them one is
shared, and looking up a document's shingles at every g-th word only, g the least
s / (s/9 + 1) of all items, still meets one in each such window: of the s/g looked up
in it, all but s/9 at least. Windows with that many are proposed wherever in the
item these shingles stand, so parts in another order are found; all others are
below 0.8. Of t < s shingles of a whole shorter document, at most (5 t - 4 s)/9 are
not the item's, and its first is looked up, so the same holds. Shingles are looked up by a 64-bit hash; a shared hash only proposes windows.

Item shingles are broadcast while they number at most ``MOST_BROADCAST``, counted
first; beyond it the shingles are joined by shuffle, and the proposed windows are
cut from the documents in a second join. So are the filed values: broadcast for at most ``MOST_FILED`` items, counted
first (the optimizer takes them for as small as the items), else sorted and merged. All ways give the same rows.

Defined cases: null or word-less texts and items match nothing; an item shorter
than five words has one shingle, so its matches are its exact repetitions; null
ids are kept (null matches null); rows that repeat an id are reported as one, by
the best window, earliest first; extra columns are ignored, ``clean`` returns
them. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SIZE = 5
SIMILARITY = 0.8
RADIUS = 19
#: Lowest bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
SLACK = RADIUS // len(BLOCKS)
#: Item shingles of about 100 bytes each: at most some 20 MB are broadcast.
MOST_BROADCAST = 200_000
#: Items whose filed values are broadcast, some 260 KB each (52 MB for 200 items were measured): at most about 10 MB.
MOST_FILED = 40
WORD = "[\\p{L}\\p{N}]+"
GAP = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")


def _each(w: Column, size: Column, make, step: int = 1) -> Column:
    """``make`` of runs of ``size`` words; one begins every ``step`` words."""
    last = F.size(w) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: make(F.slice(w, i + 1, size)))


def shingle_hashes(w: Column, size: Column, step: int = 1) -> Column:
    return _each(w, size, lambda run: F.xxhash64(run), step)


def shingles(w: Column, size: Column) -> Column:
    return _each(w, size, lambda run: F.array_join(run, " "))


def simhash(hashes: Column) -> Column:
    """A bit is set if it is set in more than half of the hashes."""
    one = F.lit(1).cast("long")
    votes = lambda b: F.size(F.filter(hashes, lambda h: F.getbit(h, b) == 1))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(votes(b) * 2 > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of least over sum of greatest counts of the elements of two arrays."""
    many = lambda where, x: F.size(F.filter(where, lambda y: y == x))
    both = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(many(a, x), many(b, x)))
    return both / (F.size(a) + F.size(b) - both)


def _block(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _masks(width: int) -> list[int]:
    """All patterns of at most ``SLACK`` set bits among ``width``."""
    out = {0}
    for _ in range(SLACK):
        out |= {m | 1 << b for m in out for b in range(width)}
    return sorted(out)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, w, n, size, shingle, h, fp) of items with words."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    items = items.withColumn("size", F.least("n", F.lit(SIZE)))
    items = items.withColumn("h", shingle_hashes(F.col("w"), F.col("size"))).withColumn("shingle", shingles(F.col("w"), F.col("size")))
    return items.withColumn("fp", simhash(F.col("h")))


def _starts(hits: DataFrame, step: int, most: int) -> DataFrame:
    """``hits`` (a document's looked-up places ``pos`` of n-word items) with ``low`` and ``high``: the starts of proposed windows.

    A window belongs to the first hit in it, so none is proposed twice. At most ``most`` places are looked up in one.
    """
    s, t = F.col("n") - F.col("size") + 1, F.least("n", "total") - F.col("size") + 1
    need = F.greatest(F.lit(1), F.floor(t / step) - F.floor((5 * t - 4 * s) / 9))
    hit = Window.partitionBy("doc_id", "text_key", "n").orderBy("pos")
    seen = hits.withColumn("before", F.lag("pos").over(hit)).withColumn("next", F.collect_list("pos").over(hit.rowsBetween(0, most - 1)))
    seen = seen.where(5 * t >= 4 * s)                   # fewer shingles are below 0.8
    enough = F.get("next", (need - 1).cast("int"))      # the hit that fills the window's count; null: there is none
    low = F.greatest(F.lit(0), F.coalesce(F.col("before") + 1, F.lit(0)), enough - t + 1)
    high = F.least(F.col("pos"), F.greatest(F.lit(0), F.col("total") - F.col("n")))
    return seen.withColumn("low", low).withColumn("high", high).where(enough.isNotNull() & (F.col("low") <= F.col("high"))).drop("before", "next")


def windows(docs: DataFrame, items: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc_id, text_key, start, n, size, w): item-sized windows that share enough looked-up shingles with items of n words.

    Shorter documents are windows of all their words under the ``n`` of the items.
    """
    placed = items.select("n", "size", F.explode("h").alias("h"))
    length = items.withColumn("s", F.size("h")).groupBy("size").agg(
        F.sum("s").alias("k"), F.max("s").alias("longest"), F.min(F.floor(F.col("s") / (F.floor(F.col("s") / 9) + 1))).alias("step"))
    sizes = {r["size"]: r for r in length.collect()}       # at most five rows
    small = sum(r["k"] for r in sizes.values()) <= most_broadcast
    placed = placed.distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = texts.select("doc_id", "text_key", words(F.col("text")).alias("w"))
    keys = ["doc_id", "text_key", "n", "size", "total", "pos"]
    found = []
    for size in sorted(sizes):
        mine, step = placed.where(F.col("size") == size), max(1, sizes[size]["step"])
        # hashes are a column before they are exploded: compiled code then passes the words on by reference, uncopied;
        # an outer explode, as for an inner one the optimizer filters by the whole expression, which splits texts per shingle
        hashed = rows.withColumn("hs", shingle_hashes(F.col("w"), F.lit(size), step)).withColumn("total", F.size("w"))
        hashed = hashed.select("doc_id", "text_key", "total", *(["w"] if small else []), F.posexplode_outer("hs").alias("pos", "h"))
        hits = hashed.join(F.broadcast(mine) if small else mine, "h").withColumn("pos", F.col("pos") * step)
        most = max(1, sizes[size]["longest"] // step)
        if small:       # a hit takes along the words of all windows that it is in
            first = F.greatest(F.lit(0), F.col("pos") - (F.col("n") - F.col("size")))
            hits = hits.select(*keys, F.slice("w", first + 1, F.col("pos") + F.col("n") - first).alias("around"))
            cut = _starts(hits.groupBy(*keys).agg(F.first("around").alias("around")), step, most)
            region = F.slice("around", F.col("low") - first + 1, F.col("high") - F.col("low") + F.col("n"))
        else:
            places = _starts(hits.select(*keys).distinct(), step, most).withColumnsRenamed({"doc_id": "of", "text_key": "of_key"})
            cut = places.join(texts, F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("of_key") == F.col("text_key")))
            cut = cut.withColumn("w", words(F.col("text")))
            region = F.slice("w", F.col("low") + 1, F.col("high") - F.col("low") + F.col("n"))
        found.append(cut.select("doc_id", "text_key", "n", "size", "low", "high", region.alias("region")))
    if not found:
        return rows.where("false").selectExpr("doc_id", "text_key", "0 start", "0 n", "0 size", "w")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    some = out.withColumn("start", F.explode(F.sequence("low", "high")))
    return some.select("doc_id", "text_key", "start", "n", "size", F.slice("region", F.col("start") - F.col("low") + 1, F.col("n")).alias("w"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, most_broadcast: int = MOST_BROADCAST,
            most_filed: int = MOST_FILED) -> DataFrame:
    """(doc_id, text_key, item_id, start, n, similarity): every window that an item matches, and how many words it has."""
    # both tables are written with their fingerprints: filters on these would else be pushed into their expressions
    items = written(benchmark_items(benchmark), "items")
    seen = windows(docs, items, most_broadcast).withColumn("h", shingle_hashes(F.col("w"), F.col("size")))
    seen = written(seen.withColumn("fp", simhash(F.col("h"))).drop("h"), "windows")
    filed = items.select("item_id", F.col("n").alias("item_n"), F.col("fp").alias("item_fp"), "shingle", F.explode(F.array(*[
        F.struct(F.lit(i).alias("no"), _block(F.col("fp"), low, width).alias("value"), F.array(*[F.lit(m).cast("long") for m in _masks(width)]).alias("masks"))
        for i, (low, width) in enumerate(BLOCKS)])).alias("b"))
    filed = filed.select("item_id", "item_n", "item_fp", F.col("b.no").alias("no"), F.explode(F.transform("b.masks", lambda m: F.col("b.value").bitwiseXOR(m))).alias("value"))
    filed = filed.hint("broadcast" if items.count() <= most_filed else "merge")
    asked = seen.select("doc_id", "text_key", "start", "n", "fp", F.posexplode(F.array(*[_block(F.col("fp"), *b) for b in BLOCKS])).alias("no", "value"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    pairs = (asked.join(filed, (asked["no"] == filed["no"]) & (asked["value"] == filed["value"]) & (F.col("n") == F.col("item_n"))).where(near)
             .select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_key"), F.col("start").alias("of_start"), F.col("n").alias("of_n"), "item_id").distinct())
    texts = items.select("item_id", "shingle").withColumnRenamed("item_id", "of_item")
    full = seen.select("doc_id", "text_key", "start", "n", F.size("w").alias("n_words"), shingles(F.col("w"), F.col("size")).alias("own"))
    pairs = written(pairs, "pairs")
    checked = (pairs.join(full, F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("of_key") == F.col("text_key"))
                          & (F.col("of_start") == F.col("start")) & (F.col("of_n") == F.col("n")))
               .join(texts, F.col("item_id").eqNullSafe(F.col("of_item"))))
    return (checked.withColumn("similarity", weighted_similarity(F.col("own"), F.col("shingle"))).where(F.col("similarity") >= similarity)
            .select("doc_id", "text_key", "item_id", "start", F.col("n_words").alias("n"), "similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): the best window for each document and item."""
    best = F.struct("similarity", (-F.col("start")).alias("before"), "n")
    top = matches(docs, benchmark, **settings).groupBy("doc_id", "item_id").agg(F.max(best).alias("m"))
    return top.select("doc_id", "item_id", (-F.col("m.before")).alias("first_word"), F.col("m.n").alias("n_words"), F.col("m.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` whose text matches no item."""
    hit = matches(docs.select("doc_id", "text"), benchmark, **settings).select(F.col("text_key").alias("hit_key")).distinct()
    name = "`{}`".format
    return docs.join(hit, F.xxhash64(docs["text"]) == F.col("hit_key"), "left_anti").select(*[F.col(name(c)) for c in docs.columns])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Brute force over all item-sized windows (shorter documents whole) of the document and item pairs that share any shingle.
ORACLE = f"""
WITH items AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM benchmark),
sized AS (SELECT item_id, w, len(w) AS n, least(len(w), {SIZE}) AS k FROM items WHERE len(w) > 0),
item_shingles AS (SELECT item_id, n, k, [array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, n - k + 2)] AS s FROM sized),
docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM sized),
doc_shingles AS (SELECT doc_id, k, [array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] AS s FROM docs, sizes),
pairs AS (SELECT DISTINCT d.doc_id, d.k, i.item_id FROM (SELECT doc_id, k, unnest(s) AS x FROM doc_shingles) d
    JOIN (SELECT item_id, k, unnest(s) AS x FROM item_shingles) i ON d.x = i.x AND d.k = i.k),
tried AS (SELECT p.doc_id, p.item_id, least(i.n, len(d.s) + p.k - 1) AS n, i.s AS b, unnest(range(0, greatest(len(d.s) - len(i.s), 0) + 1)) AS start, d.s AS whole
    FROM pairs p JOIN item_shingles i ON i.item_id = p.item_id JOIN doc_shingles d ON d.doc_id = p.doc_id AND d.k = p.k),
cut AS (SELECT doc_id, item_id, n, b, start, whole[start + 1:start + len(b)] AS a FROM tried),
same AS (SELECT *, list_sum([least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))) FOR x IN list_distinct(list_intersect(a, b))]) AS both_n
    FROM cut WHERE list_has_any(a, b)),
scored AS (SELECT *, both_n::DOUBLE / (len(a) + len(b) - both_n) AS similarity FROM same),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM scored WHERE similarity >= {SIMILARITY})
SELECT doc_id, item_id, start::INT AS first_word, n::INT AS n_words, similarity FROM best WHERE r = 1
"""

QUERIES = {"op6_decontamination": op6_decontamination}
ORACLES = {"op6_decontamination": ORACLE}
