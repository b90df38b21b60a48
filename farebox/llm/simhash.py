"""SimHash near-dedup (3): Golay-code fuzzy hashing of 64-bit fingerprints.

Fingerprint: A-Z lower-cased, words as in ``common``, shingles of ``size`` words
joined by a space, repeats included (fewer words: all of them as one shingle;
none: fingerprint zero). A bit is set if it is set in over half of the
shingles' XXH64 hashes (seed 42).

Search for fingerprints within ``max_bits`` (at most 2): the 64 bits are cut into
segments of 22, 21 and 21 bits, each read as a vector of the perfect binary
Golay code of length 23. Two errors over three segments leave some segment i without an
error and segment i+1 (cyclically) with at most one. So the key (i, segment i, codeword index
of segment i+1) is stored once per fingerprint, for the codeword nearest to the
segment (never further than 3), and probed for all codewords within 4 of the
segment, which are 1 or 6: a neighbour's nearest codeword is among them. A join
on the keys gives candidates, and the bit distance decides.

Only distinct fingerprints are searched; copies share one. Keys with more than
``hot_key`` fingerprints would give all pairs of a group, so all fingerprints of such
keys go another exact way: each is filed under itself and its 64 one-bit
changes. Two fingerprints differ in at most 2 bits exactly if they share such a
place, a place holds at most 65, and linking a place's smallest one to the
others keeps every connection.

Components: alternating large-star and small-star steps over the links, each
written to shared storage, until nothing changes; component_id is the smallest doc_id.

Defined cases: a null text is an empty one; a null doc_id is never a component's
id (null if a component has no other); repeated rows have one fingerprint;
no rows give no rows. Extra columns are ignored, ``keep_one`` returns them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import importable, table, written

SIZE, MAX_BITS, HOT_KEY, SEED = 3, 2, 64, 42
#: Segments: lowest bit and width.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Generator polynomial of the Golay code of length 23 (fixed value): x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101

_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


# ---- fingerprints ----------------------------------------------------------------

def fingerprint(text: str | None, size: int = SIZE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length + 1) - 1
        first = (end - length)[: len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(first, end[size - 1:].tolist(), strict=True)]
    h = np.array(hashes, "<u8")
    octets = h.view(np.uint8).reshape(-1, 8)
    counts = np.stack([np.bincount(octets[:, j], minlength=256) for j in range(8)]) @ _BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, row_key, fp) of each row; no shuffle. ``row_key`` is a hash of doc_id and text."""
    importable(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                fp = np.array([fingerprint(t, size) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "row_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


# ---- Golay code ------------------------------------------------------------------

def _remainder(x: np.ndarray) -> np.ndarray:
    for bit in range(22, 10, -1):
        x = np.where(x >> bit & 1, x ^ GOLAY << bit - 11, x)
    return x


def _near_patterns() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight at most 4, lightest first (0 fills up; count given)."""
    bits = [1 << i for i in range(23)]
    by_weight = [np.array([0])]
    for _ in range(4):
        grown = [int(x) | b for x in by_weight[-1] for b in bits if b > int(x)]
        by_weight.append(np.array(grown))
    patterns, found = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for p in by_weight:
        for pattern, s in zip(p.tolist(), _remainder(p).tolist(), strict=True):
            patterns[s, found[s]] = pattern
            found[s] += 1
    return patterns, found


_tables: list = []


def golay() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        _tables.append(_near_patterns())
    return _tables[0]


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, is the nearest codeword's) of fingerprints."""
    patterns, found = golay()
    seg = [(fp >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    rows, keys, nearest = [], [], []
    for i in range(3):
        v = seg[(i + 1) % 3]
        s = _remainder(v)
        for k in range(6):
            has = np.flatnonzero(found[s] > k)
            index = (v[has] ^ patterns[s[has], k]) >> 11
            rows.append(has)
            keys.append(i << 34 | seg[i][has] << 12 | index)
            nearest.append(np.full(len(has), k == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(nearest)


def golay_keys(prints: DataFrame) -> DataFrame:
    """(key, nearest, fp) of each distinct ``fp``."""
    def run(batches):
        for batch in batches:
            fp = np.asarray(batch.column(0))
            rows, keys, nearest = keys_of(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nearest), pa.array(fp[rows])], names=["key", "nearest", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, nearest boolean, fp long")


# ---- links -----------------------------------------------------------------------

def links(prints: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments of this code find up to 2 differing bits")
    keys = written(golay_keys(prints), "golay")
    hot = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_key).select("key")
    plain = keys.join(hot, "key", "left_anti")
    stored = plain.where("nearest").select("key", F.col("fp").alias("a"))
    probes = plain.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    found = stored.join(probes, "key").where((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowd = keys.join(hot, "key", "left_semi").select("fp").distinct()
    bits = [F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)]
    if max_bits == 2:       # itself and its neighbours: those who share one differ in 2 bits at most
        filed = [F.struct(F.lit(0).alias("bit"), F.col("fp").bitwiseXOR(x).alias("value")) for x in [F.lit(0).cast("long"), *bits]]
    else:                   # itself without a bit: those who share one differ in this bit at most
        filed = [F.struct(F.lit(i).alias("bit"), F.col("fp").bitwiseAND(F.bitwise_not(x)).alias("value")) for i, x in enumerate(bits)]
    places = crowd.select("fp", F.explode(F.array(*filed)).alias("place"))
    first = places.groupBy("place").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("place", "a")
    starred = places.join(first, "place").where((F.col("a") != F.col("fp")) & F.lit(max_bits > 0)).select("a", F.col("fp").alias("b"))
    return found.union(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links lead to, for nodes of (a, b) ``edges``.

    Large star: a node's larger neighbours are tied to its smallest one; small
    star: its smaller neighbours and itself are. Sums of row hashes tell when nothing changes.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("of"), F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "of")
        joined = large.join(low, F.col("u") == F.col("of"))
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(joined.select("u", F.col("low").alias("v")))
        edges = written(small.where("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = now


def cluster(docs: DataFrame, size: int = SIZE, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(doc_id, row_key, fp, root, component_id) of every row of ``docs`` (doc_id, text)."""
    rows = written(fingerprints(docs, size), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(prints, max_bits, hot_key)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, size: int = SIZE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each component the smallest (doc_id, row_key) stays, once.

    Of rows with equal id and text the one with the smallest hash of all its columns stays, so that reruns agree.
    """
    groups = cluster(docs, size, max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    chosen = groups.groupBy("root").agg(F.min(rank).alias("r")).select(F.col("r.row_key").alias("chosen_row")).distinct()
    name, keyed = "`{}`".format, docs.withColumn("chosen_row", F.xxhash64("doc_id", "text"))
    columns = [F.col(name(c)) for c in docs.columns]
    kept = keyed.join(chosen, "chosen_row", "left_semi").groupBy("chosen_row").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row"))
    return kept.select(*[F.col(f"row.{name(c)}") for c in docs.columns])


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash_dedup": op3_simhash_dedup}
ORACLES: dict[str, str] = {}
