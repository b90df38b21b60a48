"""Substring dedup (9): windows of words counted exactly in super-k-mer buckets.

A window is ``width`` consecutive words of one document, words unchanged. Its
minimiser is the smallest hash among its runs of ``mer`` words. Consecutive
windows with one minimiser form a super-k-mer: they travel as a single packed
string to the minimiser's bucket, which is the same for equal windows wherever
they occur. In the bucket, windows are sorted by hash and document; equal hashes
are confirmed by comparing the words' bytes. Every window that also occurs in a
document with a smaller id marks its words; marked words are removed.

Documents are dealt into batches by their place in the input, and each batch first settles windows
that repeat inside it: only those of the smallest id go on to the buckets. A
passage that a third of all documents share so reaches its bucket once per
batch, not once per document.

A line shorter than a window gives one minimiser to many different windows. So
all windows are counted by minimiser first, over the whole input, and those of a minimiser with more than
``MOST_WINDOWS`` go by the smallest hash among their runs of half a window's words,
and where that is as crowded, by the hash of the whole window. Equal windows
have equal keys at each step, so they still meet. Counts only choose the way:
results don't depend on them.

Defined cases: a null text has no words (kept text "", n_words 0); fewer words
than ``width`` are kept whole; a null doc_id counts as larger than every id;
rows with equal ids don't remove each other's words, nor does a document its
own repeats; exactly repeated rows get equal results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashed_words, importable, mix, n_groups, slices, table, text_buffer, words_of

BATCH_BYTES = 2 << 20            # of stored input; more on larger executors
#: Buckets for each batch: a bucket holds overlapping strings, some three times the text of its share of the input.
BUCKETS_PER_BATCH = 2
MOST_WINDOWS = 1 << 17           # of one minimiser in a bucket
_STEP = np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))

_PACKED = pa.schema([("bucket", pa.int64()), ("meta", pa.binary()), ("words", pa.binary()), ("spans", pa.binary())])
_COUNTS = pa.schema([("low", pa.int64()), ("windows", pa.int64())])
_SPANS = pa.schema([("batch", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
#: Columns of a super-k-mer: batch, row key, id, first word, words, bytes.
_META = 6


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class Words:
    """All words of a column in one buffer, each followed by one space."""

    def __init__(self, column):
        data, offsets = text_buffer(column)
        parts, sizes, self.per_doc = [], [], np.zeros(0, np.int64)
        for i, j in slices(offsets):
            part = data[offsets[i]: offsets[j]]
            starts, ends, per_doc = words_of(part, offsets[i: j + 1] - offsets[i])
            length = ends - starts + 1
            at = np.cumsum(length) - length
            out = np.full(int(length.sum()), 32, np.uint8)
            inner = np.ones(len(out), bool)
            inner[at + length - 1] = False
            solid = np.zeros(len(part) + 1, np.int8)
            np.add.at(solid, starts, 1)
            np.add.at(solid, ends, -1)
            out[inner] = part[np.cumsum(solid[:-1]).astype(bool)]
            parts.append(out.tobytes())
            sizes.append(length)
            self.per_doc = np.concatenate([self.per_doc, per_doc])
        self.bytes = b"".join(parts)
        self.at = np.concatenate([[0], np.cumsum(np.concatenate(sizes) if sizes else np.zeros(0, np.int64))])
        self.begin = np.cumsum(self.per_doc) - self.per_doc

    def cut(self, first: int, last: int) -> bytes:
        """Words first to last - 1, joined by one space."""
        return self.bytes[self.at[first]: max(self.at[first], self.at[last] - 1)]


def _hashes(column) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(h for _, _, _, h in hashed_words(column, lower=False))])


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, across document borders too."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = np.full(n, _STEP, np.uint64), np.full(n, _BACK, np.uint64)
    up[0] = down[0] = 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * np.cumprod(up, dtype=np.uint64), out=total[1:])
    return mix((total[width:] - total[:-width]) * np.cumprod(down, dtype=np.uint64)[: n - width + 1])


def window_starts(per_doc: np.ndarray, width: int) -> np.ndarray:
    """Where windows begin, counting words over all documents."""
    n = np.maximum(per_doc - width + 1, 0)
    begin = np.cumsum(per_doc) - per_doc
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def minimisers(h: np.ndarray, starts: np.ndarray, width: int, mer: int) -> np.ndarray:
    """The smallest hash of ``mer`` words in each window."""
    low, span, want = runs(h, mer), 1, width - mer + 1
    while span * 2 <= want:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    return np.minimum(low[starts], low[starts + want - span])


def levels(width: int, mer: int) -> list[int]:
    """Words per run whose smallest hash is a window's key: the minimiser, half a window, the whole."""
    return sorted({mer, max(mer, width // 2), width})


def routes(h: np.ndarray, starts: np.ndarray, width: int, mer: int, heavy: list[np.ndarray]) -> np.ndarray:
    """The key of each window: its smallest hash at the first level where that is not ``heavy``."""
    key = minimisers(h, starts, width, mer)
    rest = np.arange(len(starts))
    for crowded, longer in zip(heavy, levels(width, mer)[1:], strict=False):
        rest = rest[np.isin(key[rest], crowded)]
        if not len(rest):
            break
        key[rest] = minimisers(h, starts[rest], width, longer)
    return key


def crowds(text, width: int, mer: int, heavy: list[np.ndarray]) -> pa.Table:
    """(low, windows): the windows of a slice by the key of the level after those of ``heavy``, which all crowded them.

    Equal windows of a slice count once where a key has more of them than one place can give it.
    """
    parts = list(hashed_words(text, lower=False))
    h = np.concatenate([np.zeros(0, np.uint64), *(p[3] for p in parts)])
    starts = window_starts(np.concatenate([np.zeros(0, np.int64), *(p[2] for p in parts)]), width)
    lengths = levels(width, mer)
    for crowded, run in zip(heavy, lengths, strict=False):
        starts = starts[np.isin(minimisers(h, starts, width, run), crowded)] if len(starts) else starts
    if not len(starts):
        return _COUNTS.empty_table()
    run = lengths[len(heavy)]
    low = minimisers(h, starts, width, run)
    # neighbouring windows mostly have one key: runs of equal keys are counted, not windows
    cut = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    kinds, which = np.unique(low[cut], return_inverse=True)
    n = np.bincount(which, np.diff(np.append(cut, len(low)))).astype(np.int64)
    many = n > width - run + 1
    if many.any():
        again = starts[np.isin(low, kinds[many])]
        _, one = np.unique(runs(h, width)[again], return_index=True)
        _, n[many] = np.unique(minimisers(h, again[one], width, run), return_counts=True)
    return pa.table([pa.array(kinds.view(np.int64)), pa.array(n)], schema=_COUNTS)


def repeats(words: Words, h: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int):
    """Of windows at ``starts`` in documents ``ids``: does an equal one have a smaller id?"""
    w = runs(h, width)[starts] if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((ids, w))
    head = np.ones(len(order), bool)
    head[1:] = w[order][1:] != w[order][:-1]
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = np.flatnonzero(ids > ids[lead])
    found = np.zeros(len(order), bool)
    # confirm by the words themselves: runs of windows that match runs of windows at once
    if len(later):
        a, b = starts[later], starts[lead[later]]
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 1) | (np.diff(b) != 1), [True]]))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if words.cut(a[i], a[j - 1] + width) == words.cut(b[i], b[j - 1] + width):
                found[later[i:j]] = True
            else:                                    # hashes collide: settle these windows one by one
                for x in later[i:j]:
                    mine = words.cut(starts[x], starts[x] + width)
                    same = np.flatnonzero((w == w[x]) & (ids < ids[x]))
                    found[x] = any(words.cut(starts[y], starts[y] + width) == mine for y in same)
    return found


def _spans(place: np.ndarray, group: np.ndarray, width: int):
    """Rows of runs of consecutive windows, with the first word and the one after the last."""
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(group) != 0), [True]]))
    return cut[:-1], place[cut[:-1]], place[cut[1:] - 1] + width


def pack(group: pa.Table, buckets: int, width: int, mer: int, heavy: list[np.ndarray]) -> pa.Table:
    """Super-k-mers of one batch by bucket, and the words it could mark itself."""
    words, h = Words(group["text"]), _hashes(group["text"])
    starts = window_starts(words.per_doc, width)
    if not len(starts):
        return _PACKED.empty_table()
    batch = group["batch"][0].as_py()
    ids, keys = np.asarray(group["id"].combine_chunks()), np.asarray(group["key"].combine_chunks())
    doc = np.searchsorted(words.begin, starts, "right") - 1
    doc = np.repeat(np.arange(len(ids)), np.maximum(words.per_doc - width + 1, 0))
    marked = repeats(words, h, starts, ids[doc], width)
    at, first, last = _spans(starts[marked], doc[marked], width)
    mine = doc[marked][at]
    local = np.stack([np.full(len(at), batch), keys[mine], first - words.begin[mine], last - words.begin[mine]], 1).astype(np.int64)
    rest = ~marked
    starts, doc = starts[rest], doc[rest]
    low = routes(h, starts, width, mer, heavy) if len(starts) else np.zeros(0, np.uint64)
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(doc) != 0) | (low[1:] != low[:-1])])) if len(low) else np.zeros(0, np.int64)
    first, d = starts[cut], doc[cut]
    last = starts[np.append(cut[1:], len(starts)) - 1] + width if len(cut) else first
    size = words.at[last] - words.at[first]
    meta = np.stack([np.full(len(cut), batch), keys[d], ids[d], first - words.begin[d], last - first, size], 1).astype(np.int64)
    to = (low[cut] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[order], np.arange(buckets + 1))
    whose = np.abs(local[:, 1]) % buckets
    out = []
    a, b = words.at[first].tolist(), words.at[last].tolist()
    for k in range(buckets):
        own, spans = order[edges[k]: edges[k + 1]], local[whose == k]
        if len(own) or len(spans):
            packed = b"".join([words.bytes[a[i]: b[i]] for i in own.tolist()])
            out.append((k, zstandard.compress(meta[own].tobytes(), 1), zstandard.compress(packed, 3), spans.tobytes()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PACKED, strict=True)], schema=_PACKED)


def settle(group: pa.Table, width: int) -> pa.Table:
    """Word ranges to remove, from one bucket's super-k-mers and the batches' own findings."""
    ready = np.concatenate([np.frombuffer(x, np.int64) for x in group["spans"].to_pylist()]).reshape(-1, 4)
    meta = np.concatenate([np.frombuffer(zstandard.decompress(x), np.int64) for x in group["meta"].to_pylist()]).reshape(-1, _META)
    text = b"".join(zstandard.decompress(x) for x in group["words"].to_pylist())
    offsets = np.concatenate([[0], np.cumsum(meta[:, 5])]).astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(meta), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text))
    words, h = Words(column), _hashes(column)
    starts = window_starts(words.per_doc, width)
    row = np.repeat(np.arange(len(meta)), np.maximum(words.per_doc - width + 1, 0))
    marked = repeats(words, h, starts, meta[row, 2], width)
    at, first, last = _spans(starts[marked], row[marked], width)
    r = row[marked][at]
    move = meta[r, 3] - words.begin[r]
    found = np.concatenate([ready, np.stack([meta[r, 0], meta[r, 1], first + move, last + move], 1)])
    return pa.table([pa.array(found[:, i]) for i in range(4)], schema=_SPANS)


def keep(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """What is left of each document."""
    if docs.num_rows == 0:
        return _KEPT.empty_table()
    words, keys = Words(docs["text"]), np.asarray(docs["key"].combine_chunks())
    whose = np.asarray(spans["key"].combine_chunks()) if spans.num_rows else np.zeros(0, np.int64)
    order = np.argsort(whose, kind="stable")
    first, last = (np.asarray(spans[c].combine_chunks())[order] if spans.num_rows else whose for c in ("first", "last"))
    lo, hi = np.searchsorted(whose[order], keys, "left"), np.searchsorted(whose[order], keys, "right")
    removed, sha = np.zeros(len(keys), np.int64), []
    for d, (b, n) in enumerate(zip(words.begin.tolist(), words.per_doc.tolist(), strict=True)):
        if lo[d] == hi[d]:
            sha.append(hashlib.sha256(words.cut(b, b + n)).hexdigest())
            continue
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, first[lo[d]: hi[d]], 1)
        np.add.at(step, last[lo[d]: hi[d]], -1)
        gone = np.cumsum(step[:-1]) > 0
        removed[d] = gone.sum()
        cut = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
        left = [words.cut(b + x, b + y) for x, y in zip(cut[::2].tolist(), cut[1::2].tolist(), strict=True)]
        sha.append(hashlib.sha256(b" ".join(left)).hexdigest())
    return pa.table([docs["doc_id"].cast(pa.int64()), pa.array(words.per_doc), pa.array(removed), pa.array(sha, pa.string())], schema=_KEPT)


def _dealt(docs: DataFrame, batch_bytes: int) -> tuple[DataFrame, int]:
    batches = n_groups(docs.select("text"), batch_bytes)
    key = F.xxhash64("doc_id", "text")
    # dealt by the row's place in the input, so that repeated rows spread like others
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches))
    return docs.select(F.col("doc_id").cast("long"), "text", key.alias("key"), deal.alias("batch"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id")), BUCKETS_PER_BATCH * batches


def crowded(docs: DataFrame, width: int, mer: int, most: int) -> list[np.ndarray]:
    """By level, the keys of more than ``most`` windows in the whole input: at most one for each ``most`` windows.

    A level is counted only for the crowded keys of the one before.
    """
    heavy: list[np.ndarray] = []
    for _ in levels(width, mer)[:-1]:
        def counted(batches, above=tuple(heavy)):
            for b in batches:
                for i, j in slices(text_buffer(b.column(0))[1], 2 * BATCH_BYTES):
                    yield from crowds(b.column(0).slice(i, j - i), width, mer, list(above)).to_batches()

        many = docs.select("text").mapInArrow(counted, _ddl(_COUNTS)).groupBy("low").agg(F.sum("windows").alias("windows")).where(F.col("windows") > most)
        found = many.select("low").toArrow()["low"].combine_chunks()
        if not len(found):
            break
        heavy.append(np.asarray(found).astype(np.int64).view(np.uint64))
    return heavy


def _packed(dealt: DataFrame, buckets: int, width: int, mer: int, most: int) -> DataFrame:
    heavy = crowded(dealt, width, mer, most)
    return dealt.groupBy("batch").applyInArrow(lambda t: pack(t, buckets, width, mer, heavy), _ddl(_PACKED))


def _found(dealt: DataFrame, buckets: int, width: int, mer: int, most: int) -> DataFrame:
    return _packed(dealt, buckets, width, mer, most).groupBy("bucket").applyInArrow(lambda t: settle(t, width), _ddl(_SPANS))


def repeated_ranges(docs: DataFrame, width: int = 50, mer: int = 5, batch_bytes: int = BATCH_BYTES, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """(doc_id, first, last): word ranges that windows of smaller ids cover; ranges may overlap."""
    importable(docs.sparkSession)
    dealt, n = _dealt(docs, batch_bytes)
    ids = dealt.select("doc_id", "key", "batch").distinct()
    return _found(dealt, n, width, mer, most_windows).join(ids, ["key", "batch"]).select("doc_id", "first", "last")


def remove_repeats(docs: DataFrame, width: int = 50, mer: int = 5, batch_bytes: int = BATCH_BYTES, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs`` (doc_id, text)."""
    importable(docs.sparkSession)
    dealt, n = _dealt(docs, batch_bytes)
    found = _found(dealt, n, width, mer, most_windows)
    return dealt.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(keep, _ddl(_KEPT))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op9_substring_dedup": op9_substring_dedup}
ORACLES: dict[str, str] = {}
