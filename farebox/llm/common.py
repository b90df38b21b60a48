"""Shared helpers: table access, written tables, job sizing and vectorised words.

A *word* is a maximal run of bytes other than space and U+0009..U+000D, cut
from the UTF-8 bytes of a text. Words are handled as offsets into one byte
buffer and as 64-bit hashes, so that a batch costs a few numpy passes and no
Python object per word.
"""

from __future__ import annotations

import math
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import checkpoint_root

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes that separate words (fixed values).
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
#: Bytes of text handled by one numpy pass (at least one whole document).
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/llm/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in shared storage: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_estimate(df: DataFrame) -> int:
    """The optimizer's size of a table ``df`` in bytes (no job); where it knows none, 1 KB a row (a count)."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < 1 << 60 else df.count() << 10


def n_groups(df: DataFrame, bytes_each: int, least: int = 0) -> int:
    """How many groups of about ``bytes_each`` input bytes ``df`` makes; it grows with the input."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(least, 4 * cores, math.ceil(size_estimate(df) / bytes_each))


def crc_mod(col: str, mod: int):
    """``crc32(col as text) mod`` as a column; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def crc_mod_py(value, mod: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % mod


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping multiplications and shifts)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _pow(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        step = _BASE if kind == "up" else _BASE_INV
        grown = np.full(max(n, SLICE_BYTES + 1), step, np.uint64)
        grown[0] = 1
        have = np.cumprod(grown, dtype=np.uint64)
        if n <= 2 * SLICE_BYTES:      # one very long text doesn't stay in memory
            _powers[kind] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Ranges (i, j) of whole documents with about ``most`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends and words per document. Words don't cross documents."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    solid = ~_IS_SPACE[data]
    cut = np.zeros(n + 1, bool)          # a document begins here
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    per_doc = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, per_doc


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range (rolling polynomial, finalised with the length)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _pow("up", len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * _pow("down", len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def hashed_words(column: pa.Array, lower: bool = True):
    """For slices of a string column: (first row, last row + 1, words per row, word hashes)."""
    data, offsets = text_buffer(column)
    for i, j in slices(offsets):
        part, at = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        part = _LOWER[part] if lower else part
        starts, ends, per_doc = words_of(part, at)
        yield i, j, per_doc, word_hashes(part, starts, ends)
