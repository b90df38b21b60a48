"""Embedding whitening (11): components of an exact covariance by its characteristic polynomial.

Entries c become integers x = floor(64 c) + 1000000, so the scatter matrix
M = n * sum(x x') - S S' of the distinct vectors is exact. Its characteristic
polynomial is computed modulo many primes, each prime one row of a Spark job
(Hessenberg form), and put together by Chinese remainders; its real roots are
isolated exactly and refined to ``BITS`` bits (``polynomial``); components are
found by inverse iteration on the null space of M - root in ``FIXED``-bit
fixed-point numbers and rounded to double at the very end. An eigenvalue of M is
n * n times that of the covariance.

Scale: vectors are deduplicated as packed bytes (combined before the shuffle, so
repeated vectors are no hot key). Each task adds up its part of the sums exactly
and hands on d * d numbers in 30-bit limbs; only sums come to the driver, which
holds d * d integers whatever the rows are. Whitening is a projection without a
shuffle.

Defined cases: a vector is dropped if it is null, holds null or non-finite
entries, has another length than most vectors (ties: the longer), or an entry
whose integer exceeds 62 bits; repeated vec_ids and null vec_ids are rows like others;
components without variance can't be scaled and are left out, so equal vectors
or a single one give no rows; equal eigenvalues get an orthonormal basis of
their space; a deviation that exceeds a long is null; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import polynomial
from .common import importable, table, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BITS, FIXED = 200, 320
PRIME_LIMIT = 1 << 31
#: Primes that one task works through.
PRIMES_EACH = 8
_LIMB = 30
_SPLIT = 20                                   # products of 20-bit parts of 8192 rows add up exactly in doubles
_ROWS = 1 << 13


@dataclass
class Whitening:
    """A fitted model; rows of ``axes`` are components, ``roots`` and ``trace`` belong to n * n times the covariance."""
    n: int
    sums: list[int]                           # of x - SHIFT
    axes: np.ndarray
    roots: list[float]                        # square roots of the eigenvalues of n * n times the covariance
    explained: list[float]
    eigenvalues: list[float]
    dims: int


# ---- integers ---------------------------------------------------------------------------

def integers(column, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the valid rows of a list column, and their floor(64 c) as an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    places = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(places)).flatten()
    values = flat.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(len(places), dims)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        good = (np.abs(scaled) < float(1 << 62)).all(axis=1)          # False for NaN and infinities
    return places[good], scaled[good].astype(np.int64)


def pack(rows: np.ndarray) -> list[bytes]:
    """Each row as bytes, equal for equal rows: 2 or 8 bytes an entry, by the row."""
    small = (np.abs(rows) < 1 << 15).all(axis=1) if len(rows) else np.zeros(0, bool)
    narrow = np.where(small[:, None], rows, 0).astype("<i2")
    return [narrow[i].tobytes() if small[i] else rows[i].astype("<i8").tobytes() for i in range(len(rows))]


def unpack(keys: pa.Array, dims: int) -> np.ndarray:
    out = np.empty((len(keys), dims), np.int64)
    for width in (2, 8):
        at = np.flatnonzero(pc.equal(pc.binary_length(keys), width * dims).to_numpy(zero_copy_only=False))
        if len(at):
            out[at] = np.frombuffer(b"".join(keys.take(pa.array(at)).to_pylist()), f"<i{width}").reshape(-1, dims)
    return out


def _encode(dims: int):
    def encode(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pack(integers(b.column("embedding"), dims)[1]), pa.binary())], names=["key"])
    return encode


def _scatter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums and sum of outer products, as Python integers."""
    dims = rows.shape[1]
    sums, outer = np.zeros(dims, object), np.zeros((dims, dims), object)
    for i in range(0, len(rows), _ROWS):
        part = rows[i: i + _ROWS]
        digits = []
        while True:
            if len(part) == 0 or np.abs(part).max() < 1 << _SPLIT:
                digits.append(part.astype(float))
                break
            digits.append((part & (1 << _SPLIT) - 1).astype(float))
            part = part >> _SPLIT
        for k, a in enumerate(digits):
            sums += a.sum(axis=0).astype(np.int64).astype(object) << _SPLIT * k
            for m, b in enumerate(digits):
                outer += (a.T @ b).astype(np.int64).astype(object) << _SPLIT * (k + m)
    return sums, outer


def _limbs(values) -> tuple[list[int], list[int], list[int]]:
    at, limb, part = [], [], []
    for i, v in enumerate(values):
        sign, v, k = (-1 if v < 0 else 1), abs(int(v)), 0
        while v:
            at.append(i)
            limb.append(k)
            part.append(sign * (v & (1 << _LIMB) - 1))
            v, k = v >> _LIMB, k + 1
    return at, limb, part


def _add_up(dims: int):
    def add_up(batches):
        n, sums, outer = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            rows = unpack(b.column("key"), dims)
            s, o = _scatter(rows)
            n, sums, outer = n + len(rows), sums + s, outer + o
        at, limb, part = _limbs([n, *sums, *outer[np.triu_indices(dims)]])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(limb, pa.int32()), pa.array(part, pa.int64())], names=["at", "limb", "part"])
    return add_up


# ---- components ------------------------------------------------------------------------------

def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact, of a symmetric positive semi-definite matrix of Python integers; one Spark row per prime."""
    importable(spark)
    dims, trace = len(matrix), int(sum(matrix[i, i] for i in range(len(matrix))))
    # a coefficient is an elementary symmetric sum of roots >= 0, largest when they are equal (Maclaurin)
    bound = 2 * max(math.comb(dims, k) * trace ** k // dims ** k + 1 for k in range(dims + 1)) + 1
    primes = polynomial.primes_below(PRIME_LIMIT, bound.bit_length() // (PRIME_LIMIT.bit_length() - 2) + 1)

    def residues(batches):
        for b in batches:
            ids = b.column("id").to_pylist()
            found = [polynomial.charpoly_mod((matrix % primes[i]).astype(np.int64), primes[i]) for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found, pa.list_(pa.int64()))], names=["id", "residues"])

    rows = spark.range(0, len(primes), 1, -(-len(primes) // PRIMES_EACH)).mapInArrow(residues, "id long, residues array<long>").collect()
    found = {r.id: r.residues for r in rows}
    return polynomial.remainders([found[i] for i in range(len(primes))], primes)


def null_space(matrix: np.ndarray, root: int, fixed: int, vectors: int) -> np.ndarray:
    """Orthonormal rows that span the null space of ``matrix`` - ``root`` (fixed-point integers), to double precision."""
    n = len(matrix)
    a = matrix - np.diag(np.array([root] * n, object))
    order = np.arange(n)
    lower = np.zeros((n, n), object)
    for j in range(n):
        k = j + max(range(n - j), key=lambda i: abs(a[j + i, j]))
        a[[j, k]], lower[[j, k]], order[[j, k]] = a[[k, j]], lower[[k, j]], order[[k, j]]
        if a[j, j] == 0:
            a[j, j] = 1                       # the least fixed-point number, as in inverse iteration
        if j + 1 < n:
            lower[j + 1:, j] = (a[j + 1:, j] << fixed) // a[j, j]
            a[j + 1:, j + 1:] -= lower[j + 1:, j][:, None] * a[j, j + 1:] >> fixed
            a[j + 1:, j] = 0
    found: list[np.ndarray] = []
    for v in range(vectors):
        # any start that is not orthogonal to the space: odd pseudo-random numbers, other ones for each vector
        x = np.array([(pow(2 * i + 3, 5 + v, 1_000_003) * 2 + 1) << fixed - 22 for i in range(n)], object)
        for _ in range(3):
            x = _solve(a, lower, x[order], fixed)
            for u in found:
                x = x - (sum(x * u) >> fixed) * u // (1 << fixed)
            x = _unit(x, fixed)
        found.append(x)
    return np.array([[int(c) / (1 << fixed) for c in u] for u in found])


def _solve(upper: np.ndarray, lower: np.ndarray, x: np.ndarray, fixed: int) -> np.ndarray:
    n, x = len(x), x.copy()
    for j in range(n):
        x[j + 1:] -= lower[j + 1:, j] * x[j] >> fixed
    for j in reversed(range(n)):
        x[j] = (x[j] << fixed) // upper[j, j]
        x[:j] -= upper[:j, j] * x[j] >> fixed
    return x


def _unit(x: np.ndarray, fixed: int) -> np.ndarray:
    norm = math.isqrt(int(sum(x * x))) or 1
    return np.array([(int(c) << fixed) // norm for c in x], object)


def components(matrix: np.ndarray, poly: list[int], most: int) -> list[tuple[int, int, np.ndarray]]:
    """Up to ``most`` of (eigenvalue as near, shift; unit eigenvector), eigenvalues falling, without zeros."""
    trace = int(sum(matrix[i, i] for i in range(len(matrix))))
    if not trace:
        return []
    size = trace.bit_length()
    scaled = np.array([[(int(c) << FIXED) >> size for c in row] for row in matrix], object)
    out: list[tuple[int, int, np.ndarray]] = []
    seen = 0
    for near, shift, low, low_shift in polynomial.largest_roots(polynomial.square_free(poly), most, BITS):
        if near == 0 or len(out) >= most:
            break
        upto = polynomial.roots_above(poly, low, low_shift)          # with multiplicity
        root = (near << FIXED) >> size + shift
        out += [(near, shift, axis) for axis in null_space(scaled, root, FIXED, upto - seen)]
        seen = upto
    return out[:most]


# ---- the operator ---------------------------------------------------------------------------------

def dimensions(embeddings: DataFrame) -> int:
    """The most frequent length of a vector (ties: the longer); 0 without vectors."""
    lengths = embeddings.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("dims")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    return first.dims if first else 0


def fit(embeddings: DataFrame, most: int = COMPONENTS) -> tuple[Whitening | None, DataFrame | None]:
    """The model of ``embeddings`` (embedding, ...) and the table of distinct packed vectors; None without variance."""
    spark = embeddings.sparkSession
    importable(spark)
    vectors = embeddings.select("embedding")
    dims = dimensions(vectors)
    if not dims:
        return None, None
    distinct = written(vectors.mapInArrow(_encode(dims), "key binary").distinct(), "whitening-vectors")
    sums = distinct.mapInArrow(_add_up(dims), "at int, limb int, part long").groupBy("at", "limb").agg(F.sum("part").alias("part"))
    totals = [0] * (1 + dims + dims * (dims + 1) // 2)
    for r in sums.collect():                                # d * d sums, whatever the rows are
        totals[r.at] += r.part << _LIMB * r.limb
    n, sums_x, outer = totals[0], totals[1: dims + 1], np.zeros((dims, dims), object)
    outer[np.triu_indices(dims)] = totals[dims + 1:]
    outer = np.where(np.tri(dims, k=-1, dtype=bool), outer.T, outer)
    matrix = np.array([[n * int(outer[i, j]) - sums_x[i] * sums_x[j] for j in range(dims)] for i in range(dims)], object).reshape(dims, dims)
    trace = int(sum(matrix[i, i] for i in range(dims)))
    if not trace:
        return None, None
    found = components(matrix, characteristic_polynomial(spark, matrix), most)
    return Whitening(
        n, sums_x, np.array([axis for _, _, axis in found]),
        [math.isqrt(near << (2 * FIXED - shift if 2 * FIXED > shift else 0)) / (1 << FIXED) if 2 * FIXED > shift
         else math.sqrt(near / (1 << shift)) for near, shift, _ in found],
        [near / (trace << shift) for near, shift, _ in found], [near / (n * n << shift) for near, shift, _ in found], dims), distinct


def project(model: Whitening, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whitened components of integer rows, their exact squared deviations, and which of these fit a long."""
    if len(rows) and float(np.abs(rows).max()) * model.n + max(abs(s) for s in model.sums) < 1 << 62:
        away = rows * np.int64(model.n) - np.array(model.sums, np.int64)
    else:
        away = rows.astype(object) * model.n - np.array(model.sums, object)
    real = away.astype(float)
    fits = (real * real).sum(axis=1) < float(1 << 63) * (1 - 1e-9)
    if away.dtype == object:
        deviation = np.array([int(d) if f else 0 for d, f in zip((away * away).sum(axis=1), fits)], np.int64)
    else:
        with np.errstate(over="ignore"):
            deviation = (away * away).sum(axis=1)           # wraps only where it doesn't fit
    return real @ model.axes.T / np.array(model.roots), deviation, fits


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened distinct vectors minus the identity."""
    k = len(model.roots)

    def add_up(batches):
        total, outer = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = project(model, unpack(b.column("key"), model.dims))[0]
            total, outer = total + w.sum(axis=0), outer + w.T @ w
        values = np.r_[total, outer.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["at", "part"])

    # decimals add up to the same sum in any order
    rows = (distinct.mapInArrow(add_up, "at int, part double").groupBy("at")
            .agg(F.sum(F.col("part").cast("decimal(38,16)")).cast("double").alias("total")).collect())
    values = np.zeros(k + k * k)
    for r in rows:
        values[r.at] = r.total / model.n
    return float(np.abs(values[k:].reshape(k, k) - np.outer(values[:k], values[:k]) - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"


def whiten(embeddings: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per valid row of ``embeddings`` (vec_id, embedding) and component."""
    k = len(model.roots)

    def rows_of(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                b = batch.slice(i, _ROWS)
                places, rows = integers(b.column("embedding"), model.dims)
                if not len(places):
                    continue
                white, deviation, fits = project(model, rows)
                m = len(places)
                times = pa.array(np.repeat(np.arange(m), k))
                of_row = lambda column: column.take(times)
                of_component = lambda values: pa.array(np.tile(values, m))
                yield pa.RecordBatch.from_arrays([
                    of_row(b.column("vec_id").take(pa.array(places))), of_component(np.arange(1, k + 1, dtype=np.int32)),
                    pa.array(np.full(m * k, model.n, np.int64)), of_row(pa.array(deviation, mask=~fits)), pa.array(white.ravel()),
                    of_component(np.array(model.explained)), pa.array(np.full(m * k, error)), of_component(np.array(model.eigenvalues))],
                    names=[c.split()[0] for c in _OUT.split(", ")])
    return embeddings.select("vec_id", "embedding").mapInArrow(rows_of, _OUT)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    model, distinct = fit(embeddings)
    if model is None:
        return spark.createDataFrame([], _OUT)
    return whiten(embeddings, model, identity_error(model, distinct))


QUERIES = {"op11_whitening": op11_whitening}
ORACLES: dict[str, str] = {}
