"""Embedding whitening from exact integer covariances, counted on bit planes.

Entries become whole numbers x. Every dimension is shifted by its smallest x, and the bits of
what is left are packed across rows: plane b of a dimension holds bit b of 64 rows in each
word. The product sum of two dimensions is then the sum over pairs of planes (a, b) of
2^(a+b) times the bits set in the AND of both, which counts exactly. Tasks count for their
rows and Spark adds the counts; sums of counts, dimensions squared times levels of them,
however many rows there are, become Python's unbounded integers on the driver, are centred
there as integers, n * sum(xy) - sum(x) * sum(y), and only then turned into doubles for the
eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# x = floor(SCALE * c) + SHIFT, kept within LIMIT of zero (fixed values of the contract, and
# a bound beyond which 64-bit numbers would not do).
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 52
# Rows whose planes are packed at a time, a multiple of 64.
PLANE_ROWS = 16_384
# Components whose variance is below this share of the largest have no direction to tell.
LEAST_SHARE = 1e-13

FIT = "length int, dim int, n long, low long, high long, total decimal(38,0)"
COUNTS = "i int, j int, level int, n long"
MOMENTS = "i int, j int, total double"
WHITE = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def numbers(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x) for the usable vectors of a batch, one matrix per vector length.

    A vector is usable if it is not null or empty and all its entries are finite numbers.
    """
    vectors = batch.column("embedding")
    sizes = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy()
    for size in [length] if length is not None else np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        if not size or not len(rows):
            continue
        flat = vectors.take(pa.array(rows)).flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)
        good = np.isfinite(values).all(axis=1)  # a null entry is read as not a number
        if good.any():
            scaled = np.floor(SCALE * values[good]) + SHIFT
            yield size, rows[good], np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)


def _bounds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of FIT: per vector length and dimension what a task's rows span and sum up to."""
    found: dict[int, list] = {}
    for batch in batches:
        for size, _, x in numbers(batch):
            low, high = x.min(axis=0), x.max(axis=0)
            sums = [int(s) for s in (x - SHIFT).sum(axis=0, dtype=object)] if np.abs(x).max() > 1 << 40 else None
            sums = sums or (x - SHIFT).sum(axis=0).tolist()
            if size in found:
                held = found[size]
                found[size] = [
                    held[0] + len(x), np.minimum(held[1], low), np.maximum(held[2], high),
                    [a + b for a, b in zip(held[3], sums)],
                ]
            else:
                found[size] = [len(x), low, high, sums]
    for size, (n, low, high, sums) in found.items():
        totals = [Decimal(s + n * SHIFT) for s in sums]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                pa.array(low), pa.array(high), pa.array(totals, pa.decimal128(38, 0)),
            ],
            ["length", "dim", "n", "low", "high", "total"],
        )


class Planes:
    """Which bit planes there are: those of each dimension one after the other."""

    def __init__(self, low: list[int], high: list[int]):
        self.low = np.array(low, np.int64)
        self.bits = np.array([int(b - a).bit_length() for a, b in zip(low, high)], np.int64)
        self.dim = np.repeat(np.arange(len(low)), self.bits)
        self.bit = np.concatenate([np.arange(b) for b in self.bits]) if len(self.dim) else np.empty(0, np.int64)
        # a product of planes a and b counts 2^(a+b) times
        self.levels = int(2 * max(self.bits.max(initial=0) - 1, 0) + 1)

    def pack(self, x: np.ndarray) -> np.ndarray:
        """The planes of some rows, 64 rows a word; the last word is filled with zeros."""
        shifted = (x - self.low).astype(np.uint64)
        planes = ((shifted[:, self.dim] >> self.bit.astype(np.uint64)) & np.uint64(1)).astype(np.uint8).T
        padded = np.zeros((len(self.dim), -(-len(x) // 64) * 64), np.uint8)
        padded[:, : len(x)] = planes
        return np.packbits(padded, axis=1).view(np.uint64)

    def count(self, words: np.ndarray, counts: np.ndarray) -> None:
        """Add to counts[i, j, level] the rows whose bits are set in two planes, for i <= j."""
        for at in range(len(self.dim)):
            both = np.bitwise_count(words[at:] & words[at]).sum(axis=1, dtype=np.int64)
            i, level = self.dim[at], self.bit[at] + self.bit[at:]
            # a pair of different planes of one dimension stands for both its orders
            twice = (self.dim[at:] == i) & (np.arange(at, len(self.dim)) > at)
            np.add.at(counts, (i, self.dim[at:], level), np.where(twice, 2 * both, both))


def _plane_counts(batches: Iterable[pa.RecordBatch], planes: Planes, length: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((length, length, planes.levels), np.int64)
    for batch in batches:
        for _, _, x in numbers(batch, length):
            for at in range(0, len(x), PLANE_ROWS):
                planes.count(planes.pack(x[at : at + PLANE_ROWS]), counts)
    i, j, level = np.nonzero(counts)
    kinds = [pa.int32()] * 3 + [pa.int64()]
    columns = [i, j, level, counts[i, j, level]]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["i", "j", "level", "n"])


class Whitening:
    """The fitted map: exact n and sums, unit eigenvectors, their variances and shares."""

    def __init__(self, n: int, low: list[int], sums: list[int], products: dict[tuple[int, int], int], most: int):
        """``products`` are the sums of products of shifted entries, for i <= j."""
        size = len(sums)
        shifted = [s - n * a for s, a in zip(sums, low)]
        centred = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                # whole numbers up to here; the quotient is the nearest double
                exact = n * products.get((i, j), 0) - shifted[i] * shifted[j]
                centred[i, j] = centred[j, i] = exact / (n * n)
        values, vectors = np.linalg.eigh(centred)
        order = np.argsort(-values, kind="stable")[:most]
        trace = float(np.trace(centred))
        order = order[values[order] > LEAST_SHARE * max(trace, 0.0)]
        self.n, self.sums, self.covariance = n, sums, centred
        self.variances = values[order]
        self.explained = self.variances / trace if trace > 0 else self.variances
        self.components = vectors[:, order]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - sum(x) for each entry, exactly: int64 where that is certain to do."""
        if self._fits(x):
            return self.n * (x - SHIFT) - np.array([s - self.n * SHIFT for s in self.sums], np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def _fits(self, x: np.ndarray) -> bool:
        spread = max((int(np.abs(x - SHIFT).max(initial=0)), *(abs(s // self.n - SHIFT) + 1 for s in self.sums)))
        return len(self.sums) * (2 * self.n * spread) ** 2 < 1 << 62

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """Whitened components of rows given their exact deviations."""
        return (deviations.astype(np.float64) / self.n) @ self.components / np.sqrt(self.variances)


def _moments(batches: Iterable[pa.RecordBatch], fit: Whitening, length: int) -> Iterator[pa.RecordBatch]:
    """Sums (j = -1) and product sums of the whitened rows of a task."""
    size = len(fit.variances)
    sums, products = np.zeros(size), np.zeros((size, size))
    for batch in batches:
        for _, _, x in numbers(batch, length):
            white = fit.project(fit.deviations(x))
            sums += white.sum(axis=0)
            products += white.T @ white
    i, j = np.triu_indices(size)
    columns = [np.r_[np.arange(size), i], np.r_[np.full(size, -1), j], np.r_[sums, products[i, j]]]
    kinds = [pa.int32(), pa.int32(), pa.float64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["i", "j", "total"])


def _rows(batches: Iterable[pa.RecordBatch], fit: Whitening, length: int, error: float) -> Iterator[pa.RecordBatch]:
    size = len(fit.variances)
    for batch in batches:
        for _, rows, x in numbers(batch, length):
            away = fit.deviations(x)
            squares = (away * away).sum(axis=1)
            if squares.dtype == object:
                squares = [Decimal(s) if s < 10**38 else None for s in squares]
            count = len(rows) * size
            which = np.repeat(np.arange(len(rows)), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows[which])),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(count, fit.n)),
                    pa.array(squares).cast(pa.decimal128(38, 0)).take(pa.array(which)),
                    pa.array(fit.project(away).ravel()),
                    pa.array(np.tile(fit.explained, len(rows))),
                    pa.array(np.full(count, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def fitted(vectors: DataFrame, most: int = 32) -> tuple[Whitening | None, int]:
    """The whitening of ``vectors`` (embedding) and the vector length it is for."""
    source = vectors.select("embedding")
    spans = map_arrow(source, _bounds, FIT).groupBy("length", "dim").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")
    )
    # the commonest length; a row per dimension of it
    common = spans.filter("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if common is None:
        return None, 0
    length, n = common["length"], common["n"]
    dims = sorted(spans.filter(F.col("length") == length).collect(), key=lambda row: row["dim"])
    low, sums = [row["low"] for row in dims], [int(row["total"]) for row in dims]
    planes = Planes(low, [row["high"] for row in dims])
    counts = map_arrow(source, lambda x: _plane_counts(x, planes, length), COUNTS)
    products: dict[tuple[int, int], int] = {}
    for row in counts.groupBy("i", "j", "level").agg(F.sum("n").alias("n")).toLocalIterator():
        key = row["i"], row["j"]
        products[key] = products.get(key, 0) + (row["n"] << row["level"])
    return Whitening(n, low, sums, products, most), length


def identity_error(vectors: DataFrame, fit: Whitening, length: int) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, as measured."""
    sums = map_arrow(vectors.select("embedding"), lambda x: _moments(x, fit, length), MOMENTS)
    found = {(r["i"], r["j"]): r["s"] / fit.n for r in sums.groupBy("i", "j").agg(F.sum("total").alias("s")).collect()}
    return max(
        (abs(s - found[i, -1] * found[j, -1] - (i == j)) for (i, j), s in found.items() if j >= 0), default=0.0
    )


def whitened(vectors: DataFrame, most: int = 32) -> DataFrame:
    """``vectors`` (vec_id, embedding) whitened, a row per vector and component.

    Vectors that are null, empty or hold a null or non-finite entry are left out. Where
    lengths differ, those of the commonest length (of equals the longest) are taken and the
    others are left out. Every other entry c becomes x = floor(64 c) + 1,000,000; beyond
    2^52 it is held there. Over all n vectors left: ``deviation`` is the sum over dimensions
    of (n x - sum of x)^2, exact as a decimal, null from 10^38 on; ``whitened`` is the
    centred x projected on the component over its standard deviation; ``explained`` the
    component's share of the variance; ``identity_error`` as measured over the result.

    Components go by falling variance; equal variances in an order of their own. Directions
    without variance have no whitened value, so fewer components come out where vectors
    span fewer dimensions, and no rows at all where all vectors are equal or there are none.
    Repeated rows and ids count each time; a null vec_id stays null. Other columns are
    ignored.

    The vectors are read four times (spans, planes, measured error, result) and never
    shuffled; what tasks send is bounded by the dimensions alone.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fit, length = fitted(source, most)
    if fit is None or not len(fit.variances):
        return source.sparkSession.createDataFrame([], WHITE)
    error = identity_error(source, fit, length)
    return map_arrow(source, lambda x: _rows(x, fit, length, error), WHITE)
