"""Exact top-k by inner product over a pivot-distance index.

Integer vectors are lifted by one coordinate, sqrt(M - |x|^2) with M the largest squared
length, so that a larger inner product is a smaller Euclidean distance and the triangle
inequality applies. Every vector is keyed by its nearest pivot and its distance from it;
the distances of a pivot are cut into annuli, sorted. A query first searches the annulus it
falls into itself. With its k-th best score from there it expands to the other annuli, of
all pivots, and stops at those whose bound, by the gap between its own distance from the
pivot and theirs, is below that score. All scores are integers, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, runs, stored

# The index is fitted on at most this many rows, the smallest hashes; every row is indexed.
PIVOTS, ANNULI, SAMPLE, SEED = 32, 8, 4_096, 7
# Rows of one annulus, and queries, that one task scores against each other.
PART_ROWS, PART_QUERIES = 4_096, 1_024
_EXACT = 2.0**53


def _whole(vector: list | None, scale: int) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    values = np.asarray(vector, np.float64)
    if not np.isfinite(values).all():
        return None
    return np.floor(values * scale)


def _integers(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_whole(x, scale) for x in batch.column("embedding").to_pylist()]
        rows = [at for at, x in enumerate(found) if x is not None]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id").take(pa.array(rows, pa.int64())),
                pa.array([found[at].tobytes() for at in rows], pa.binary()),
                pa.array([len(found[at]) for at in rows], pa.int32()),
                pa.array([float(found[at] @ found[at]) for at in rows], pa.float64()),
            ],
            ["vec_id", "vector", "size", "square"],
        )


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in raw])


class Index:
    """Pivots per vector length, and the annuli cut around them. Its size is fixed."""

    def __init__(self, sample: list[bytes], most: dict[int, float], pivots: int, annuli: int, seed: int):
        self.most, self.pivots, self.edges = most, {}, {}
        rng = np.random.default_rng(seed)
        for size in most:
            rows = [x for x in sample if len(x) == 8 * size]
            lifted = self.lift(_matrix(rows), size, False) if rows else np.zeros((1, size + 1))
            chosen = lifted[rng.choice(len(lifted), min(pivots, len(lifted)), replace=False)]
            self.pivots[size] = chosen
            near, distance = self.nearest(lifted, size)
            self.edges[size] = np.stack([
                np.quantile(distance[near == p], np.linspace(0, 1, annuli + 1)[1:-1])
                if (near == p).any() else np.full(annuli - 1, np.inf)
                for p in range(len(chosen))
            ]) if annuli > 1 else np.empty((len(chosen), 0))

    def lift(self, rows: np.ndarray, size: int, query: bool) -> np.ndarray:
        rest = self.most[size] - np.einsum("ij,ij->i", rows, rows)
        extra = np.zeros(len(rows)) if query else np.sqrt(np.maximum(rest, 0))
        return np.c_[rows, extra]

    def distances(self, lifted: np.ndarray, size: int) -> np.ndarray:
        pivots = self.pivots[size]
        squares = (lifted**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * lifted @ pivots.T
        return np.sqrt(np.maximum(squares, 0))

    def nearest(self, lifted: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        gaps = self.distances(lifted, size)
        near = gaps.argmin(1)
        return near, gaps[np.arange(len(near)), near]

    def cell(self, near: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
        annulus = (distance[:, None] > self.edges[size][near]).sum(1)
        return near * (self.edges[size].shape[1] + 1) + annulus


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    sizes = np.asarray(batch.column("size"))
    raw = batch.column("vector").to_pylist()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, _matrix([raw[at] for at in rows])


def _assign(batches, index) -> Iterator[pa.RecordBatch]:
    """The cell of each row, with its distance from the pivot."""
    for batch in batches:
        cells, far = np.empty(batch.num_rows, np.int32), np.empty(batch.num_rows)
        for size, rows, matrix in _by_size(batch):
            near, distance = index.value.nearest(index.value.lift(matrix, size, False), size)
            cells[rows], far[rows] = index.value.cell(near, distance, size), distance
        yield batch.append_column("cell", pa.array(cells)).append_column("far", pa.array(far))


def _expand(batches, index, reach: dict) -> Iterator[pa.RecordBatch]:
    """The cells a query must search: its own first, then those its best score leaves open.

    ``floor`` is null in the first round; a null bound in the second keeps every cell.
    """
    for batch in batches:
        queries, cells = [], []
        for size, rows, matrix in _by_size(batch):
            lifted = index.value.lift(matrix, size, True)
            gaps = index.value.distances(lifted, size)
            near = gaps.argmin(1)
            home = index.value.cell(near, gaps[np.arange(len(near)), near], size)
            if reach is None:
                queries.append(rows)
                cells.append(home)
                continue
            floors = batch.column("floor").to_pylist()
            known, width = reach.value[size], index.value.edges[size].shape[1] + 1
            squares = np.einsum("ij,ij->i", matrix, matrix) + index.value.most[size]
            for at, row in enumerate(rows):
                low, high = known[:, 1], known[:, 2]
                own = gaps[at][known[:, 0].astype(int) // width]
                slack = 1e-6 * (1 + own + high)
                gap = np.maximum(np.maximum(low - own, own - high) - slack, 0)
                bound = (squares[at] - gap**2) / 2
                floor = -np.inf if floors[row] is None else floors[row]
                open_cells = known[(bound >= floor - 1e-6 * (1 + abs(squares[at]))), 0].astype(np.int32)
                open_cells = open_cells[open_cells != home[at]]
                queries.append(np.full(len(open_cells), row))
                cells.append(open_cells)
        places = np.concatenate(queries) if queries else np.empty(0, np.int64)
        out = batch.select(["vec_id", "vector", "size"]).take(pa.array(places.astype(np.int64)))
        yield out.append_column("cell", pa.array(np.concatenate(cells) if cells else np.empty(0), pa.int32()))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while they hold every integer, else in Python's."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if most < _EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (left, right)]
    return whole[0] @ whole[1].T


def _best(batches, k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of each part of a cell for each query dealt to it."""
    for rows in runs(batches, ["size", "cell", "part", "ask"]):
        asking = np.asarray(rows["asking"])
        if asking.all() or not asking.any():
            continue
        raw, ids = rows["vector"].to_pylist(), np.asarray(rows["vec_id"])
        asked, stored_rows = np.flatnonzero(asking), np.flatnonzero(~asking)
        stored_rows = stored_rows[np.argsort(ids[stored_rows], kind="stable")]
        scores = _products(_matrix([raw[x] for x in asked]), _matrix([raw[x] for x in stored_rows]))
        found = []
        for at, row in enumerate(asked):
            kept = np.flatnonzero(ids[stored_rows] != ids[row])
            order = kept[np.argsort(-scores[at][kept], kind="stable")[:k]]
            found += [(int(ids[row]), int(ids[stored_rows[x]]), int(scores[at][x])) for x in order]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[at] for x in found], pa.int64()) for at in range(3)],
            ["query_id", "vec_id", "score"],
        )


def _search(indexed: DataFrame, cells: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each query in the cells it was dealt to."""
    parts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    asks = F.ceil(F.col("asks") / PART_QUERIES).cast("int")
    count = queries.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("asks"))
    widths = cells.join(count, ["size", "cell"]).select(
        "size", "cell", parts.alias("parts"), asks.alias("asks")
    )
    fields = ["vec_id", "vector"]
    data = indexed.join(F.broadcast(widths), ["size", "cell"]).select(
        "size", "cell", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"),
        F.explode(F.expr("sequence(0, asks - 1)")).alias("ask"), *fields, F.lit(False).alias("asking"),
    )
    asked = queries.join(F.broadcast(widths), ["size", "cell"]).select(
        "size", "cell", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
        F.pmod(F.xxhash64("vec_id"), "asks").cast("int").alias("ask"), *fields, F.lit(True).alias("asking"),
    )
    keys = ["size", "cell", "part", "ask"]
    return map_arrow(
        data.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys),
        lambda batches: _best(batches, k),
        "query_id long, vec_id long, score long",
    )


def top_inner_products(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    scale: int = 256,
    pivots: int = PIVOTS,
    annuli: int = ANNULI,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """The k largest inner products of each query with every other row of ``vectors``.

    ``vectors`` has vec_id and embedding; components become floor(scale * x). Queries are
    the rows for which the SQL expression ``is_query`` over vec_id holds. Result: query_id,
    rank (from 1), vec_id, score, ties to the smaller vec_id, fewer than k if there are
    fewer rows. Rows with vec_id null, and vectors that are null, empty or hold null or
    non-finite components, take no part; vectors of different length are not compared, and
    a row is not compared with rows of its own vec_id. Of rows repeating another vec_id
    with the same vector, one counts. Pivots and annuli are broadcast: their number is a
    parameter. They are fitted on ``sample`` rows, but all rows are indexed and searched.
    """
    spark = vectors.sparkSession
    rows = stored(
        map_arrow(
            vectors.filter("vec_id IS NOT NULL").select("vec_id", "embedding"),
            lambda batches: _integers(batches, scale),
            "vec_id long, vector binary, size int, square double",
        ).dropDuplicates(["vec_id", "vector"]),
        "integer_vectors",
    )
    lengths = rows.groupBy("size").agg(F.max("square").alias("most")).collect()
    fitted = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(sample).select("vector").collect()
    index = spark.sparkContext.broadcast(
        Index([x.vector for x in fitted], {x.size: x.most for x in lengths}, pivots, annuli, seed)
    )
    indexed = stored(
        map_arrow(
            rows.select("vec_id", "vector", "size"), lambda batches: _assign(batches, index),
            "vec_id long, vector binary, size int, cell int, far double",
        ),
        "indexed_vectors",
    )
    # one row per vector length and cell: as many as the parameters say
    cells = stored(
        indexed.groupBy("size", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high")
        ),
        "cells",
    )
    known: dict[int, list] = {x.size: [] for x in lengths}
    for x in cells.collect():
        known[x.size].append((x.cell, x.low, x.high))
    reach = spark.sparkContext.broadcast({s: np.array(x, float) for s, x in known.items()})
    queries = indexed.filter(is_query).select("vec_id", "vector", "size")
    fields = "vec_id long, vector binary, size int, cell int"
    first = stored(
        _search(
            indexed, cells, map_arrow(queries, lambda batches: _expand(batches, index, None), fields), k
        ),
        "own_annulus",
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = (
        first.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") == k)
        .select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    )
    wider = stored(
        map_arrow(
            queries.join(floors, "vec_id", "left"), lambda batches: _expand(batches, index, reach), fields
        ),
        "open_annuli",
    )
    found = first.unionByName(_search(indexed, cells, wider, k))
    return (
        found.dropDuplicates(["query_id", "vec_id", "score"])
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
