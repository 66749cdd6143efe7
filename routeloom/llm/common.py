"""What the operators of this package share: stored steps, runs of a sorted stream, packed arrays."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

# Held-out rows are those whose CRC-32 of the identifier, written as text, leaves this
# remainder by four (fixed values).
HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again.

    Later steps depend on the written files alone, so a lost executor repeats nothing
    that lies before them.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def map_arrow(frame: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path.

    The folder the driver found the package in is added to the path of the workers, which
    serves local runs and shared installations; elsewhere the package comes by --py-files.
    A worker that goes on with another operator forgets what it remembered for the last.
    """
    environment = frame.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    owner = function.__module__

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        return function(batches)

    return frame.mapInArrow(owned, schema)


_forgetting: list[tuple[tuple[str, ...], Callable[[], None]]] = []


def remembers(forget: Callable[[], None], *owners: str) -> None:
    """Registers how a worker forgets what it remembers for the operators of some modules."""
    _forgetting.append((owners, forget))


_last_owner: list[str] = []


def claim(owner: str) -> None:
    """Forget what is remembered for others than the module whose operator runs now.

    When that changes, freed memory is given back, which allocators otherwise keep.
    """
    if _last_owner == [owner]:
        return
    for owners, forget in _forgetting:
        if owner not in owners:
            forget()
    if _last_owner:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not the GNU library
            pass
    _last_owner[:] = [owner]


def held_out(identifier: Column) -> Column:
    """Whether a row is held out of learning; rows without an identifier are not learnt from."""
    remainder = F.crc32(identifier.cast("string").cast("binary")) % HELD_OUT_DIVISOR
    return F.coalesce(remainder == HELD_OUT_REMAINDER, F.lit(True))


def pieces_of(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``limit`` bytes of text each."""
    texts = batch.column(column)
    start = size = 0
    for row, length in enumerate(pa.compute.binary_length(texts).to_pylist()):
        size += length or 0
        if size >= limit:
            yield batch.slice(start, row + 1 - start)
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, from a stream sorted by these keys.

    Only one run is held at a time, and small runs cost no more than a slice.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(key).to_pylist() for key in keys)))
        start = 0
        for row, value in enumerate(values):
            if value != current:
                if row > start:
                    held.append(batch.slice(start, row - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, current = [], row, value
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """An array as bytes that compress well: steps of rising values, equal bytes together."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def unpacked(data: bytes, kind: type, rising: bool = False) -> np.ndarray:
    apart = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(apart.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


# Rows of identifiers, about 32 bytes each, that may be sent to every executor: 32 MB.
BROADCAST_ROWS = 1_000_000


def matched(frame: DataFrame, keys: DataFrame, on: str, how: str, size: int | None = None) -> DataFrame:
    """``frame`` joined with a written table of a few narrow columns.

    The table is counted from its footers; where rows hold lists, ``size`` counts what is in
    them. Up to the bound it is broadcast, so that wide rows of the frame are not shuffled;
    beyond it both sides are shuffled on the key.
    """
    small = (keys.count() if size is None else size) <= BROADCAST_ROWS
    return frame.join(F.broadcast(keys) if small else keys.hint("shuffle_merge"), on, how)
