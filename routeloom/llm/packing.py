"""Packing of token sequences into windows by non-negative least squares.

Texts longer than a window fill windows of their own; what remains of each text is one
piece. The lengths of all pieces make a histogram of at most one count per length. Shallow
combinations of lengths that fill a window are enumerated, non-negative least squares finds
how often each should repeat so that together they use up the histogram, and the counts are
rounded down. Pieces take their places by their rank within their length; the rest of them
is packed greedily, in groups of bounded size, into the window with least room left.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_position, write_ordered
from ..session import scratch_path
from .common import map_arrow, pieces_of, stored
from .word_tokens import encoder

WINDOW, END_ID = 4_096, 2
# Most lengths in a combination, and steps of the least-squares solver.
DEPTH, STEPS = 6, 300
# Pieces left over that one task packs greedily.
REST_ROWS = 20_000
BATCH_BYTES = 2_000_000
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    tool, end = encoder(path, "ids"), np.array([end_id], "<u4").tobytes()
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            made, places, borders = tool.pieces(batch.column("text"))
            rows = []
            for at, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = b"".join([made[x] for x in places[borders[at] : borders[at + 1]].tolist()]) + end
                for low in range(0, len(ids), 4 * window):
                    part = ids[low : low + 4 * window]
                    rows.append((doc_id, low // 4, len(part) // 4, crc32(part), len(ids) // 4))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], _FIELDS)


def combinations(lengths: np.ndarray, window: int, depth: int) -> np.ndarray:
    """Rows of places in ``lengths`` (ascending), -1 where there is none, that fill a window.

    For every first length and depth, the room left is divided into parts that are even,
    falling or rising, each the nearest length below; the last is the largest that fits.
    """
    first = np.arange(len(lengths))
    made = [np.c_[first, np.full((len(first), depth - 1), -1)]]
    for count in range(2, depth + 1):
        for lean in (0.0, -0.35, 0.35):
            rows = np.full((len(first), depth), -1)
            rows[:, 0] = first
            room = window - lengths
            for slot in range(1, count):
                share = 1.0 if slot == count - 1 else (1 + lean) / (count - slot)
                at = np.searchsorted(lengths, np.floor(room * share), side="right") - 1
                rows[:, slot] = at
                room = room - np.where(at >= 0, lengths[at], 0)
            made.append(np.sort(rows, axis=1)[:, ::-1])
    return np.unique(np.concatenate(made), axis=0)


def repeats(counts: np.ndarray, lengths: np.ndarray, combos: np.ndarray, window: int, steps: int) -> np.ndarray:
    """How often each combination repeats: least squares without negatives, rounded down.

    Accelerated projected gradient on the histogram weighted by length, with a price on the
    room a combination leaves; the matrix is never built, as each column has few entries.
    """
    used = combos >= 0
    flat, owner = combos[used], np.nonzero(used)[0]
    weight = lengths / window
    room = 1 - np.bincount(owner, lengths[flat], len(combos)) / window
    price = 0.05 * counts.mean() * room

    def gradient(x):
        gap = (np.bincount(flat, x[owner], len(counts)) - counts) * weight**2
        return np.bincount(owner, gap[flat], len(combos)) + price

    norm = np.ones(len(combos))
    for _ in range(15):  # the largest curvature, by the power method
        norm = np.bincount(owner, (np.bincount(flat, norm[owner], len(counts)) * weight**2)[flat], len(combos))
        top = np.linalg.norm(norm)
        norm /= max(top, 1e-30)
    x = ahead = np.zeros(len(combos))
    pace = 1.0
    for _ in range(steps):
        after = np.maximum(ahead - gradient(ahead) / max(top, 1e-30), 0)
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead, x, pace = after + (pace - 1) / faster * (after - x), after, faster
    # fullest combinations first; none may use more pieces than there are
    free, out = counts.copy(), np.zeros(len(combos), np.int64)
    for at in np.lexsort((np.arange(len(combos)), room)):
        wanted = int(x[at] + 1e-9)
        if wanted:
            parts, times = np.unique(combos[at][combos[at] >= 0], return_counts=True)
            out[at] = wanted = min(wanted, int((free[parts] // times).min()))
            free[parts] -= wanted * times
    return out


def plan_windows(histogram: dict[int, int], window: int, depth: int, steps: int) -> tuple[dict, int]:
    """For each length, (ranks up to, first rank, first sequence, offset) in order; sequences used."""
    plan: dict[int, list] = {length: [] for length in histogram}
    taken = dict.fromkeys(histogram, 0)
    used = histogram.get(window, 0)
    if used:
        plan[window].append((used, 0, 0, 0))
        taken[window] = used
    lengths = np.array(sorted(x for x in histogram if x < window), np.int64)
    if not len(lengths):
        return plan, used
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    combos = combinations(lengths, window, depth)
    times = repeats(counts, lengths, combos, window, steps)
    for at in np.flatnonzero(times):
        offset, many = 0, int(times[at])
        for slot in combos[at][combos[at] >= 0]:
            length = int(lengths[slot])
            low = taken[length]
            taken[length] = low + many
            plan[length].append((low + many, low, used, offset))
            offset += length
        used += many
    return plan, used


def _place(batches, plan, before) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of pieces that the plan places; null for the rest."""
    for batch in batches:
        length = np.asarray(batch.column("length"))
        position = np.asarray(batch.column("position"))
        sequence, offset = np.full(len(length), -1), np.zeros(len(length), np.int64)
        for size in np.unique(length):
            rows = np.flatnonzero(length == size)
            steps = np.array(plan.value[int(size)], np.int64).reshape(-1, 4)
            rank = position[rows] - before.value[int(size)]
            at = np.searchsorted(steps[:, 0], rank, side="right")
            known = at < len(steps)
            chosen = steps[at[known]]
            sequence[rows[known]] = chosen[:, 2] + rank[known] - chosen[:, 1]
            offset[rows[known]] = chosen[:, 3]
        none = sequence < 0
        yield pa.RecordBatch.from_arrays(
            [batch.column(name) for name in _FIELDS]
            + [pa.array(sequence, pa.int64(), mask=none), pa.array(offset, pa.int64(), mask=none)],
            [*_FIELDS, "sequence_id", "offset"],
        )


def best_fit(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece: longest first, into the open bin with least room for it."""
    rooms: dict[int, list[int]] = {}
    mask, bins, out = 0, 0, [(0, 0)] * len(lengths)
    for at in sorted(range(len(lengths)), key=lambda x: (-lengths[x], x)):
        size = lengths[at]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, chosen = window, bins
            bins += 1
        out[at] = (chosen, window - room)
        if room > size:
            rooms.setdefault(room - size, []).append(chosen)
            mask |= 1 << (room - size)
    return out


def _pack_rest(table: pa.Table, window: int, first: int, groups: int) -> pa.Table:
    table = table.sort_by([(name, "ascending") for name in ("length", "doc_id", "start", "ids_crc32")])
    placed = best_fit(table["length"].to_pylist(), window)
    group = table["group"][0].as_py()
    sequence = pa.array([first + x * groups + group for x, _ in placed], pa.int64())
    offset = pa.array([x for _, x in placed], pa.int64())
    return table.select(_FIELDS).append_column("sequence_id", sequence).append_column("offset", offset)


def packed(
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    depth: int = DEPTH,
    steps: int = STEPS,
) -> DataFrame:
    """Pieces of the tokens of ``docs`` (doc_id, text) and their places in sequences.

    A document is its ids, by the library for the tokenizer file ``path`` without added
    special tokens, then ``end_id``; a null or empty text is that id alone. One row per
    piece: doc_id, start, length, ids_crc32 (of little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset. A sequence holds at most ``window`` tokens without
    gaps between pieces. Repeated rows are packed each; a null doc_id stays null; other
    columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token_pieces")
    pieces = map_arrow(
        docs.select("doc_id", "text"), lambda batches: _pieces(batches, path, window, end_id), _SCHEMA
    )
    unordered = stored(pieces, "unordered_pieces")
    write_ordered(unordered, ["length", "doc_id", "start", "ids_crc32"], folder)
    place = with_position(spark, folder).withColumn("position", F.col("position") - 1)
    # one row per length: as many as a window has tokens
    histogram = {x.length: x.n for x in unordered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    plan, used = plan_windows(histogram, window, depth, steps)
    shared = spark.sparkContext.broadcast(plan), spark.sparkContext.broadcast(before)
    fields = _SCHEMA + ", sequence_id long, offset long"
    placed = stored(map_arrow(place, lambda batches: _place(batches, *shared), fields), "placed_pieces")
    left = sum(histogram[x] - (plan[x][-1][0] if plan[x] else 0) for x in histogram)
    groups = max(1, -(-left // REST_ROWS))
    rest = (
        placed.filter("sequence_id IS NULL").select(
            *_FIELDS,
            F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.rand(11)), F.lit(groups)).alias("group")
            if groups > 1 else F.lit(0).cast("long").alias("group"),
        )
    )
    packed_rest = rest.groupBy("group").applyInArrow(
        lambda table: _pack_rest(table, window, used, groups), fields
    )
    return placed.filter("sequence_id IS NOT NULL").unionByName(packed_rest)
