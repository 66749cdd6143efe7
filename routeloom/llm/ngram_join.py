"""N-gram Jaccard join: sets of word shingles linked through prefix trees.

Every text becomes a set of hashed shingles in one global order, that of the hash. Texts
with the same set are one node. Nodes that may link are found without loss by the
pigeonhole principle: two sets of at most U shingles with a Jaccard index of t or more differ
in at most D = 2U(1-t)/(1+t) shingles. So of M slices of the hash range at least M - D hold
the same shingles in both, and with M about half as large again as D they agree on a third of
all slices. A set has a mark for each slice that is not empty, and marks are counted over
all nodes. A node that must agree in A marks with whatever it links with may pass over the
A - 1 of its marks that are most frequent: the rarest mark that two linked sets have in
common stays with both. Texts that only share a passage, or a phrase that is everywhere,
pass its marks over and do not meet.

Nodes that still share a mark form a candidate group. In a group, the sets lie in a
trie along an order from rare to common; each set walks the trie, shares the overlap it has
counted with everything below a branch, and leaves a branch when the lengths that remain
cannot reach the threshold, or when all below it is already connected with the set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby
from math import floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, matched, packed, pieces_of, remembers, runs, stored, unpacked
from .components import connected

# A candidate group with more members or shingles than this is dealt out in chunks.
GROUP_MEMBERS, GROUP_SHINGLES = 2_048, 500_000
# Shingles of one chunk of such a group, so that its comparisons fill many tasks.
CHUNK_SHINGLES = 50_000
# Shingles of a run in a trie that are looked at before the bound is tried again.
BRANCH_LENGTH = 12
# Sample members of a large group against which all its members are compared first.
HUBS = 8
BATCH_BYTES = 8_000_000
# Marks that one task counts, about, and the most tasks they are dealt to.
BUCKET_PAIRS, MAX_BUCKETS = 500_000, 10_000
# Ways of slicing that a set gets whose shingles leave too many slices empty.
MORE_SLICINGS = 6
# Shingles of the members that one task compares with the hubs of their group.
SLOT_SHINGLES = 1_000_000

DESCRIBED = (
    "chunk long, at int, doc_id long, key long, n_shingles long, node long, spare array<int>, "
    "counts binary, marks binary"
)
ASKED = "bucket long, chunk long, marks binary, places binary"
SHARED = "chunk long, marks binary, places binary, found binary"

_ODD1, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S31, _S29, _S32 = np.uint64(31), np.uint64(29), np.uint64(32)
_MARK = np.uint64((1 << 48) - 1)


def _mix(values):
    values = (values ^ (values >> _S31)) * _ODD1
    values = (values ^ (values >> _S29)) * _ODD2
    return values ^ (values >> _S32)


class _Words(dict):
    """64-bit numbers of words, remembered up to a bound."""

    BOUND = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_words = _Words()
remembers(_words.clear, __name__)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of all its words if they are few."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    numbers = np.array([_words[word] for word in words], np.uint64)
    span = min(width, len(numbers))
    parts = [numbers[at : len(numbers) - span + 1 + at] for at in range(span)]
    seed = np.full(len(parts[0]), span, np.uint64)
    return np.unique(reduce(lambda made, part: _mix(made + part), parts, seed))


def _node(values: np.ndarray) -> int:
    """A number for a whole set."""
    mixed = _mix(values)
    total, size = mixed.sum(keepdims=True), np.array([len(values)], np.uint64)
    parity = np.bitwise_xor.reduce(mixed, keepdims=True)
    return int(_mix(total + _mix(parity + size)).astype(np.int64)[0])


def slicing(level: int, percent: int) -> tuple[int, int]:
    """How many shingles linked sets of a size level may differ in, and into how many slices.

    Level 0 ends at one shingle, and each next one 100/percent times as high.
    """
    upper = (100 / percent) ** level * (1 + 1e-9)
    differ = floor(2 * upper * (100 - percent) / (100 + percent) + 1e-6)
    return differ, differ + 2 + -(-differ // 2)


def _sliced(values: np.ndarray, slices: int, label: int) -> np.ndarray:
    """Marks of the slices of a set that are not empty, under one way of slicing."""
    spread = values if not label & 0xFF else _mix(values + np.uint64(label & 0xFF))
    order = np.argsort(spread) if label & 0xFF else slice(None)
    place = ((spread[order] >> _S32) * np.uint64(slices)) >> _S32
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    sums = np.add.reduceat(_mix(values[order] + _ODD2), starts)
    return _mix(_mix(sums) + place[starts] * _ODD1 + np.uint64(label * 1_000_003)) & _MARK


def marks_of(values: np.ndarray, percent: int) -> tuple[list[np.ndarray], list[int]]:
    """A set's marks at its own size level and the next, and how many it may pass over at each.

    Linked sets differ in size by a factor of at most 100/percent, so their levels are the
    same or neighbours, and the larger one's level is common to both. Where fewer than one
    shingle may differ only equal sets link, and these are one node.

    The marks that two linked sets have in common are at least the slices less D, less the
    slices empty in either one. A set with so many empty slices that none may be left shows
    all its marks, and those of other slicings; what it links with is such a set, too, or
    has a mark in common with it anyway. After the last slicing such sets share one mark.
    """
    size, marks, spare = len(values), [], []
    own = 0
    while (100 / percent) ** own * (1 + 1e-9) < size:
        own += 1
    for level in (own, own + 1):
        differ, slices = slicing(level, percent)
        if not differ:
            marks.append(values[:0])
            spare.append(0)
            continue
        found = [_sliced(values, slices, level << 8)]
        common = len(found[0]) - differ
        spare.append(max(common - 1, 0))
        for way in range(1, MORE_SLICINGS + 1):
            if common > 0:
                break
            found.append(_sliced(values, slices, (level << 8) + way))
            common = len(found[-1]) - differ
        if common <= 0:
            found.append(_mix(np.array([level], np.uint64)) & _MARK)
        marks.append(np.concatenate(found))
    return marks, spare


def _describe(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of DESCRIBED: one per text, and one per chunk with the marks of its nodes, two levels each."""
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    names = ["chunk", "at", "doc_id", "key", "n_shingles", "node", "spare", "counts", "marks"]
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            chunk, size = (task << 32) + made, batch.num_rows
            made += 1
            places: dict[int, int] = {}
            sizes, nodes, heads, spares = [], [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, width)
                sizes.append(len(values))
                nodes.append(_node(values) if len(values) else None)
                if len(values) and nodes[-1] not in places:
                    places[nodes[-1]] = len(places)
                    marks, spare = marks_of(values, percent)
                    heads += marks
                    spares.append(spare)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, chunk)), pa.array([places.get(x) for x in nodes], pa.int32()),
                    batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([None if x is None else spares[places[x]] for x in nodes], pa.list_(pa.int32())),
                    pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()),
                ],
                names,
            )
            if heads:
                counts = packed(np.array([len(x) for x in heads], np.uint32))
                columns = [[chunk], *[[None]] * 6, [counts], [packed(np.concatenate(heads), rising=True)]]
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int32()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names)


def _asked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of ASKED: the marks of a chunk's own nodes, dealt by mark; a place is a node's level."""
    for batch in batches:
        columns = (batch.column(x).to_pylist() for x in ("chunk", "counts", "marks", "own"))
        for chunk, counts, values, own in zip(*columns):
            counts, values = unpacked(counts, np.uint32), unpacked(values, np.uint64, rising=True)
            places = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
            asked = np.zeros(len(counts), bool)
            asked[2 * np.array(own)] = asked[2 * np.array(own) + 1] = True
            values, places = values[asked[places]], places[asked[places]]
            bucket = ((_mix(values) >> _S32) % np.uint64(buckets)).astype(np.int64)
            if not len(values):
                continue
            order = np.lexsort((values, bucket))
            bucket, values, places = bucket[order], values[order], places[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            parts = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(bucket)])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[starts]), pa.array(np.full(len(parts), chunk)),
                    pa.array([packed(values[x], rising=True) for x in parts], pa.binary()),
                    pa.array([packed(places[x]) for x in parts], pa.binary()),
                ],
                ["bucket", "chunk", "marks", "places"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of SHARED: for each chunk of a bucket the marks that several nodes have."""
    names = ["bucket", "chunk", "marks", "places"]
    rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in names)) for batch in batches)
    for _, group in groupby(rows, key=lambda row: row[0]):
        parts = [
            (chunk, unpacked(a, np.uint64, rising=True), unpacked(b, np.uint32)) for _, chunk, a, b in group
        ]
        values = np.concatenate([x[1] for x in parts])
        places = np.concatenate([x[2] for x in parts])
        which = np.repeat(np.arange(len(parts)), [len(x[1]) for x in parts])
        order = np.argsort(values, kind="stable")
        values = values[order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        lengths = np.diff(np.r_[starts, len(values)])
        found = np.repeat(lengths, lengths)
        kept = found > 1
        values, order, found = values[kept], order[kept], found[kept].astype(np.uint64)
        by_chunk = np.argsort(which[order], kind="stable")
        values, order, found = values[by_chunk], order[by_chunk], found[by_chunk]
        borders = np.searchsorted(which[order], np.arange(len(parts) + 1))
        spans = [(at, slice(*borders[at : at + 2])) for at in range(len(parts)) if borders[at] < borders[at + 1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([parts[at][0] for at, _ in spans], pa.int64()),
                pa.array([packed(values[x], rising=True) for _, x in spans], pa.binary()),
                pa.array([packed(places[order[x]]) for _, x in spans], pa.binary()),
                pa.array([packed(found[x]) for _, x in spans], pa.binary()),
            ],
            ["chunk", "marks", "places", "found"],
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mark, node): what the nodes of each chunk do not pass over."""
    names = ["chunk", "own", "nodes", "spares", "marks", "places", "found"]
    rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in names)) for batch in batches)
    for _, group in groupby(rows, key=lambda row: row[0]):
        _, own, nodes, spares, *_ = next(group)
        parts = [
            (unpacked(a, np.uint64, rising=True), unpacked(b, np.uint32), unpacked(c, np.uint64))
            for *_, a, b, c in group
        ]
        if not parts:
            continue
        values, places, found = (np.concatenate(x) for x in zip(*parts))
        node, spare = np.zeros(max(own) + 1, np.int64), np.zeros((max(own) + 1, 2), np.int64)
        node[own], spare[own] = nodes, spares
        # per place from the most frequent on, equal ones by mark
        order = np.lexsort((values, np.iinfo(np.uint64).max - found, places))
        places, values = places[order], values[order]
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        lengths = np.diff(np.r_[starts, len(places)])
        rank = np.arange(len(places)) - np.repeat(starts, lengths)
        stays = rank >= np.repeat(spare.ravel()[places[starts]], lengths)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[stays].view(np.int64)), pa.array(node[places[stays] // 2])], ["mark", "node"]
        )


def _candidates(described: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes that keep a mark in common, each to the smallest such."""
    own = stored(
        nodes.groupBy(F.col("place.chunk").alias("chunk")).agg(
            F.collect_list("place.at").alias("own"), F.collect_list("node").alias("nodes"),
            F.collect_list("spare").alias("spares"),
        ),
        "chunk_nodes",
    )
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    expected = 6 * total * (100 - percent) // (100 + percent)
    width = int(described.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, max(width, -(-expected // BUCKET_PAIRS)))
    chunks = described.filter("marks IS NOT NULL").select("chunk", "counts", "marks")
    asked = map_arrow(
        matched(chunks, own.select("chunk", "own"), "chunk", "inner", nodes.count()).select("chunk", "counts", "marks", "own"),
        lambda batches: _asked(batches, buckets),
        ASKED,
    )
    # a bucket a task: by a hash several buckets would meet in one task and in its Arrow batch
    dealt = asked.repartitionById(buckets, F.col("bucket").cast("int"))
    shared = map_arrow(dealt.sortWithinPartitions("bucket"), _shared, SHARED)
    gathered = own.withColumn("order", F.lit(0)).unionByName(
        shared.withColumn("order", F.lit(1)), allowMissingColumns=True
    )
    kept = stored(
        map_arrow(
            gathered.repartition(buckets, "chunk").sortWithinPartitions("chunk", "order"),
            _kept,
            "mark long, node long",
        ),
        "kept_marks",
    )
    lowest = kept.groupBy("mark").agg(F.min("node").alias("lowest"), F.count(F.lit(1)).alias("n"))
    return kept.join(lowest.filter("n > 1").drop("n"), "mark").select(
        F.col("node").alias("a"), F.col("lowest").alias("b")
    )


class Trie:
    """A prefix tree over sets of ranks that are sorted by their bytes, as arrays by branch.

    A branch is a run of ranks common to the sets [low, high) of the list; branch 0 is the
    root, and the branches below one are neighbours. ``end`` ranks lead to a branch's end,
    ``last`` is the last of them (-1: none), ``shortest`` and ``longest`` are the sizes of
    the sets below it.
    """

    def __init__(self, sets: list[np.ndarray]):
        count = len(sets)
        sizes = np.array([len(x) for x in sets])
        shared = np.zeros(count, np.int64)
        for at in range(1, count):
            span = min(sizes[at - 1], sizes[at])
            unequal = sets[at - 1][:span] != sets[at][:span]
            shared[at] = np.argmax(unequal) if unequal.any() else span
        rows, runs_of = [(0, count)], [(0, 0)]
        ends, below = [], []
        for at, (low, high) in enumerate(rows):
            start = runs_of[at][0]
            common = int(sizes[low] if high - low == 1 else shared[low + 1 : high].min())
            end = min(common, start + BRANCH_LENGTH)
            ends.append(end)
            first = len(rows)
            if end < common:  # long runs are left as soon as the bound fails
                rows.append((low, high))
            elif high - low > 1:
                cuts = [low, *(low + 1 + np.flatnonzero(shared[low + 1 : high] == end)).tolist(), high]
                rows += zip(cuts, cuts[1:])
            below.append((first, len(rows) - first))
            runs_of += [(end, end)] * (len(rows) - first)
        self.low, self.high = np.array(rows).T
        self.end = np.array(ends)
        starts = np.array([start for start, _ in runs_of])
        self.first, self.below = np.array(below).T
        self.length = self.end - starts
        places = np.cumsum(np.r_[0, sizes])[self.low]
        self.start, self.ranks = places + starts, np.concatenate(sets)
        self.last = np.where(self.end > 0, self.ranks[places + np.maximum(self.end, 1) - 1], -1)
        bounds = np.stack([self.low, self.high], axis=1).ravel()
        padded = np.r_[sizes, sizes[-1:]]
        self.shortest = np.minimum.reduceat(padded, bounds)[::2]
        self.longest = np.maximum.reduceat(padded, bounds)[::2]

    def overlaps(self, branches: np.ndarray, held: np.ndarray) -> np.ndarray:
        """How many ranks of each branch's own run are marked in ``held``."""
        lengths = self.length[branches]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.start[branches] - ends + lengths, lengths)
        counts = np.r_[0, np.cumsum(held[self.ranks[at]], dtype=np.int64)]
        return counts[ends] - counts[ends - lengths]

    def under(self, branches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The branches right below, and how many each of ``branches`` has."""
        counts = self.below[branches]
        ends = np.cumsum(counts)
        return np.arange(ends[-1]) + np.repeat(self.first[branches] - ends + counts, counts), counts


def trie_links(
    sets: list[np.ndarray], percent: int, asking: list[bool], joined: list[bool]
) -> list[tuple[int, int]]:
    """Links that connect what is connected, as places in ``sets``.

    Only sets that are ``asking`` walk the trie; those ``joined`` count as connected from
    the start. A link is a Jaccard index of ``percent`` hundredths or more. Shingles are
    ordered from rare to common in the group, so that sets differ where they begin. A walk
    goes down one level of branches at a time, all branches of a level at once.
    """
    whole, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(whole), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(whole))
    ends = np.cumsum([len(x) for x in sets])[:-1]
    sets = [np.sort(x) for x in np.split(rank[inverse], ends)]
    order = sorted(range(len(sets)), key=lambda at: sets[at].tobytes())
    placed = [sets[at] for at in order]
    trie = Trie(placed)
    group = np.arange(len(order))
    together = np.array([joined[at] for at in order])
    if together.any():
        group[together] = group[together][0]
    silent = np.r_[0, np.cumsum([not asking[at] for at in order])]
    alone = silent[trie.low] == silent[trie.high]  # all sets below ask themselves
    held = np.zeros(len(whole), bool)
    links = []
    for place, at in enumerate(order):
        if not asking[at]:
            continue
        values = placed[place]
        size = len(values)
        held[values] = True
        same = np.r_[0, np.cumsum(group == group[place])]
        branches, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(branches):
            low, high = trie.low[branches], trie.high[branches]
            open_ = trie.longest[branches] * 100 >= percent * size
            open_ &= trie.shortest[branches] * percent <= 100 * size
            open_ &= ~(alone[branches] & (low > place))
            open_ &= same[high] - same[low] < high - low
            branches, overlap = branches[open_], overlap[open_]
            if not len(branches):
                break
            overlap = overlap + trie.overlaps(branches, held)
            rest = size - np.searchsorted(values, trie.last[branches], side="right")
            most = overlap + np.minimum(rest, trie.longest[branches] - trie.end[branches])
            open_ = (100 + percent) * most >= percent * (size + trie.shortest[branches])
            branches, overlap = branches[open_], overlap[open_]
            for found in trie.low[branches[trie.below[branches] == 0]].tolist():
                if group[found] != group[place]:
                    links.append((at, order[found]))
                    group[group == group[found]] = group[place]
            if len(branches):
                branches, counts = trie.under(branches)
                overlap = np.repeat(overlap, counts)
        held[values] = False
    return links


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The set of each node, once a task however often its text is there."""
    seen = set()
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            made, rows = [], []
            for row, (text, node) in enumerate(zip(batch.column("text").to_pylist(), batch.column("node").to_pylist())):
                if node in seen:
                    continue
                values = shingles(text, width)
                if len(values) and _node(values) == node:
                    seen.add(node)
                    made.append(values.tobytes())
                    rows.append(row)
            which = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("cluster").take(which), batch.column("node").take(which), pa.array(made, pa.binary())],
                ["cluster", "node", "shingles"],
            )


def _links(batches, keys: list[str], percent: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows (keys, node, shingles, asking, joined)."""
    for rows in runs(batches, keys):
        nodes = rows["node"].to_pylist()
        seen = {}
        for at, node in enumerate(nodes):
            if node not in seen or rows["asking"][at].as_py():
                seen[node] = at
        if len(seen) < 2:
            continue
        kept = list(seen.values())
        sets = [np.frombuffer(rows["shingles"][at].as_py(), np.uint64) for at in kept]
        flags = [[rows[name][at].as_py() for at in kept] for name in ("asking", "joined")]
        links = trie_links(sets, percent, *flags)
        yield pa.RecordBatch.from_arrays(
            [pa.array([nodes[kept[x[side]]] for x in links], pa.int64()) for side in (0, 1)],
            ["a", "b"],
        )


def _hub_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of members with the hubs of their group; a slot's hubs come before its members."""
    names = ["cluster", "slot", "member", "node", "shingles"]
    rows = chain.from_iterable(
        zip(*(part.column(x).to_pylist() for x in names))
        for batch in batches for part in pieces_of(batch, "shingles", BATCH_BYTES)
    )
    for (cluster, _), group in groupby(rows, key=lambda row: row[:2]):
        hubs, found = [], []
        for _, _, member, node, raw in group:
            values = np.frombuffer(raw, np.uint64)
            if not member:
                hubs.append((node, values))
                continue
            for hub, other in hubs:
                at = np.minimum(np.searchsorted(other, values), len(other) - 1)
                common = int(np.count_nonzero(other[at] == values))
                if (100 + percent) * common >= percent * (len(values) + len(other)):
                    found.append((cluster, node, hub))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[at] for row in found], pa.int64()) for at in range(3)],
            ["cluster", "node", "hub"],
        )


def _large_links(members: DataFrame, percent: int) -> DataFrame:
    """Links in groups too large for one task.

    Every member is compared with a few hubs. Members linked with the hub that has most
    links are connected already; only the others are compared with all members, chunk by
    chunk, and there everything linked with the hub counts as connected from the start.
    """
    chosen = members.groupBy("cluster", F.pmod(F.hash("node"), F.lit(HUBS)).alias("part")).agg(
        F.min("node").alias("node")
    )
    slots = members.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / SLOT_SHINGLES).cast("int").alias("slots")
    )
    placed = members.join(slots, "cluster")
    hubs = placed.join(chosen.select("cluster", "node"), ["cluster", "node"]).select(
        "cluster", F.explode(F.expr("sequence(0, slots - 1)")).alias("slot"),
        F.lit(0).alias("member"), "node", "shingles",
    )
    dealt = hubs.unionByName(
        placed.select(
            "cluster", F.pmod(F.hash("node"), F.col("slots")).alias("slot"), F.lit(1).alias("member"), "node", "shingles"
        )
    )
    links = stored(
        map_arrow(
            dealt.repartition("cluster", "slot").sortWithinPartitions("cluster", "slot", "member"),
            lambda batches: _hub_links(batches, percent),
            "cluster long, node long, hub long",
        ),
        "hub_links",
    )
    best = (
        links.groupBy("cluster", "hub").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cluster").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
    )
    near = links.join(best, ["cluster", "hub"]).select("node", F.lit(True).alias("joined"))
    marked = stored(
        members.join(near, "node", "left").withColumn("joined", F.coalesce("joined", F.lit(False))),
        "hub_members",
    )
    widths = marked.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).cast("int").alias("chunks"),
        F.ceil(F.sum(F.expr("if(joined, 0, n_shingles)")) / CHUNK_SHINGLES)
        .cast("int").alias("open_chunks"),
    ).filter("open_chunks > 0")
    spread = marked.join(widths, "cluster")
    chunk, open_chunk = F.pmod(F.hash("node"), F.col("chunks")), F.pmod(F.hash("node"), F.col("open_chunks"))
    every = F.explode(F.expr("sequence(0, open_chunks - 1)"))
    asked = F.explode(F.expr("sequence(0, chunks - 1)"))
    pairs = spread.select(
        "cluster", chunk.alias("i"), every.alias("j"), "node", "shingles", F.lit(False).alias("asking"), "joined"
    ).unionByName(
        spread.filter("NOT joined").select(
            "cluster", asked.alias("i"), open_chunk.alias("j"), "node", "shingles", F.lit(True).alias("asking"), "joined"
        )
    )
    keys = ["cluster", "i", "j"]
    rest = map_arrow(
        pairs.repartition(*keys).sortWithinPartitions(*keys),
        lambda batches: _links(batches, keys, percent),
        "a long, b long",
    )
    return rest.unionByName(links.select(F.col("node").alias("a"), F.col("hub").alias("b")))


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` (doc_id, text) with ``n_shingles`` and ``component_id`` per row.

    ``n_shingles`` is the size of the row's set of ``width``-word shingles (ASCII letters
    lowered, words parted by ASCII white space; with fewer words, all of them as one).
    Two rows link when their Jaccard index is ``percent`` hundredths or more, and
    ``component_id`` is the smallest doc_id a row reaches by links, its own included.

    Rows without words or with a null text have no shingle and link with nothing. Repeated
    rows link with each other, and different rows may have one doc_id. A null doc_id stays
    null when all rows it reaches have none. Other columns of ``docs`` are ignored. Sets are
    told apart by 64-bit hashes.
    """
    # a text is found again by this key; its set is checked then, so that keys may meet
    source = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    described = stored(
        map_arrow(source, lambda batches: _describe(batches, width, percent), DESCRIBED), "shingle_counts"
    )
    texts_of = described.filter("n_shingles IS NOT NULL").select("doc_id", "n_shingles", "node")
    nodes = stored(
        described.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("key").alias("key"), F.min("n_shingles").alias("n_shingles"),
            F.min("spare").alias("spare"), F.min(F.struct("chunk", "at")).alias("place"),
        ),
        "nodes",
    )
    clusters = connected(_candidates(described, nodes, percent)).withColumnRenamed("component", "cluster")
    members = stored(nodes.drop("place", "spare").join(clusters, "node"), "clusters")
    sizes = members.groupBy("cluster").agg(
        F.expr(f"count(1) > {GROUP_MEMBERS} OR sum(n_shingles) > {GROUP_SHINGLES}").alias("large")
    )
    texts = matched(source, members.select("key", "cluster", "node"), "key", "inner")
    sets = stored(
        map_arrow(
            texts.select("cluster", "node", "text"),
            lambda batches: _sets(batches, width),
            "cluster long, node long, shingles binary",
        )
        .join(sizes, "cluster")
        .withColumn("n_shingles", F.length("shingles") / 8),
        "shingle_sets",
    )
    alone = sets.filter("NOT large").select(
        "cluster", "node", "shingles", F.lit(True).alias("asking"), F.lit(False).alias("joined")
    )
    small = map_arrow(
        alone.repartition("cluster").sortWithinPartitions("cluster"),
        lambda batches: _links(batches, ["cluster"], percent),
        "a long, b long",
    )
    links = small
    if not sets.filter("large").isEmpty():
        links = links.unionByName(_large_links(sets.filter("large").drop("large"), percent))
    linked = connected(links)
    labelled = texts_of.join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    lowest = labelled.filter("component IS NOT NULL").groupBy("component").agg(
        F.min("doc_id").alias("lowest")
    )
    return labelled.join(lowest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("lowest", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the smallest doc_id stays.

    Documents without words stay, and so do those with a null doc_id. Of rows equal in all
    columns one stays; different rows under one doc_id stay or go together. All columns
    are kept.
    """
    found = jaccard_components(docs, width, percent)
    kept = stored(
        found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")),
        "kept_documents",
    )
    single = matched(docs, kept.filter("n = 1").select("doc_id"), "doc_id", "left_semi")
    repeated = matched(docs, kept.filter("n > 1").select("doc_id"), "doc_id", "left_semi")
    unnamed = docs.filter("doc_id IS NULL")
    return single.unionByName(repeated.dropDuplicates()).unionByName(unnamed).select(*docs.columns)
