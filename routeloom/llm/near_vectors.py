"""Embedding near-duplicates by sorted projection passes.

A pass orders the vectors of each label by a concatenation of random hyperplane bits, most
significant first, so that similar vectors tend to lie close; the label's mean is taken off before, since
bits that are equal for all order nothing. Every vector is compared with a bounded window of
neighbours in that order, and links that hold are united across passes. The order is a global
position cut into blocks of equal size with an overlap of one window, so neither a hot label
nor a partition border changes what is compared.

Passes are run in rounds, and how much they find is measured, not assumed. With the vectors of
a label go probes: partners of some of them at the threshold, turned towards another of the label.
A probe is found when it links with the component of the vector it was made from; it never
links others. Labels whose probes are found too seldom go through another round of other
hyperplanes, with more passes or a wider window, until they are. So tight groups inside a wide
label get what they need, and a label of one tight group, where chains unite all that links,
needs no more than any other.

Links inside a component found this way are then counted in full. In a component too large
for one task, vectors within half the threshold angle of its mean direction link with each
other by the triangle inequality; only pairs with a vector outside are computed, in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log1p, log2, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_position, write_ordered
from ..session import scratch_path
from .common import map_arrow, runs, stored
from .components import connected

PASSES, WINDOW, BLOCK, SEED = 16, 32, 2_048, 20_240_229
# Share of the pairs right at the threshold that passes are meant to find in a label spread
# evenly, and the most passes of one round.
RECALL, MOST_PASSES = 0.99, 64
# Labels up to this size are compared in full in one pass, which costs no more than the others.
FULL = PASSES * WINDOW
# Probes of a label, about one in 16 vectors up to some 256, the share of them to be found, and
# the widest window of a round that is not compared in full.
PROBE_SHARE, PROBES, MEASURED, MOST_WINDOW = 16, 256, 0.95, 1_024
# Bytes that a row of the passes' order takes in a sort.
ROW_BYTES = 64
# Members of a component that one task compares with each other.
GROUP_MEMBERS = 2_048


def usable(vector: list | None) -> bool:
    """Whether a vector takes part: present, complete, finite and not zero."""
    if not vector or None in vector:
        return False
    values = np.asarray(vector, np.float64)
    return bool(np.isfinite(values).all() and values.any())


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, vectors = [], []
        columns = (batch.column(name).to_pylist() for name in ("label", "embedding"))
        for label, vector in zip(*columns):
            if label is None or not usable(vector):
                nodes.append(None)
                vectors.append(None)
                continue
            values = np.asarray(vector, np.float64) + 0.0
            vectors.append(values.tobytes())
            # labels part the nodes; equal vectors under one label are one node
            nodes.append(xxhash.xxh3_64_intdigest(vectors[-1], seed=label % 2**64) - 2**63)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                pa.array(nodes, pa.int64()),
                batch.column("label"),
                pa.array(vectors, pa.binary()),
            ],
            ["vec_id", "node", "label", "vector"],
        )


def _units(raw: list[bytes]) -> np.ndarray:
    """Rows of unit length, scaled first so that no square over- or underflows."""
    values = np.stack([np.frombuffer(x, np.float64) for x in raw])
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def plan(count: int, shared: float, threshold: float, window: int = WINDOW) -> tuple[int, int]:
    """Passes and window that find a pair at the threshold with the chance ``RECALL``.

    ``count`` is the size of a label and ``shared`` the squared length of the mean of its unit
    vectors. Without the mean a pair of cosine c has about 1 - (1 - c) / (1 - shared), and one
    pass finds it if it agrees in the bits that part a label into windows. A window of the
    whole label, where one pass compares all, bounds the cost.
    """
    cosine = max(-1.0, 1 - (1 - threshold) / max(1 - shared, 1e-9))
    agree = 1 - acos(min(1.0, cosine)) / pi
    while count > window + 1:
        chance = agree ** log2(count / window)
        if chance >= RECALL:
            return PASSES, window
        passes = max(PASSES, ceil(log(1 - RECALL) / log1p(-chance))) if chance > 1e-12 else MOST_PASSES + 1
        if passes <= MOST_PASSES:
            return passes, window
        window *= 2
    return 1, window


def projection_keys(units: np.ndarray, seed: int, passes: int) -> np.ndarray:
    """For each row and pass, 64 hyperplane bits as a number that sorts like the bits."""
    rng = np.random.default_rng([seed, units.shape[1]])
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    keys = np.empty((len(units), passes), np.int64)
    for at in range(passes):
        bits = units @ rng.standard_normal((units.shape[1], 64)) > 0
        keys[:, at] = ((bits * weights).sum(axis=1, dtype=np.uint64) ^ np.uint64(1 << 63)).astype(np.int64)
    return keys


def partners(units: np.ndarray, mates: np.ndarray, threshold: float) -> np.ndarray:
    """For each unit vector one just above the threshold from it, towards its mate; NaN if that is no direction."""
    cosine = threshold + (1 - threshold) / 1_000
    away = mates - np.einsum("ij,ij->i", mates, units)[:, None] * units
    length = np.sqrt(np.einsum("ij,ij->i", away, away))
    away = away / np.where(length > 1e-6, length, np.nan)[:, None]
    return cosine * units + np.sqrt(1 - cosine**2) * away


def _turned(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, mates = batch.column("vector").to_pylist(), batch.column("mate").to_pylist()
        made = [partners(_units([x]), _units([y]), threshold)[0] for x, y in zip(raw, mates)]
        kept = pa.array([not np.isnan(x).any() for x in made], pa.bool_())
        yield batch.drop_columns(["vector", "mate"]).append_column(
            "vector", pa.array([x.tobytes() for x in made], pa.binary())
        ).filter(kept)


def _probes(sized: DataFrame, plans: DataFrame, threshold: float) -> DataFrame:
    """Probes of the labels that are not compared in full, under the nodes they are made from.

    A label's hash-chosen vectors, some ``PROBES`` to twice as many, are taken in order of another
    hash, and each is turned towards the next.
    """
    own = sized.join(plans.select("label", "size", "count"), ["label", "size"]).filter(
        f"size > 1 AND count > {FULL} AND pmod(xxhash64(node), greatest({PROBE_SHARE}, count DIV {PROBES})) = 0"
    )
    following = F.lead("vector").over(Window.partitionBy("label", "size").orderBy(F.hash("node"), "node"))
    paired = own.select("node", "label", "size", "vector", following.alias("mate")).filter("mate IS NOT NULL")
    return stored(
        map_arrow(
            paired, lambda batches: _turned(batches, threshold), "node long, label long, size long, vector binary"
        ),
        "probes",
    )


def _keys(batches, seed: int) -> Iterator[pa.RecordBatch]:
    """The keys of all passes of a round."""
    for batch in batches:
        raw, means = batch.column("vector").to_pylist(), batch.column("mean").to_pylist()
        names = ["node", "label", "size", "passes", "window"]
        nodes, labels, sizes, passes, windows = (np.asarray(batch.column(name)) for name in names)
        probes = np.asarray(batch.column("probe").to_pylist(), bool)
        for size, count in sorted(set(zip(sizes.tolist(), passes.tolist()))):
            rows = np.flatnonzero((sizes == size) & (passes == count))
            centred = _units([raw[at] for at in rows]) - np.array([means[at] for at in rows])
            keys = projection_keys(centred, seed, count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(count), len(rows))),
                    pa.array(np.repeat(labels[rows], count)),
                    pa.array(np.full(len(rows) * count, size)),
                    pa.array(keys.ravel()),
                    pa.array(np.repeat(nodes[rows], count)),
                    pa.array(np.repeat(probes[rows], count)),
                    pa.array(np.repeat(windows[rows], count)),
                ],
                ["pass", "label", "size", "key", "node", "probe", "window"],
            )


def _plans(batches, threshold: float, passes: int | None, window: int | None) -> Iterator[pa.RecordBatch]:
    """Passes and window of each label in the first round, where they are not given."""
    for batch in batches:
        planned = []
        for count, mean in zip(batch.column("count").to_pylist(), batch.column("mean").to_pylist()):
            if passes or window:
                planned.append((passes or plan(count, float(np.dot(mean, mean)), threshold, window)[0], window or WINDOW))
            elif count <= FULL:
                planned.append((1, count))
            else:
                own = plan(count, float(np.dot(mean, mean)), threshold)
                # where the estimate asks for a wider window, probes decide what is needed
                planned.append((own[0] if own[1] == WINDOW else PASSES, WINDOW))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in ("label", "size", "mean", "count")),
             pa.array([x[0] for x in planned], pa.int64()), pa.array([x[1] for x in planned], pa.int64())],
            ["label", "size", "mean", "count", "passes", "window"],
        )


def spanning(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place each of ``count`` places reaches by links."""
    lowest = np.arange(count)
    while True:
        before = lowest.copy()
        np.minimum.at(lowest, left, lowest[right])
        np.minimum.at(lowest, right, lowest[left])
        lowest = lowest[lowest]
        if (lowest == before).all():
            return lowest


def _window_links(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between vectors, and those of probes with what they meet, marked as such."""
    for rows in runs(batches, ["block"]):
        lanes = list(zip(*(rows[name].to_pylist() for name in ("pass", "label", "size"))))
        starts = [at for at in range(len(lanes)) if at == 0 or lanes[at] != lanes[at - 1]]
        nodes, windows = np.asarray(rows["node"]), np.asarray(rows["window"])
        probes = np.asarray(rows["probe"].to_pylist(), bool)
        raw = rows["vector"].to_pylist()
        ends = []
        for low, high in zip(starts, [*starts[1:], len(lanes)]):
            units, probe = _units(raw[low:high]), probes[low:high]
            if high - low <= windows[low] + 1:
                left, right = np.nonzero(np.triu(units @ units.T >= threshold, 1))
            else:
                left, right = [], []
                for step in range(1, windows[low] + 1):
                    near = np.einsum("ij,ij->i", units[:-step], units[step:]) >= threshold
                    left.append(np.flatnonzero(near))
                    right.append(left[-1] + step)
                left, right = np.concatenate(left), np.concatenate(right)
            real = ~(probe[left] | probe[right])
            root = spanning(high - low, left[real], right[real])
            moved = np.flatnonzero(root != np.arange(high - low))
            ends.append((nodes[low + moved], nodes[low + root[moved]], np.zeros(len(moved), bool)))
            mixed = probe[left] != probe[right]
            left, right = left[mixed], right[mixed]
            met = np.unique(
                np.stack([np.where(probe[left], left, right), root[np.where(probe[left], right, left)]]), axis=1
            )
            ends.append((nodes[low + met[0]], nodes[low + met[1]], np.ones(met.shape[1], bool)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([x[side] for x in ends])) for side in (0, 1, 2)], ["a", "b", "probe"]
        )


def _group_counts(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """For each node of a whole component, the rows of the other nodes it links with."""
    for rows in runs(batches, ["component"]):
        units, weights = _units(rows["vector"].to_pylist()), np.asarray(rows["weight"])
        near = units @ units.T >= threshold
        np.fill_diagonal(near, False)
        yield pa.RecordBatch.from_arrays(
            [rows["node"].combine_chunks(), pa.array(near @ weights)], ["node", "n"]
        )


def _chunk_counts(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """The same between the outer vectors of a component (asking) and a chunk of all."""
    for rows in runs(batches, ["component", "i", "j"]):
        units, weights = _units(rows["vector"].to_pylist()), np.asarray(rows["weight"])
        nodes, inner = np.asarray(rows["node"]), np.asarray(rows["inner"])
        asking = np.asarray(rows["asking"])
        near = (units[asking] @ units[~asking].T >= threshold) & (
            nodes[asking][:, None] != nodes[~asking][None, :]
        )
        own, other = near @ weights[~asking], weights[asking] @ near
        kept = inner[~asking]  # outer vectors are counted where they ask
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes[asking], nodes[~asking][kept]])),
                pa.array(np.concatenate([own, other[kept]])),
            ],
            ["node", "n"],
        )


def _angles(batches, limit: float) -> Iterator[pa.RecordBatch]:
    """Whether each vector lies so close to its component's mean that all such ones link."""
    for batch in batches:
        raw, means = batch.column("vector").to_pylist(), batch.column("mean").to_pylist()
        inner = []
        for vector, mean in zip(raw, means):
            mean = np.asarray(mean)
            length = np.sqrt(mean @ mean)
            inner.append(length > 1e-6 and (_units([vector])[0] @ mean) / length > limit)
        yield batch.drop_columns(["mean"]).append_column("inner", pa.array(inner, pa.bool_()))


def _unit_lists(batches, keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = [_units([x])[0].tolist() for x in batch.column("vector").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(key) for key in keys), pa.array(units, pa.list_(pa.float64()))],
            [*keys, "unit"],
        )


def _means(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """The mean of the unit vectors of each group, and how many they are."""
    fields = ", ".join(f"{key} long" for key in keys) + ", unit array<double>"
    return (
        map_arrow(vectors.select(*keys, "vector"), lambda batches: _unit_lists(batches, keys), fields)
        .groupBy(*keys)
        .agg(
            vector_to_array(Summarizer.mean(array_to_vector("unit"))).alias("mean"),
            F.count(F.lit(1)).alias("count"),
        )
    )


def _large_counts(members: DataFrame, threshold: float) -> DataFrame:
    means = _means(members, ["component"]).drop("count")
    fields = "component long, node long, weight long, vector binary"
    half = float(np.cos(acos(threshold) / 2 - 1e-6))
    placed = stored(
        map_arrow(
            members.select("component", "node", "weight", "vector").join(means, "component"),
            lambda batches: _angles(batches, half),
            fields + ", inner boolean",
        ),
        "placed_vectors",
    )
    sums = placed.groupBy("component").agg(
        F.sum(F.expr("if(inner, weight, 0)")).alias("inner_weight"),
        F.ceil(F.count(F.lit(1)) / GROUP_MEMBERS).cast("int").alias("chunks"),
        F.ceil(F.sum(F.expr("if(inner, 0, 1)")) / GROUP_MEMBERS).cast("int").alias("open_chunks"),
    )
    spread = placed.join(sums, "component")
    sure = spread.filter("inner").select("node", (F.col("inner_weight") - F.col("weight")).alias("n"))
    spread = spread.filter("open_chunks > 0")
    columns = ["node", "weight", "vector", "inner"]
    own = F.pmod(F.hash("node"), F.col("chunks"))
    own_open = F.pmod(F.hash("node"), F.col("open_chunks"))
    pairs = spread.select(
        "component", own.alias("i"), F.explode(F.expr("sequence(0, open_chunks - 1)")).alias("j"),
        *columns, F.lit(False).alias("asking"),
    ).unionByName(
        spread.filter("NOT inner").select(
            "component", F.explode(F.expr("sequence(0, chunks - 1)")).alias("i"), own_open.alias("j"),
            *columns, F.lit(True).alias("asking"),
        )
    )
    keys = ["component", "i", "j"]
    computed = map_arrow(
        pairs.repartition(*keys).sortWithinPartitions(*keys),
        lambda batches: _chunk_counts(batches, threshold),
        "node long, n long",
    )
    return sure.unionByName(computed)


def _round(rows: DataFrame, plans: DataFrame, threshold: float, seed: int) -> DataFrame:
    """What the passes of one round find over the labels of ``plans``; ``rows`` are vectors and probes."""
    spark = rows.sparkSession
    keys, window = plans.agg(F.sum(F.expr("count * passes")), F.max("window")).first()
    block_rows = max(BLOCK, window or WINDOW)
    keyed = map_arrow(
        rows.join(plans.drop("count"), ["label", "size"]),
        lambda batches: _keys(batches, seed),
        "pass long, label long, size long, key long, node long, probe boolean, window long",
    )
    path = scratch_path(spark, "projection_passes")
    order = ["pass", "label", "size", "key", "node", "probe"]
    write_ordered(keyed, order, path, stored_bytes=ROW_BYTES * (keys or 0))
    place = with_position(spark, path).withColumn("position", F.col("position") - 1)
    block, inside = F.floor(F.col("position") / block_rows), F.col("position") % block_rows
    blocks = F.when((inside < F.col("window")) & (block > 0), F.array(block - 1, block)).otherwise(F.array(block))
    compared = place.select("*", F.explode(blocks).alias("block")).join(
        rows.select("node", "probe", "vector"), ["node", "probe"]
    )
    return stored(
        map_arrow(
            compared.repartition("block").sortWithinPartitions("block", "position"),
            lambda batches: _window_links(batches, threshold),
            "a long, b long, probe boolean",
        ),
        "window_links",
    )


def _measured(probes: DataFrame, met: DataFrame, joined: DataFrame) -> DataFrame:
    """For each label with probes, how many it has and how many of them are found."""
    place = joined.select(F.col("node").alias("met"), F.col("component").alias("reached"))
    own = probes.select("label", "size", F.col("node").alias("a")).join(
        joined.select(F.col("node").alias("a"), "component"), "a", "left"
    ).select("label", "size", "a", F.coalesce("component", "a").alias("own"))
    reached = met.select("a", F.col("b").alias("met")).distinct().join(place, "met", "left").select(
        "a", F.coalesce("reached", "met").alias("own")
    )
    found = own.join(reached.distinct().withColumn("found", F.lit(1)), ["a", "own"], "left")
    return found.groupBy("label", "size").agg(
        F.count(F.lit(1)).alias("probes"), F.count("found").alias("found")
    )


def _passes(sized: DataFrame, plans: DataFrame, probes: DataFrame | None, threshold: float, seed: int) -> DataFrame:
    """Components of the links found in all rounds."""
    rows = sized.select("node", "label", "size", "vector", F.lit(False).alias("probe"))
    if probes is None:
        return connected(_round(rows, plans, threshold, seed))
    rows = rows.unionByName(probes.withColumn("probe", F.lit(True)))
    links = _round(rows, plans, threshold, seed)
    while True:
        joined = stored(connected(links.filter("NOT probe")), "components")
        rates = _measured(probes, links.filter("probe"), joined)
        lacking = rates.filter(F.col("found") < MEASURED * F.col("probes")).select("label", "size")
        plans = stored(
            plans.join(lacking, ["label", "size"])
            .withColumn("passes", F.expr(f"if(window < {MOST_WINDOW}, {PASSES}L, least({MOST_PASSES}L, 2 * passes))"))
            .withColumn("window", F.expr(f"least({MOST_WINDOW}L, 4 * window)")),
            "label_plans",
        )
        if plans.isEmpty():
            return joined
        seed += 1
        links = links.unionByName(_round(rows, plans, threshold, seed))


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    passes: int | None = None,
    window: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label).

    Rows with equal labels and a cosine of ``threshold`` or more, in double precision, link
    when a pass brings them, or a chain between them, into one window; ``n_links`` counts
    the links of a row inside its component, ``component_id`` is the smallest vec_id it
    reaches, its own included, and ``kept`` marks the row that bears it. No link below the
    threshold is made. Labels of up to ``FULL`` different vectors are compared in full. Others
    begin with the passes that find a pair at the threshold with the chance ``RECALL`` if the
    label is spread evenly, and go on until the share ``MEASURED`` of their probes is found.
    ``passes`` or ``window``, if given, hold for one round that is not measured.
    Labels may be of any type that Spark can hash.

    Rows with a null label, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing. Vectors of different length never link.
    Equal vectors of one label always do. Other columns are ignored.
    """
    described = stored(
        map_arrow(
            vectors.select("vec_id", F.expr("if(label IS NULL, NULL, xxhash64(label))").alias("label"), "embedding"),
            _describe,
            "vec_id long, node long, label long, vector binary",
        ),
        "described_vectors",
    )
    nodes = stored(
        described.filter("node IS NOT NULL").groupBy("node").agg(
            F.first("label").alias("label"), F.first("vector").alias("vector"),
            F.count(F.lit(1)).alias("weight"),
        ),
        "distinct_vectors",
    )
    sized = nodes.withColumn("size", (F.length("vector") / 8).cast("long"))
    plans = stored(
        map_arrow(
            _means(sized, ["label", "size"]), lambda batches: _plans(batches, threshold, passes, window),
            "label long, size long, mean array<double>, count long, passes long, window long",
        ),
        "label_plans",
    )
    probes = None
    if passes is None and window is None and threshold < 1 - 1e-9:
        probes = _probes(sized, plans, threshold)
        probes = None if probes.isEmpty() else probes
    joined = _passes(sized, plans, probes, threshold, seed)
    members = stored(nodes.join(joined, "node"), "vector_components")
    sizes = members.groupBy("component").agg((F.count(F.lit(1)) > GROUP_MEMBERS).alias("large"))
    sized = members.join(sizes, "component")
    small = sized.filter("NOT large").select("component", "node", "weight", "vector")
    counts = map_arrow(
        small.repartition("component").sortWithinPartitions("component"),
        lambda batches: _group_counts(batches, threshold),
        "node long, n long",
    )
    if not sizes.filter("large").isEmpty():
        counts = counts.unionByName(_large_counts(sized.filter("large"), threshold))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n"))
    found = nodes.select("node", "weight").join(members.select("node", "component"), "node", "left")
    found = found.join(counts, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    rows = described.select("vec_id", "node").join(found, "node", "left")
    lowest = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("lowest"))
    return rows.join(lowest, "component", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("lowest", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("lowest", "vec_id"), F.lit(True)).alias("kept"),
    )
