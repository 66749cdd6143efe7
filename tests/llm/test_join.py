"""How the n-gram join brings texts together: no link lost, and no group of strangers."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.llm import ngram_join
from routeloom.llm.components import connected


def kept_marks(sets, percent):
    """What each set keeps of its marks, level by level, spelled out."""
    marked = [ngram_join.marks_of(x, percent) for x in sets]
    found = Counter(m for marks, _ in marked for level in marks for m in set(level.tolist()))
    kept = []
    for marks, spares in marked:
        mine = set()
        for level, spare in zip(marks, spares):
            shared = sorted((m for m in set(level.tolist()) if found[m] > 1), key=lambda m: (-found[m], m))
            mine.update(shared[spare:])
        kept.append(mine)
    return kept


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_keep_a_mark_in_common(percent):
    rng = np.random.default_rng(percent)
    links = 0
    for _ in range(150):
        common = rng.integers(0, 1 << 62, 40)  # a passage that many sets hold
        sets = []
        for _ in range(int(rng.integers(2, 5))):
            base = np.r_[rng.integers(0, 1 << 62, int(rng.integers(1, 150))), common[: rng.integers(0, 41)]]
            for _ in range(int(rng.integers(1, 8))):
                values = base.copy()
                spots = rng.integers(0, len(base), int(rng.integers(0, max(2, len(base) // 8))))
                values[spots] = rng.integers(0, 1 << 62, len(spots))
                sets.append(np.unique(values[: rng.integers(max(1, 9 * len(values) // 10), len(values) + 1)]).astype(np.uint64))
        sets = [np.frombuffer(x, np.uint64) for x in {x.tobytes() for x in sets}]
        kept = kept_marks(sets, percent)
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links += 1
                    assert kept[a] & kept[b]
    assert links > 300


def groups(docs, width, percent):
    """Sizes of the candidate groups of different texts."""
    source = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    described = ngram_join.stored(
        ngram_join.map_arrow(source, lambda x: ngram_join._describe(x, width, percent), ngram_join.DESCRIBED), "described"
    )
    nodes = ngram_join.stored(
        described.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("n_shingles").alias("n_shingles"), F.min("spare").alias("spare"),
            F.min(F.struct("chunk", "at")).alias("place"),
        ),
        "nodes",
    )
    found = connected(ngram_join._candidates(described, nodes, percent))
    return sorted((row["n"] for row in found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_with_empty_slices_keep_a_mark_in_common(percent):
    """Small sets, and sets whose shingles lie close together, leave most slices empty."""
    rng = np.random.default_rng(percent)
    odd = 0
    for _ in range(400):
        size = int(rng.integers(4, 60))
        base = np.unique(rng.integers(0, 1 << int(rng.integers(20, 62)), size)).astype(np.uint64)
        other = np.r_[base[: len(base) - len(base) // 20], rng.integers(0, 1 << 62, len(base) // 20).astype(np.uint64)]
        pair = [base, np.unique(other), base[1:]]
        kept = kept_marks(pair, percent)
        odd += any(ngram_join.marks_of(x, percent)[1] == [0, 0] for x in pair)
        for a, b in ((0, 1), (0, 2)):
            both = len(np.intersect1d(pair[a], pair[b]))
            union = len(pair[a]) + len(pair[b]) - both
            if 100 * both >= percent * union and both < union:
                assert kept[a] & kept[b]
    assert odd > 50


@pytest.mark.parametrize("width, percent", [(5, 80), (3, 90)])
def test_strangers_do_not_meet(spark, monkeypatch, width, percent):
    """5,000 texts without a shingle in common, then the same with passages many of them share."""
    monkeypatch.setattr(ngram_join, "BATCH_BYTES", 500_000)
    rng = np.random.default_rng(1)
    passages = [" ".join(f"p{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(3)]
    alone, sharing = [], []
    for at in range(5_000):
        words = " ".join(f"{at}w{x}" for x in rng.integers(0, 10**6, int(rng.integers(100, 300))))
        alone.append((at, words))
        sharing.append((at, f"{words} {passages[at % 3]}" if at % 2 else words))
    schema = "doc_id long, text string"
    assert groups(spark.createDataFrame(alone, schema).repartition(8), width, percent) == []
    assert groups(spark.createDataFrame(sharing, schema).repartition(8), width, percent)[:1] in ([], [2], [3])


def test_ids_that_stand_twice_or_not_at_all(spark):
    words = [f"w{x}" for x in range(60)], [f"v{x}" for x in range(60)]
    a, b = map(" ".join, words)
    rows = [(1, a), (1, b), (2, f"{a} q"), (3, f"{b} q"), (5, "x " + " ".join(f"u{n}" for n in range(60))),
            (None, " ".join(f"u{n}" for n in range(60))), (None, "all alone"), (None, "all alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(ngram_join.jaccard_components(frame).select("doc_id", "component_id").collect(), key=str)
    assert [tuple(x) for x in found] == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 5), (None, 5), (None, None), (None, None)]
