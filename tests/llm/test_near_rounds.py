"""Rounds of sorted passes: probes measure what is found, labels go on until it is enough."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.llm import near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def grouped(count, groups, inner, pairs, cosine=0.935, seed=5):
    """Unit vectors in groups of this inner cosine, each of the first with a partner."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    noise = rng.standard_normal((count, 64))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    unit = np.sqrt(inner) * centres[rng.integers(groups, size=count)] + np.sqrt(1 - inner) * noise
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    own, apart = unit[:pairs], rng.standard_normal((pairs, 64))
    apart -= (apart * own).sum(axis=1)[:, None] * own
    apart /= np.linalg.norm(apart, axis=1)[:, None]
    unit[pairs : 2 * pairs] = cosine * own + np.sqrt(1 - cosine**2) * apart
    return unit


def links(unit, threshold=0.93):
    near = np.triu(unit @ unit.T >= threshold, 1)
    return np.nonzero(near)


def frame(spark, unit, label=1):
    return spark.createDataFrame([(at, x.tolist(), label) for at, x in enumerate(unit)], SCHEMA).repartition(8)


def test_probes_stand_at_the_threshold():
    unit = grouped(300, 3, 0.5, 0)
    turned = near_vectors.partners(unit, np.roll(unit, 1, axis=0), 0.93)
    cosine = (turned * unit).sum(axis=1)
    assert (cosine >= 0.93).all() and (cosine < 0.9302).all()
    assert np.allclose(np.linalg.norm(turned, axis=1), 1)
    assert np.isnan(near_vectors.partners(unit[:1], -unit[:1], 0.93)).all()


def test_rounds_go_on_until_probes_are_found(spark, monkeypatch):
    unit = grouped(4_000, 4, 0.85, 400)
    left, right = links(unit)
    table = frame(spark, unit)
    monkeypatch.setattr(near_vectors, "MEASURED", 0.995)
    rounds = []
    inner = near_vectors._round
    monkeypatch.setattr(near_vectors, "_round", lambda *given: rounds.append(1) or inner(*given))
    alone = {x.vec_id: x.component_id for x in near_vectors.near_duplicates(table, passes=2, window=4).collect()}
    assert len(rounds) == 1
    found = {x.vec_id: x.component_id for x in near_vectors.near_duplicates(table).collect()}
    assert len(rounds) > 2  # one of the first call, at least two of the second
    together = [np.mean([own[a] == own[b] for a, b in zip(left, right)]) for own in (alone, found)]
    assert together[0] < 0.9 and together[1] >= 0.99
    # components hold true links only: probes join nothing
    lowest = near_vectors.spanning(len(unit), left, right)
    assert all(lowest[at] == lowest[found[at]] for at in found)


def test_a_tight_label_needs_one_round(spark, monkeypatch):
    rng = np.random.default_rng(2)
    unit = 5.7 * np.eye(64)[0] + rng.standard_normal((3_000, 64)) / 8
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert 0.96 < (unit.mean(axis=0) ** 2).sum() < 0.98
    windows = []
    inner = near_vectors._round
    monkeypatch.setattr(
        near_vectors, "_round",
        lambda sized, plans, *more: windows.append(plans.agg(F.max("window")).first()[0]) or inner(sized, plans, *more),
    )
    found = {x.vec_id: x for x in near_vectors.near_duplicates(frame(spark, unit)).collect()}
    assert windows == [near_vectors.WINDOW]
    near = unit @ unit.T >= 0.93
    assert [found[at].n_links for at in range(3_000)] == (near.sum(axis=1) - 1).tolist()


@pytest.mark.parametrize("kind", ["string", "double"])
def test_labels_of_other_types(spark, kind):
    unit = grouped(60, 2, 0.9, 20)
    rows = [(at, x.tolist(), at % 2) for at, x in enumerate(unit)]
    table = spark.createDataFrame(rows, SCHEMA)
    plain = near_vectors.near_duplicates(table).collect()
    other = near_vectors.near_duplicates(table.withColumn("label", F.col("label").cast(kind))).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, other))
