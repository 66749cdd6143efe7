"""Language-model scores, ranked search and whitening against brute force, and on odd input."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from routeloom.llm import partial_match, ranked_search, whitening

TEXTS = [
    None, "", "   ", "a", "The cat  sat\ton the mat", "the cat sat on the mat", "the dog sat on the log.",
    "日本 x é é ÉÉ", "banana banana bananas", "a" * 300, "mat " * 400, "zz\x00q", "The cat  sat\ton the mat",
]
SCHEMA = "doc_id long, text string, n_bytes string, chunk long, bucket double, block int, query string, term string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(at, text, "n", 1, 0.5, 3, "q", "t") for at, text in enumerate(TEXTS)]
    odd = [rows[5], (None, "the cat without a name", None, None, None, None, None, None), (7, "another cat", *[None] * 6)]
    return spark.createDataFrame([*rows, *odd], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


class BruteModel:
    """Prediction by partial matching, method D with exclusion, byte by byte over dictionaries."""

    def __init__(self, bodies, order):
        self.order, self.seen = order, defaultdict(Counter)
        for body in bodies:
            for at in range(order, len(body)):
                for depth in range(order + 1):
                    self.seen[body[at - depth : at]][body[at]] += 1

    def share(self, context, byte):
        excluded, share = set(), 1.0
        for depth in range(self.order, -1, -1):
            found = self.seen.get(context[len(context) - depth :], Counter())
            left = {b: n for b, n in found.items() if b not in excluded}
            total = sum(left.values())
            if byte in left:
                return share * (2 * left[byte] - 1) / (2 * total)
            if left:
                share *= len(left) / (2 * total)
            excluded |= set(found)
        return share / (255 - len(excluded))

    def log(self, body):
        return sum(math.log10(self.share(body[at - self.order : at], body[at])) for at in range(self.order, len(body)))


def body_of(text):
    order = partial_match.ORDER
    return bytes([0xFF]) * order + b" ".join((text or "").encode().lower().split()) + bytes([0xFE])


def test_brute_model_adds_up():
    model = BruteModel([body_of(x) for x in TEXTS], partial_match.ORDER)
    for context in (b"he ca", b"\xff" * 5, b"nothi", b"aaaaa", b"  mat"):
        assert sum(model.share(context, byte) for byte in range(255)) == pytest.approx(1)


@pytest.mark.parametrize("limit", [12_000_000, 40])
def test_partial_match_equals_brute_force(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(partial_match, "CHUNK_BYTES", limit)
    rows = docs.select("doc_id", "text").collect()
    learnt = [x.text for x in rows if not held_out(x.doc_id)]
    model = BruteModel([body_of(x) for x in learnt], partial_match.ORDER)
    words = Counter(w for x in learnt for w in [*(x or "").encode().lower().split(), None])
    total = sum(words.values())
    expected = []
    for row in rows:
        own = [*(row.text or "").encode().lower().split(), None]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in own)
        expected.append(
            (str(row.doc_id), held_out(row.doc_id), len(own), sum(w in words for w in own), total,
             round(base, 6), round(model.log(body_of(row.text)), 3))
        )
    found = [
        (str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 3))
        for x in partial_match.scores(docs).collect()
    ]
    assert sorted(found) == sorted(expected)


def test_partial_match_slices_agree(monkeypatch):
    body = b"".join(body_of(x) for x in TEXTS)
    whole = partial_match._run_counts(body, len(body) // 2), partial_match._word_counts(body, len(body))
    monkeypatch.setattr(partial_match, "SLICE_BYTES", 17)
    cut = partial_match._run_counts(body, len(body) // 2), partial_match._word_counts(body, len(body))
    assert all((a == b).all() for a, b in zip(whole[0], cut[0]))
    assert dict(zip(*whole[1])) == dict(zip(*cut[1]))


def test_partial_match_prefers_what_it_learnt(spark):
    rows = [(at, "the quick brown fox jumps over the lazy dog " * 3) for at in range(40)]
    rows += [(100, "the quick brown fox"), (101, "xqz wvk bjq hhz ppt")]
    found = {x.doc_id: x for x in partial_match.scores(spark.createDataFrame(rows, "doc_id long, text string"), 1000, 999).collect()}
    assert found[100].score > found[101].score + 5
    assert found[100].score > found[100].base_score


def test_partial_match_without_texts(spark, none):
    found = partial_match.scores(none)
    assert found.collect() == [] and found.columns[-1] == "n_bytes"
    out = next(x for x in range(100) if held_out(x))
    alone = partial_match.scores(spark.createDataFrame([(out, "ab")], "doc_id long, text string")).collect()[0]
    assert alone.train_tokens == 0 and alone.score == pytest.approx(-3 * math.log10(255), abs=1e-6)


def brute_search(rows, items, k):
    def terms(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)

    counted = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    n = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    answers = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        answers += [(item_id, at + 1, x[2], -x[0]) for at, x in enumerate(sorted(scored)[:k])]
    return answers


ITEMS = [(1, "The CAT sat"), (2, "banana é 日本"), (3, None), (4, "..."), (5, "unheard of"), (None, "mat on the log"), (1, "The CAT sat")]


@pytest.mark.parametrize("k, block", [(50, 8_000_000), (2, 30), (1, 60)])
def test_search_equals_brute_force(spark, docs, monkeypatch, k, block):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "GROUP_TERMS", 500_000 if k == 50 else 4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = [tuple(x) for x in ranked_search.search(docs, items, k).collect()]
    expected = brute_search([(x.doc_id, x.text) for x in docs.collect()], ITEMS, k)
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_search_without_rows(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(docs, items.limit(0)).collect() == []


def test_accumulators_are_limited_and_exact():
    """Random postings: the best k are exact, and common terms make no accumulators."""
    random = np.random.default_rng(5)
    for size, k in ((400, 5), (400, 50), (30, 50)):
        postings, whole = [], np.zeros(size, np.int64)
        for share, weight in ((0.05, 9000), (0.1, 4000), (0.5, 300), (1.0, 10)):
            places = np.flatnonzero(random.random(size) < share)
            gains = weight * random.integers(1, 10, len(places))
            if len(places):
                postings.append((places, gains))
                whole[places] += gains
        places, scores = ranked_search.accumulate(postings, size, 1, k)
        assert (scores == whole[places]).all()
        kth = np.sort(whole[whole > 0])[::-1][:k][-1]
        assert set(np.flatnonzero(whole >= max(kth, 1)).tolist()) <= set(places.tolist())
        if (size, k) == (400, 5):
            assert len(places) < 60  # of 400 documents that hold some term


def brute_whitening(vectors, most):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    deviation = [int(s) for s in (away * away).sum(axis=1)]
    centred = (x - sums / n).astype(float)
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return n, deviation, centred @ axes / np.sqrt(values), values / np.trace(covariance)


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_whitening_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(whitening, "PLANE_ROWS", 64)
    random = np.random.default_rng(3)
    vectors = (random.standard_normal((150, 6)) @ random.standard_normal((6, 6)) * scale).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    rows = [(at, v, 0) for at, v in enumerate([*vectors, *bad])] + [(0, vectors[0], 1), (None, vectors[1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").repartition(5)
    used = [*vectors, vectors[0], vectors[1]]
    n, deviation, white, explained = brute_whitening(used, 4)
    found = whitening.whitened(frame, 4).toPandas()
    assert len(found) == 4 * len(used) and set(found.n) == {n}
    assert found.identity_error.max() < 1e-9
    for at in (0, 1, 2, 77, 149):
        own = found[found.vec_id == at].sort_values("component")[:4]
        if at:  # the id 0 stands twice
            assert own.component.tolist() == [1, 2, 3, 4]
            assert np.abs(own.whitened.to_numpy()) == pytest.approx(np.abs(white[at]), abs=1e-6)
            assert own.explained.to_numpy() == pytest.approx(explained, rel=1e-6)
        assert set(map(int, own.deviation)) == {deviation[at]}


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    empty = whitening.whitened(spark.createDataFrame([], schema))
    assert empty.collect() == [] and "deviation" in empty.columns
    assert whitening.whitened(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect() == []
    line = [(at, [at / 10, 1.0, at / 5]) for at in range(10)]  # two dimensions in one, one fixed
    found = whitening.whitened(spark.createDataFrame(line, schema)).toPandas()
    assert found.identity_error.max() < 1e-9 and found.explained.max() == pytest.approx(1, abs=1e-3)
    huge = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])], schema)
    assert whitening.whitened(huge).filter("component = 1").count() == 3
