"""Toxicity by compression distance between two zstandard dictionaries.

One dictionary is trained on toxic text, one on ordinary text. Each is put before the same
base of common text, itself trained on ordinary text, so that both compress everyday words
alike and differ only by what is typical of one class; the base lies nearest the window and
wins ties. A text is cut into windows of words, and each window is compressed with both. A
text's gaps in length, ordinary minus toxic, are summed up in a few figures whose weights
are calibrated on labelled texts that no dictionary has seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow, pieces_of

# Labelled texts of each class learnt from, about: those of smallest hash.
LEARN_TOXIC, LEARN_ORDINARY = 1_500, 4_000
# Of these, the share that trains dictionaries; the others calibrate.
TRAIN_SHARE = 0.6
CLASS_BYTES, BASE_BYTES = 2_048, 100_000
WINDOW_WORDS, SAMPLE_WORDS = 24, 16
# A word is typical of toxic text if so many times as frequent there and so far from chance.
TYPICAL_RATE, TYPICAL_GAIN = 10.0, 12.0
BATCH_BYTES = 8_000_000
THRESHOLD = 0.3
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[bytes]:
    return [x.encode() for x in _WORDS.findall((text or "").lower())]


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    """Consecutive windows of words; one blank window for a text without words."""
    return [b" " + b" ".join(words[at : at + size]) + b" " for at in range(0, len(words), size)] or [b"  "]


def _gain(toxic: int, ordinary: int, toxic_texts: int, ordinary_texts: int) -> float:
    """Twice the log-likelihood gained by a rate of its own in each class."""
    both = toxic + ordinary
    share = toxic_texts / (toxic_texts + ordinary_texts)
    gain = toxic * log(toxic / (both * share))
    return 2 * (gain + (ordinary * log(ordinary / (both * (1 - share))) if ordinary else 0))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained dictionary bytes; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The raw content of the toxic and the ordinary dictionary, equally long."""
    # every word counts once in a text, and repeated texts once
    texts = [[list(dict.fromkeys(words_of(x))) for x in sorted(set(part))] for part in (toxic, ordinary)]
    seen = [Counter(word for words in part for word in words) for part in texts]
    sizes = [max(1, len(part)) for part in texts]
    typical = {
        word for word, n in seen[0].items()
        if n / sizes[0] > TYPICAL_RATE * seen[1][word] / sizes[1]
        and _gain(n, seen[1][word], *sizes) > TYPICAL_GAIN
    }
    marked = [y for x in texts[0] if (kept := [w for w in x if w in typical]) for y in windows_of(kept, SAMPLE_WORDS)]
    plain = [y for x in texts[1] for y in windows_of(x, SAMPLE_WORDS)]
    base = _dictionary(plain, BASE_BYTES)
    own, other = _dictionary(marked, CLASS_BYTES), _dictionary(plain, CLASS_BYTES)
    size = max(len(own), len(other))
    return own.rjust(size) + base, other.rjust(size) + base


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_LAZY2, min_match=4,
        window_log=18, hash_log=17, chain_log=17, search_log=5, target_length=32,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    content = content or b" " * 8
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


class Gaps:
    """Compression gaps of texts between two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.tools = _compressor(toxic), _compressor(ordinary)

    def figures(self, texts: list[str | None]) -> np.ndarray:
        """For each text, figures of its windows' gaps; texts without words have zeros."""
        windows = [windows_of(words_of(x), WINDOW_WORDS) for x in texts]
        flat = [y for x in windows for y in x]
        if not flat:
            return np.empty((0, 5))
        lengths = []
        for tool in self.tools:
            made = tool.multi_compress_to_buffer(flat, threads=1)
            lengths.append(np.fromiter((len(made[at]) for at in range(len(made))), np.int64, len(made)))
        gaps, low, rows = lengths[1] - lengths[0], 0, []
        for own in windows:
            part = np.sort(gaps[low : low + len(own)])[::-1].astype(float)
            low += len(own)
            root = len(part) ** 0.5
            rows.append(
                (part.sum() / root, part[0], part[:3].mean(), np.maximum(part - 2, 0).sum() / root, log(len(part)))
            )
        return np.array(rows)


def calibrate(figures: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic weights, intercept last, by Newton steps with a small ridge."""
    scale = figures.std(axis=0) + 1e-9
    rows = np.c_[figures / scale, np.ones(len(figures))]
    weights = np.zeros(rows.shape[1])
    ridge = np.eye(len(weights))
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (toxic - chance) - ridge @ weights
        weights += np.linalg.solve((rows.T * (chance * (1 - chance))) @ rows + ridge, slope)
    return np.r_[weights[:-1] / scale, weights[-1]]


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights


def learn(
    docs: DataFrame, labels: DataFrame, toxic_texts: int = LEARN_TOXIC, ordinary_texts: int = LEARN_ORDINARY
) -> Model | None:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), held-out rows apart.

    About ``toxic_texts`` and ``ordinary_texts`` labelled texts, those with the smallest
    hashes, are learnt from on the driver. None if a class has no text.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {bool(x.toxic): x.n for x in known.groupBy(F.col("toxic") > 0).agg(F.count(F.lit(1)).alias("n"))
              .toDF("toxic", "n").collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic") > 0, min(1.0, toxic_texts / counts[True])).otherwise(
        min(1.0, ordinary_texts / counts[False])
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    # The chosen rows are fewer than the bounds above plus chance, so they may be broadcast.
    chosen = F.broadcast(known.filter(place < share))
    rows = (
        docs.select("doc_id", "text").filter("text IS NOT NULL").join(chosen, "doc_id")
        .select("text", (F.col("toxic") > 0).alias("toxic"),
                (F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(1_000)) < int(1_000 * TRAIN_SHARE)).alias("train"))
        .orderBy("doc_id", "text").collect()
    )
    parts = {key: [x.text for x in rows if (x.toxic, x.train) == key] for key in
             ((True, True), (True, False), (False, True), (False, False))}
    if not (parts[True, True] and parts[False, True]):
        return None
    toxic, ordinary = train(parts[True, True], parts[False, True])
    tested = sorted(set(parts[True, False])), sorted(set(parts[False, False]))
    if not (tested[0] and tested[1]):
        tested = sorted(set(parts[True, True])), sorted(set(parts[False, True]))
    gaps = Gaps(toxic, ordinary)
    figures = gaps.figures(tested[0] + tested[1])
    marks = np.r_[np.ones(len(tested[0])), np.zeros(len(tested[1]))]
    return Model(toxic, ordinary, calibrate(figures, marks))


def _judged(batches, model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    gaps, weights = Gaps(model.value.toxic, model.value.ordinary), model.value.weights
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            figures = gaps.figures(batch.column("text").to_pylist())
            values = np.clip(figures @ weights[:-1] + weights[-1], -30, 30)
            yield batch, 1 / (1 + np.exp(-values))


def _scored(batches, model) -> Iterator[pa.RecordBatch]:
    for batch, found in _judged(batches, model):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])


def _accepted(batches, model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch, found in _judged(batches, model):
        yield batch.filter(pa.array(found < threshold))


def accepted(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns; all without a model."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, lambda batches: _accepted(batches, shared, threshold), docs.schema)


def scores(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Only the text decides the score. Null and empty texts, and texts without letters, get
    the score of a text without gaps; without a model every score is 0. Repeated rows are
    scored each; a null doc_id counts as held out. Other columns are ignored.
    """
    source = docs.select("doc_id", "text")
    if model is None:
        found = source.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        found = map_arrow(source, lambda batches: _scored(batches, shared), "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
