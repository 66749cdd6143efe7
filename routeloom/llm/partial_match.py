"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes deep with the counts of the byte
that follows each. A byte is predicted in its longest context; where it has not been seen
there, an escape leads to the next shorter one, in which all bytes of the longer context are
excluded, down to an even choice among the bytes left. Escapes are estimated by method D: of
2T half counts in a context each byte seen there gives one to the escape.

A trie level is kept as what it stands for, the sorted runs of bytes (a context and the byte
after it) in 64-bit numbers, so that the trie of a whole corpus is a table and not one
worker's memory. Every context has seen what its extensions have, so the bytes excluded in a
context are exactly those seen in the next longer one, and the cost of a run depends on the
run alone. It is worked out once per distinct run of the corpus; every chunk of texts then
asks for the runs it holds. Words are counted the same way, for the base score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, packed, pieces_of, stored, unpacked

# Bytes of context; a run of ORDER + 1 bytes fits into a 64-bit number.
ORDER = 5
# Marks before and after a text; no UTF-8 text holds these bytes.
START, END = 0xFF, 0xFE
SYMBOLS = 255  # a text's bytes and its end
# A word of a sort that no text has: the end of a text, counted as a token.
END_WORD = bytes([END])

# Bytes of text in a chunk, and of those whose runs are numbered at a time.
CHUNK_BYTES, SLICE_BYTES = 12_000_000, 2_000_000
# Keys of one row of a table of keys.
ROW_KEYS = 500_000
# Bytes of text for each bucket that keys are dealt to, and the most buckets.
BUCKET_BYTES, MAX_BUCKETS = 32_000_000, 10_000

RUNS, WORDS = 0, 1
NUMBERS = {RUNS: np.int32, WORDS: np.int64}  # costs, counts
# Costs are whole numbers of this unit, so that sums do not depend on their order; a text's
# score is off by less than 3e-8 a byte.
UNIT = 2.0**-24

CHUNKS = "chunk long, split int, ids array<long>, ends array<long>, body binary, n_bytes long"
ASKED = "bucket long, kind int, chunk long, keys binary, numbers binary"
COUNTED = "bucket long, kind int, chunk long, keys binary, numbers binary, total long, known long"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys * _ODD
    return ((mixed ^ (mixed >> np.uint64(29))) * _ODD >> np.uint64(32)) % np.uint64(buckets)


def normal(text: str | None) -> bytes:
    """The words of a text, ASCII letters lowered, parted by single spaces."""
    return b" ".join((text or "").encode().lower().split())


def summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of each one's numbers."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(numbers[order], starts)


def runs_of(body: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs that end at places low to high of a body, and the places that count."""
    first = max(low, ORDER)
    keys = np.zeros(max(high - first, 0), np.uint64)
    for back in range(ORDER, -1, -1):
        keys <<= np.uint64(8)
        keys |= body[first - back : high - back]
    real = body[first:high] != START
    return keys[real], np.flatnonzero(real) + first


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of CHUNKS: texts to learn from, then those held out from place ``split`` on."""
    from pyspark import TaskContext

    lead, close = bytes([START]) * ORDER, bytes([END])
    task, made = TaskContext.get().partitionId(), 0
    held: list[list] = [[], []]
    size = 0

    def row() -> pa.RecordBatch:
        nonlocal made
        docs = held[0] + held[1]
        body = b"".join(x[1] for x in docs)
        values = [
            [(task << 32) + made], [len(held[0])], [[x[0] for x in docs]],
            [np.cumsum([len(x[1]) for x in docs])],
            [pa.compress(body, "zstd", asbytes=True)], [len(body)],
        ]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
        names = ["chunk", "split", "ids", "ends", "body", "n_bytes"]
        made += 1
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    for whole in batches:
        for batch in pieces_of(whole, "text", CHUNK_BYTES):
            columns = (batch.column(x).to_pylist() for x in ("doc_id", "text", "held_out"))
            for doc_id, text, out in zip(*columns):
                body = lead + normal(text) + close
                held[out].append((doc_id, body))
                size += len(body)
                if size >= CHUNK_BYTES:
                    yield row()
                    held, size = [[], []], 0
    if held[0] or held[1]:
        yield row()


def _words_in(body: bytes, low: int, high: int) -> Iterator[list[bytes]]:
    """The words of a part of a body, some megabytes at a time; each text's end is one, too."""
    while low < high:
        stop = high
        if high - low > SLICE_BYTES:
            found = body.find(b" ", low + SLICE_BYTES, high)
            stop = high if found < 0 else found
        parted = body[low:stop].replace(END_WORD, b" " + END_WORD + b" ")
        yield parted.translate(None, bytes([START])).split()
        low = stop


def _word_counts(body: bytes, border: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a body and how often each comes before the border."""
    counts = Counter()
    for words in _words_in(body, 0, border):
        counts.update(words)
    for words in _words_in(body, border, len(body)):
        for word in set(words).difference(counts):
            counts[word] = 0
    return list(counts), np.fromiter(counts.values(), np.int64, len(counts))


def _word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _run_counts(body: bytes, border: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of a body in order and how often each comes before the border."""
    data = np.frombuffer(body, np.uint8)
    found = []
    for low, high, learnt in ((0, border, True), (border, len(data), False)):
        for at in range(low, high, SLICE_BYTES):
            keys, counts = np.unique(runs_of(data, at, min(at + SLICE_BYTES, high))[0], return_counts=True)
            found.append((keys, counts if learnt else np.zeros(len(keys), np.int64)))
    if len(found) == 1:
        return found[0]
    return summed(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by bucket and key, the borders of its buckets in it, and which buckets these are."""
    bucket = _bucket(keys, buckets)
    order = np.lexsort((keys, bucket))
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.empty(0, np.int64)
    return order, np.r_[starts, len(keys)], bucket[starts].astype(np.int64)


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    """Rows of ASKED from (bucket, kind, chunk, rising keys or none, numbers)."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    made = [(*x[:3], None if x[3] is None else packed(x[3], rising=True), packed(x[4])) for x in parts]
    columns = list(zip(*made)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(columns, kinds)], ["bucket", "kind", "chunk", "keys", "numbers"]
    )


def _border(split: int, ends: list[int]) -> int:
    return ends[split - 1] if split else 0


def _asked(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """What each chunk holds: its distinct runs and words with their counts, by bucket."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk, split, ends, body, size = (
                batch.column(x)[row].as_py() for x in ("chunk", "split", "ends", "body", "n_bytes")
            )
            body = pa.decompress(body, size, "zstd", asbytes=True)
            border = _border(split, ends)
            words, word_counts = _word_counts(body, border)
            found = ((RUNS, *_run_counts(body, border)), (WORDS, _word_keys(words), word_counts))
            parts = []
            for kind, keys, counts in found:
                order, borders, which = _dealt(keys, buckets)
                keys, counts = keys[order], counts[order].astype(np.uint32)
                for at, bucket in enumerate(which.tolist()):
                    here = slice(borders[at], borders[at + 1])
                    parts.append((bucket, kind, chunk, keys[here], counts[here]))
            yield _rows(parts)


def _by_bucket(batches: Iterable[pa.RecordBatch], fields: list[str]) -> Iterator[tuple]:
    """(bucket, kind) and its rows, from a stream sorted by these."""
    rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in fields)) for batch in batches)
    return groupby(rows, key=lambda row: row[:2])


def _combined(rows: Iterable[tuple], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sums by key over packed rows (keys, numbers), folded as they come."""
    keys, numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
    held, size = [], 0
    for packed_keys, counts in rows:
        held.append((unpacked(packed_keys, np.uint64, rising=True), unpacked(counts, kind).astype(np.int64)))
        size += len(held[-1][0])
        if size > max(len(keys), 2_000_000):
            keys, numbers = summed(*(np.concatenate(x) for x in zip((keys, numbers), *held)))
            held, size = [], 0
    return summed(*(np.concatenate(x) for x in zip((keys, numbers), *held)))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a bucket's keys over all chunks, as rows of COUNTED."""
    for (bucket, kind), rows in _by_bucket(batches, ["bucket", "kind", "keys", "numbers"]):
        keys, counts = _combined((row[2:] for row in rows), np.uint32)
        for at in range(0, len(keys), ROW_KEYS):
            part = counts[at : at + ROW_KEYS]
            made = _rows([(bucket, kind, -1, keys[at : at + ROW_KEYS], part)])
            totals = [pa.array([int(x)], pa.int64()) for x in (part.sum(), np.count_nonzero(part))]
            yield pa.RecordBatch.from_arrays([*made.columns, *totals], [*made.schema.names, "total", "known"])


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of byte pairs, of which there are at most 65,536."""
    found = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("numbers").to_pylist()):
            pair = (unpacked(keys, np.uint64, rising=True) & np.uint64(0xFFFF)).astype(np.int64)
            np.add.at(found, pair, unpacked(counts, np.int64))
    seen = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], ["pair", "n"])


def _to_contexts(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Runs dealt by the last two bytes of their context."""
    for batch in batches:
        for held, numbers in zip(batch.column("keys").to_pylist(), batch.column("numbers").to_pylist()):
            keys, counts = unpacked(held, np.uint64, rising=True), unpacked(numbers, np.int64)
            order, borders, which = _dealt((keys >> np.uint64(8)) & np.uint64(0xFFFF), buckets)
            parts = []
            for at, bucket in enumerate(which.tolist()):
                here = np.sort(order[borders[at] : borders[at + 1]])
                parts.append((bucket, RUNS, -1, keys[here], counts[here]))
            yield _rows(parts)


class Level:
    """One depth of the trie: runs of a context and a byte, and what each context has seen.

    ``total`` counts what followed a context and ``distinct`` the different bytes.
    """

    def __init__(self, runs: np.ndarray, counts: np.ndarray):
        self.runs, self.counts = runs, counts
        contexts = runs >> np.uint64(8)
        self.starts = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]])
        lengths = np.diff(np.r_[self.starts, len(runs)])
        self.context = np.repeat(np.arange(len(self.starts)), lengths)
        self.total = np.add.reduceat(counts, self.starts)
        self.distinct = np.add.reduceat((counts > 0).astype(np.int64), self.starts)


def costs(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of each run's probability: its last byte after those before it.

    ``keys`` are all distinct runs whose contexts end in some byte pairs, in order, with
    their counts (0: only asked for); ``pairs`` are the counts of all byte pairs.
    """
    levels = {ORDER: Level(keys, counts)}
    for depth in range(ORDER - 1, 1, -1):
        mask = np.uint64((1 << 8 * (depth + 1)) - 1)
        longer = levels[depth + 1]
        levels[depth] = Level(*summed(longer.runs & mask, longer.counts))
    # the two lowest levels hold every pair, seen or not, so that places are the runs
    levels[1] = Level(np.arange(1 << 16, dtype=np.uint64), pairs)
    levels[0] = Level(np.arange(1 << 8, dtype=np.uint64), pairs.reshape(256, 256).sum(axis=0))
    ups, excluded = {}, {0: np.zeros(1, np.int64)}
    for depth in range(ORDER, 0, -1):
        level, below = levels[depth], levels[depth - 1]
        ups[depth] = np.searchsorted(below.runs, level.runs & np.uint64((1 << 8 * depth) - 1))
        seen = np.where(level.counts > 0, below.counts[ups[depth]], 0)
        excluded[depth] = np.add.reduceat(seen, level.starts)
    logs = np.zeros(len(keys))
    open_, place = np.arange(len(keys)), np.arange(len(keys))
    masked, hidden = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for depth in range(ORDER, -1, -1):
        level = levels[depth]
        context, count = level.context[place], level.counts[place]
        total, left = level.total[context] - masked, level.distinct[context] - hidden
        share = np.where(count > 0, 2 * count - 1, left) / np.maximum(2 * total, 1)
        logs[open_] += np.log10(np.where((count > 0) | (left > 0), share, 1.0))
        on = count == 0
        open_, place, context = open_[on], place[on], context[on]
        masked, hidden = excluded[depth][context], level.distinct[context]
        if depth:
            place = ups[depth][place]
    logs[open_] -= np.log10(SYMBOLS - levels[0].distinct[0])
    return logs


def _costs(batches: Iterable[pa.RecordBatch], pairs: dict[int, int], buckets: int) -> Iterator[pa.RecordBatch]:
    """Costs of the runs of each context bucket, dealt by the run again."""
    dense = np.zeros(1 << 16, np.int64)
    dense[list(pairs)] = list(pairs.values())
    for _, rows in _by_bucket(batches, ["bucket", "kind", "keys", "numbers"]):
        keys, counts = _combined((row[2:] for row in rows), np.int64)
        made = np.rint(costs(keys, counts, dense) / UNIT).astype(np.int32)
        order, borders, which = _dealt(keys, buckets)
        for at, bucket in enumerate(which.tolist()):
            here = order[borders[at] : borders[at + 1]]
            for low in range(0, len(here), ROW_KEYS):
                part = here[low : low + ROW_KEYS]
                yield _rows([(bucket, RUNS, -1, keys[part], made[part])])


def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is known of each asked key; a bucket's table (chunk -1) comes before what is asked."""
    for (bucket, kind), rows in _by_bucket(batches, ["bucket", "kind", "chunk", "keys", "numbers"]):
        table, keys = [], None
        for _, _, chunk, asked, numbers in rows:
            asked = unpacked(asked, np.uint64, rising=True)
            if chunk < 0:
                table.append((asked, unpacked(numbers, NUMBERS[kind])))
                continue
            if keys is None:
                keys, values = (np.concatenate(x) for x in zip(*table))
                order = np.argsort(keys)
                keys, values = keys[order], values[order]
            yield _rows([(bucket, kind, chunk, None, values[np.searchsorted(keys, asked)])])


def _in_key_order(keys: np.ndarray, buckets: int, answers: list[bytes], kind: int) -> np.ndarray:
    """Answers, which come by bucket, at the places of their keys."""
    values = np.empty(len(keys), NUMBERS[kind])
    values[_dealt(keys, buckets)[0]] = np.concatenate([unpacked(x, NUMBERS[kind]) for x in answers])
    return values


def _scored(batches: Iterable[pa.RecordBatch], buckets: int, total: int, distinct: int) -> Iterator[pa.RecordBatch]:
    """Scores of each chunk's texts; a chunk (kind -1) comes before its answers."""
    names = ["chunk", "kind", "numbers", "split", "ids", "ends", "body", "n_bytes"]
    rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in names)) for batch in batches)
    for _, group in groupby(rows, key=lambda row: row[0]):
        _, _, _, split, ids, ends, body, size = next(group)
        body = pa.decompress(body, size, "zstd", asbytes=True)
        answers: list[list[bytes]] = [[], []]
        for row in group:
            answers[row[1]].append(row[2])
        border = _border(split, ends)
        runs = _run_counts(body, border)[0]
        logs = _in_key_order(runs, buckets, answers[RUNS], RUNS)
        data, scores = np.frombuffer(body, np.uint8), np.zeros(len(ids))
        for at in range(0, len(data), SLICE_BYTES):
            keys, places = runs_of(data, at, min(at + SLICE_BYTES, len(data)))
            text = np.searchsorted(ends, places, side="right")
            scores += np.bincount(text, logs[np.searchsorted(runs, keys)], len(ids))
        words, _ = _word_counts(body, border)
        counts = _in_key_order(_word_keys(words), buckets, answers[WORDS], WORDS)
        smoothed = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
        number = dict(zip(words, range(len(words))))
        known = counts > 0
        tokens, seen, base = [], [], []
        for low, high in zip([0, *ends[:-1]], ends):
            places = [np.fromiter(map(number.__getitem__, x), np.int64, len(x)) for x in _words_in(body, low, high)]
            tokens.append(sum(map(len, places)))
            seen.append(sum(int(np.count_nonzero(known[x])) for x in places))
            base.append(sum(float(smoothed[x].sum()) for x in places))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([at >= split for at in range(len(ids))]),
                pa.array(tokens, pa.int64()), pa.array(seen, pa.int64()),
                pa.array([total] * len(ids), pa.int64()), pa.array(base), pa.array(scores * UNIT),
                pa.array(np.diff(np.r_[0, ends]) - ORDER - 1, pa.int64()),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"],
        )


def scores(docs: DataFrame, divisor: int = 10, remainder: int = 0) -> DataFrame:
    """``docs`` (doc_id, text) with the log10 probability of each whole text.

    Texts whose crc32(doc_id as text) leaves ``remainder`` by ``divisor`` are held out, as
    are those with a null doc_id; all others are learnt from. A text is its words
    (ASCII letters lowered, parted by ASCII white space) joined by single spaces, and an end.

    Per row: ``held_out``; ``n_tokens``, its words and its end; ``n_known``, those learnt;
    ``train_tokens``, all learnt tokens; ``base_score``, by word frequencies with 0.1 added
    to each count; ``score``, by the model; ``n_bytes`` of the joined words. A null or empty
    text has one token, its end. Repeated rows each give a row and count each time. With
    nothing to learn from every byte is equally likely. An empty table gives no rows. Other
    columns are ignored. Words are told apart by 64-bit hashes.

    A chunk's distinct runs and words are dealt to buckets by hash, so a run that is in
    every text is asked for once a chunk and no bucket has more than its share.
    """
    identifier = F.col("doc_id").cast("string").cast("binary")
    held = F.coalesce(F.crc32(identifier) % divisor == remainder, F.lit(True))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    chunks = stored(map_arrow(source, _chunks, CHUNKS), "chunks")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(width, -(-size // BUCKET_BYTES)))

    def grouped(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.repartition(buckets, keys[0]).sortWithinPartitions(*keys)

    asked = stored(map_arrow(chunks, lambda x: _asked(x, buckets), ASKED), "asked_keys")
    counts = stored(map_arrow(grouped(asked, "bucket", "kind"), _count, COUNTED), "key_counts")
    words = counts.filter(f"kind = {WORDS}").agg(F.sum("total"), F.sum("known")).first()
    total, distinct = words[0] or 0, words[1] or 0
    runs = counts.filter(f"kind = {RUNS}").select("keys", "numbers")
    # at most 65,536 rows, whatever the corpus
    pairs = map_arrow(runs, _pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    known = {row["pair"]: row["n"] for row in pairs.collect()}
    contexts = map_arrow(runs, lambda x: _to_contexts(x, buckets), ASKED)
    priced = map_arrow(grouped(contexts, "bucket", "kind"), lambda x: _costs(x, known, buckets), ASKED)
    tables = priced.unionByName(counts.filter(f"kind = {WORDS}").select(*priced.columns))
    requests = asked.withColumn("numbers", F.lit(None).cast("binary"))
    answers = map_arrow(grouped(tables.unionByName(requests), "bucket", "kind", "chunk"), _answers, ASKED)
    gathered = chunks.withColumns({"kind": F.lit(-1), "bucket": F.lit(-1).cast("long")}).unionByName(
        answers.drop("keys"), allowMissingColumns=True
    )
    return map_arrow(
        grouped(gathered, "chunk", "kind", "bucket"),
        lambda x: _scored(x, buckets, total, distinct),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, n_bytes long",
    )
