"""Ranked lexical search: term at a time with a limited set of accumulators.

Documents are indexed in blocks. A block's terms are matched with the terms of the queries,
and what is left is written once as an inverted index. In a block a query takes its terms
from rare to common. A document gets an accumulator when a term first meets it; as soon as
the best that all remaining terms can add falls below the score that the k-th best document
has already, no new accumulators are made and the remaining terms only update those there
are, to the end. So the scores of the documents that can be in the result are exact, and
documents that hold none but the common terms are never counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, pieces_of, stored

# Text bytes of a block.
BLOCK_BYTES = 8_000_000
# Terms of the queries that one task holds at a time, about; more make another group.
GROUP_TERMS = 500_000
# The most tasks that the blocks are dealt to.
MAX_SLOTS = 10_000
# The term of the row that describes a block's documents; no real term is empty.
DOCUMENTS = ""

INDEX = (
    "block long, term string, places binary, counts binary, ids array<long>, "
    "found long, total long"
)
FOUND = "query long, doc_id long, score long"


def _term_bytes() -> np.ndarray:
    """Which bytes belong to terms: ASCII digits and letters, and all beyond ASCII."""
    table = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = True
    return table


_TERM = _term_bytes()


def terms_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of some texts, the term at each place, and the text of each place."""
    parts = [(text or "").encode().lower() for text in texts]
    data = np.frombuffer(b" ".join(parts), np.uint8)
    ends = np.cumsum([len(x) + 1 for x in parts])
    inside = _TERM[data]
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]]) if len(data) else np.empty(0, np.int64)
    stops = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 if len(data) else starts
    offsets = np.r_[0, np.cumsum(stops - starts)].astype(np.int32)
    kept = data[inside].tobytes() if len(data) else b""
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, codes, np.searchsorted(ends, starts, side="right")


def _packed(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """A binary column whose rows are the parts of a 32-bit array between borders."""
    data = values.astype(np.int32).tobytes()
    offsets = (borders * 4).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of INDEX: the documents of each block, and each of its terms with its postings."""
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    names = ["block", "term", "places", "counts", "ids", "found", "total"]
    for whole in batches:
        for batch in pieces_of(whole, "text", BLOCK_BYTES):
            block, size = (task << 32) + made, batch.num_rows
            made += 1
            terms, codes, texts = terms_of(batch.column("text").to_pylist())
            lengths = np.bincount(texts, minlength=size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()), pa.array([DOCUMENTS]), pa.array([b""]),
                    pa.array([lengths.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                ],
                names,
            )
            if not len(terms):
                continue
            pairs, counts = np.unique(codes * size + texts, return_counts=True)
            borders = np.r_[np.searchsorted(pairs // size, np.arange(len(terms))), len(pairs)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(terms), block)), terms, _packed(pairs % size, borders),
                    _packed(counts, borders), pa.nulls(len(terms), pa.list_(pa.int64())),
                    pa.array(np.diff(borders)), pa.array(np.add.reduceat(counts, borders[:-1])),
                ],
                names,
            )


def _query_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, codes, texts = terms_of(batch.column("text").to_pylist())
        pairs = np.unique(texts * max(len(terms), 1) + codes)
        found, which = np.divmod(pairs, max(len(terms), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("query").take(pa.array(found)), terms.take(pa.array(which))], ["query", "term"]
        )


class Best:
    """The best k of the documents seen: higher scores first, then smaller numbers."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)
        self.unnamed = np.empty(0, bool)

    @property
    def floor(self) -> int:
        """The score below which nothing can enter; 1 at first, since 0 never does."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, unnamed = np.concatenate([self.ids, ids]), np.concatenate([self.unnamed, unnamed])
        order = np.lexsort((ids, unnamed, -scores))[: self.k]
        self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]


def accumulate(
    postings: list[tuple[np.ndarray, np.ndarray]], size: int, floor: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents of a block that may be among a query's best k.

    ``postings`` are (places, gains) of the query's terms, in the order of taking them;
    ``size`` is the number of documents, ``floor`` a score that a result must have anyway.
    Every document whose score reaches both ``floor`` and the k-th best is there.
    """
    most = np.array([gains.max() for _, gains in postings], np.int64)
    rest = np.cumsum(most[::-1])[::-1]  # what a term and all after it can add
    sums, live = np.zeros(size, np.int64), np.zeros(size, bool)
    creating, count = True, 0
    for (places, gains), bound in zip(postings, rest.tolist()):
        if creating and count >= k:
            floor = max(floor, int(np.partition(sums, size - k)[size - k]))
        # one that would only equal the floor may still win by its number
        creating = creating and bound >= floor
        if creating:
            sums[places] += gains
            live[places] = True
            count = int(np.count_nonzero(live))
        elif not count:
            break
        else:
            on = live[places]
            sums[places[on]] += gains[on]
    places = np.flatnonzero(live)
    places = places[sums[places] >= floor]
    return places, sums[places]


def _search(batches: Iterable[pa.RecordBatch], documents: int, terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """Best documents of each query over each (slot, part): queries come before the index."""
    names = ["slot", "part", "kind", "block", "query", "words", "weights", "term", "places", "counts", "ids"]
    rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in names)) for batch in batches)
    for _, group in groupby(rows, key=lambda row: row[:2]):
        queries = []
        for (kind, _), part in groupby(group, key=lambda row: row[2:4]):
            if kind == 0:
                queries = [(row[4], list(zip(row[5], row[6])), Best(k)) for row in part]
                continue
            first = next(part)
            ids = np.array([-1 if x is None else x for x in first[10]], np.int64)
            unnamed = np.array([x is None for x in first[10]], bool)
            lengths = np.frombuffer(first[9], np.int64)
            scale = 50 + 50 * lengths * documents // max(terms, 1)
            raw = {}
            for row in part:
                places, counts = (np.frombuffer(x, np.int32).astype(np.int64) for x in row[8:10])
                raw[row[7]] = places, 1_000_000_000 * counts // (1000 * counts + 20 * scale[places])
            gains: dict[str, tuple] = {}
            for _, wanted, best in queries:
                postings = []
                for word, weight in wanted:
                    if word in raw:
                        if word not in gains:
                            gains[word] = raw[word][0], weight * raw[word][1]
                        postings.append(gains[word])
                if postings:
                    places, scores = accumulate(postings, len(ids), best.floor, k)
                    best.add(scores, ids[places], unnamed[places])
        for query, _, best in queries:
            if len(best.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query] * len(best.scores), pa.int64()),
                        pa.array(best.ids, mask=best.unnamed), pa.array(best.scores),
                    ],
                    ["query", "doc_id", "score"],
                )


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The best ``k`` of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z
    lowered. With N documents that have a term, L their terms, n a document's terms, df the
    documents that hold a term and tf its occurrences there, a term weighs
    floor(1000 ln((2N+2)/(2df+1))), a document's m is 50 + (50 n N) div L, and its score is
    the sum of weight * ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms, in
    64-bit integers. Rows: item_id, rank (from 1), doc_id, score; scores above 0 only,
    equal ones by doc_id, null ones last.

    Null and empty texts hold no term: as documents they are found by nothing and not
    counted in N, as items they give no rows. Repeated rows of either table count each time,
    so an item_id that stands twice has its ranks twice. Empty tables give no rows. Other
    columns are ignored.

    All terms of the documents are indexed block by block, but only the queries' are kept:
    Spark broadcasts their list if it is small and shuffles the index otherwise. Queries are
    cut into parts of bounded size; every part meets every block.
    """
    queries = stored(items.select(F.monotonically_increasing_id().alias("query"), "item_id", "text"), "queries")
    wanted = stored(map_arrow(queries.select("query", "text"), _query_terms, "query long, term string"), "query_terms")
    known = wanted.select("term").unionByName(
        docs.sparkSession.createDataFrame([(DOCUMENTS,)], "term string")
    ).distinct()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = stored(map_arrow(source, _index, INDEX).join(known, "term", "left_semi"), "index")
    stats = stored(
        index.groupBy("term").agg(
            F.sum("found").alias("found"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("blocks")
        ),
        "term_counts",
    )
    whole = stats.filter(F.col("term") == DOCUMENTS).first()
    documents, terms, blocks = (whole["found"], whole["total"], whole["blocks"]) if whole else (0, 0, 0)
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("found") + 1)))
    weighed = wanted.join(stats.filter(F.col("term") != DOCUMENTS), "term").select(
        "query", F.struct((-weight).alias("order"), "term").alias("entry")
    )
    parts = max(1, -(-wanted.count() // GROUP_TERMS))
    slots = max(1, min(MAX_SLOTS, blocks))
    asked = weighed.groupBy("query").agg(F.sort_array(F.collect_list("entry")).alias("entries")).select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        F.pmod(F.hash("query"), F.lit(parts)).alias("part"),
        F.lit(0).alias("kind"),
        F.lit(-1).cast("long").alias("block"),
        "query",
        F.col("entries.term").alias("words"),
        F.transform("entries.order", lambda x: -x).alias("weights"),
    )
    placed = index.select(
        F.pmod(F.hash("block"), F.lit(slots)).alias("slot"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(1).alias("kind"),
        "block", "term", "places", "counts", "ids",
    )
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = asked.unionByName(placed, allowMissingColumns=True)
    dealt = together.repartition(min(MAX_SLOTS, max(width, slots)), "slot", "part").sortWithinPartitions(
        "slot", "part", "kind", "block", "term"
    )
    found = map_arrow(dealt, lambda x: _search(x, documents, terms, k), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
