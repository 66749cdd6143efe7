"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability in a language is the sum over all ways to cut it into pieces, which a forward
pass over its characters adds up; a text's is the product over its words. Probabilities are
learnt by expectation maximisation: in each round Spark maps the distinct words to expected
piece counts under the present probabilities and sums them.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from .common import held_out, map_arrow, pieces_of, remembers, stored

SPACE = "▁"
ROUNDS = 3
# Longer runs of letters are scored in parts of this many characters.
WORD_CHARS = 32
# A text whose letters are so many times as surprising as usual is in no learnt language;
# so many letters more, divided by its own, are allowed to short texts.
FOREIGN, SHORT = 2.4, 5
# What a letter that no piece covers counts, and what every piece has beside its share.
FLOOR = 1e-7
REMEMBERED = 200_000
BATCH_BYTES, WORD_BATCH = 1_000_000, 20_000
# Distinct words that a task counts before it hands their counts on.
COUNTED_WORDS = 100_000
UNDETERMINED = "und"
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def _kinds() -> np.ndarray:
    """For each code point 2 if it is a letter, 1 if a mark, else 0."""
    every = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32).tobytes().decode("utf-32-le")
    found = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((2, r"\p{L}+"), (1, r"\p{M}+")):
        for run in regex.finditer(pattern, every):
            found[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
    # a run may go on beyond the surrogates, which are neither
    found[0xD800:0xE000] = 0
    return found


_kind: list[np.ndarray] = []


def cut_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of texts; for each word in place: which one, whose text, its letters.

    Words are the runs of letters (with the marks behind them) of the lowered text, in parts
    of bounded length.
    """
    if not _kind:
        _kind.append(_kinds())
    lowered = [(text or "").lower() for text in texts]
    codes = np.frombuffer("\0".join(lowered).encode("utf-32-le"), np.uint32)
    kind = _kind[0][codes]
    inside = kind > 0
    if (kind == 1).any():  # marks without a letter before them begin no word
        at = np.arange(len(kind))
        letter = np.maximum.accumulate(np.where(kind == 2, at, -1))
        inside &= letter > np.maximum.accumulate(np.where(kind == 0, at, -1))
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = turns[::2], turns[1::2] - turns[::2]
    owners = np.searchsorted(np.cumsum([len(x) + 1 for x in lowered]), starts, side="right")
    if len(sizes) and sizes.max() > WORD_CHARS:
        parts = -(-sizes // WORD_CHARS)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        sizes = np.minimum(np.repeat(sizes, parts) - WORD_CHARS * part, WORD_CHARS)
        owners = np.repeat(owners, parts)
    words, places = _distinct(codes[inside], sizes)
    return words, places, owners, sizes


def _distinct(codes: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The distinct words among those that follow each other in ``codes``, and each one's place."""
    borders = 4 * np.r_[0, np.cumsum(sizes)]
    buffers = [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(codes)]
    coded = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).dictionary_encode()
    _, ends, data = coded.dictionary.buffers()
    text = data.to_pybytes().decode("utf-32-le") if data else ""
    ends = (np.frombuffer(ends, np.int64)[: len(coded.dictionary) + 1] // 4).tolist()
    return [text[low:high] for low, high in zip(ends, ends[1:])], coded.indices.to_numpy()


def words_of(text: str | None) -> list[str]:
    """The words of one text in order."""
    words, places, _, _ = cut_words([text])
    return [words[at] for at in places.tolist()]


class Lattice:
    """The pieces between characters of marked words.

    Each word has a row for every place between its characters, from ``first`` to ``last``.
    An item of ``edges`` belongs to one length of pieces, the longest first, and has the rows
    where such pieces end, what they are, and how many end by each place in a word.
    """

    def __init__(self, first: np.ndarray, last: np.ndarray, edges: list):
        self.first, self.last, self.edges = first, last, edges
        self.steps = int((last - first).max(initial=0))

    def ending(self, step: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, last rows and pieces of all that end ``step`` characters into a word."""
        for size, ends, pieces, upto in self.edges:
            low, high = upto[step - 1], upto[step]
            if low < high:
                yield size, ends[low:high], pieces[low:high]


class Pieces:
    """The vocabulary: places of its lower-case pieces of letters, and a trie of them."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(at) for at in range(model.get_piece_size()))
        kept = sorted({x for x in names if x == x.lower() and _LETTERS.fullmatch(x.removeprefix(SPACE))})
        self.place = {piece: at for at, piece in enumerate(kept)}
        self.longest = max(map(len, kept))
        self._build()

    def _build(self) -> None:
        """Children of all nodes in one array, found at the node's base plus the character's number."""
        often = Counter(SPACE.join(self.place))
        number = {x: at for at, x in enumerate(sorted(often, key=lambda x: (-often[x], x)), 1)}
        self.number = np.zeros(0x110000, np.int32)
        for x, at in number.items():
            self.number[ord(x)] = at
        children, piece = [{}], [-1]
        for name, place in self.place.items():
            node = 0
            for at in map(number.get, name):
                if at not in children[node]:
                    children[node][at] = len(children)
                    children.append({})
                    piece.append(-1)
                node = children[node][at]
            piece[node] = place
        taken, base, slot, count = {}, [0] * len(children), 0, 0
        for node in sorted(range(len(children)), key=lambda x: -len(children[x])):
            if not (own := list(children[node])):
                break
            if len(own) != count:  # gaps that larger nodes left may do for smaller ones
                slot, count = len(number), len(own)
            while any(slot - own[0] + at in taken for at in own):
                slot += 1
            base[node] = slot - own[0]
            taken |= {base[node] + at: (node, child) for at, child in children[node].items()}
        size = max(base) + len(number) + 1
        self.base, self.piece = np.array(base, np.int32), np.array(piece, np.int32)
        self.owner, self.child = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        slots = list(taken)
        self.owner[slots], self.child[slots] = np.array(list(taken.values())).T

    def lattices(self, words: list[str]) -> Iterator[tuple[np.ndarray, Lattice]]:
        """Parts of a list of words: their places in it and their lattice.

        A piece is its place in the vocabulary; a letter of no piece counts as one behind the last.
        """
        for low in range(0, len(words), WORD_BATCH):
            part = words[low : low + WORD_BATCH]
            yield np.arange(low, low + len(part)), self._lattice(part)

    def _lattice(self, words: list[str]) -> Lattice:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(sizes + 1) - sizes - 1
        last = first + sizes
        marked = SPACE + f"\0{SPACE}".join(words) + "\0"
        numbers = self.number[np.frombuffer(marked.encode("utf-32-le"), np.uint32)]
        step = np.arange(len(numbers)) - np.repeat(first, sizes + 1)
        starts = np.delete(np.arange(len(numbers)), last)
        nodes, edges = np.zeros(len(starts), np.int32), []
        for size in range(1, self.longest + 1):
            slots = self.base[nodes] + numbers[starts + (size - 1)]
            known = self.owner[slots] == nodes
            if size == 1:
                pieces = np.where(known, self.piece[self.child[slots]], -1)
                ends, pieces = starts + 1, np.where(pieces < 0, len(self.place), pieces)
            known = np.flatnonzero(known)
            starts, nodes = starts[known], self.child[slots[known]]
            if size > 1:
                pieces = self.piece[nodes]
                whole = np.flatnonzero(pieces >= 0)
                ends, pieces = starts[whole] + size, pieces[whole]
            by = step[ends].astype(np.uint8)
            order = np.argsort(by, kind="stable")
            upto = np.cumsum(np.bincount(by, minlength=WORD_CHARS + 2)).tolist()
            edges.append((size, ends[order], pieces[order], upto))
        return Lattice(first, last, edges[::-1])


_vocabularies: dict[str, Pieces] = {}


def vocabulary(path: str) -> Pieces:
    return _vocabularies.get(path) or _vocabularies.setdefault(path, Pieces(path))


def forward(lattice: Lattice, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed probability by language of all segmentations: up to each row, of each word."""
    sums = np.zeros((int(lattice.last.max(initial=-1)) + 1, chances.shape[1]))
    sums[lattice.first] = 1
    for step in range(1, lattice.steps + 1):
        for size, ends, pieces in lattice.ending(step):
            sums[ends] += sums.take(ends - size, axis=0) * chances.take(pieces, axis=0)
    return sums, sums[lattice.last]


def _expected(batches, path: str, chances, languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Expected piece counts of rows (word, one count per language)."""
    pieces, table = vocabulary(path), chances.value
    total = np.zeros_like(table)
    for whole in batches:
        for low in range(0, whole.num_rows, WORD_BATCH):
            batch = whole.slice(low, WORD_BATCH)
            seen = np.array([np.asarray(batch.column(f"n{at}")) for at in range(len(languages))]).T
            for rows, lattice in pieces.lattices(batch.column("word").to_pylist()):
                ahead, words = forward(lattice, table)
                behind = np.zeros_like(ahead)
                behind[lattice.last] = seen[rows] / words
                for step in range(lattice.steps, 0, -1):
                    for size, ends, used in lattice.ending(step):
                        behind[ends - size] += behind.take(ends, axis=0) * table.take(used, axis=0)
                for size, ends, used, _ in lattice.edges:
                    flow = ahead.take(ends - size, axis=0) * behind.take(ends, axis=0) * table.take(used, axis=0)
                    for at in range(len(languages)):
                        total[:, at] += np.bincount(used, flow[:, at], len(total))
    row, column = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), pa.array(column, pa.int64()), pa.array(total[row, column])],
        ["piece", "language", "expected"],
    )


def _word_counts(batches) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word, n): a task's words counted in parts of bounded size."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def counted() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
        counts.clear()
        columns = list(zip(*rows)) or [[]] * 3
        kinds = [pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(columns, kinds)], ["lang", "word", "n"])

    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            words, places, owners, _ = cut_words(batch.column("text").to_pylist())
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            pairs, times = np.unique(langs.indices.to_numpy()[owners] * np.int64(len(words)) + places, return_counts=True)
            lang, word = (x.tolist() for x in np.divmod(pairs, max(len(words), 1)))
            for x, y, n in zip(lang, word, times.tolist()):
                counts[names[x]][words[y]] += n
            if sum(map(len, counts.values())) >= COUNTED_WORDS:
                yield counted()
    yield counted()


class Model:
    """Piece probabilities, by row of a lattice and language, and shares of languages."""

    def __init__(self, languages: list[str], chances: np.ndarray, shares: np.ndarray):
        self.languages, self.chances, self.shares = languages, chances, shares
        self.handle: tuple | None = None


def _learnt_from(docs: DataFrame) -> DataFrame:
    """The rows with a text and a language, held-out ones apart."""
    return docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id")))


def learn(
    docs: DataFrame, path: str, texts: int | None = None, rounds: int = ROUNDS
) -> Model | None:
    """A model from the rows of ``docs`` (doc_id, text, lang) with a language, held-out ones apart.

    All their texts are learnt from. A trial may ask for about ``texts`` texts of each
    language, those with the smallest hashes. The shares of languages come from all rows.
    None if no row can be learnt from. The model is bounded by the vocabulary and the
    languages.
    """
    spark = docs.sparkSession
    rows = _learnt_from(docs.select("doc_id", "text", "lang"))
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    if not known:
        return None
    languages = [x.lang for x in known]
    if texts is not None:
        share = F.create_map(*[F.lit(y) for x in known for y in (x.lang, min(1.0, texts / x.n))])
        # a hash as a number from 0 to 1: the rows below a language's share are learnt from
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
        rows = rows.filter(place < share[F.col("lang")])
    words = map_arrow(rows.select("lang", "text"), _word_counts, "lang string, word string, n long")
    counted = stored(
        words.groupBy("word").agg(
            *[
                F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).cast("double").alias(f"n{at}")
                for at, lang in enumerate(languages)
            ]
        ).repartition("word"),
        "language_words",
    )
    pieces = vocabulary(path)
    # the two rows after the pieces: a letter of no piece, and no piece at all
    chances = np.full((len(pieces.place) + 2, len(languages)), 1 / (len(pieces.place) + 1))
    chances[-1] = 0
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(chances)
        summed = (
            map_arrow(
                counted, lambda batches: _expected(batches, path, shared, languages),
                "piece long, language long, expected double",
            )
            .groupBy("piece", "language").agg(F.sum("expected").alias("expected")).collect()
        )
        total = np.zeros_like(chances)
        for x in summed:
            total[x.piece, x.language] = x.expected
        total[-2] = 0
        chances = total / np.maximum(total.sum(axis=0), 1e-300) + FLOOR
        chances[-1] = 0
        shared.unpersist()
    shares = np.array([x.n for x in known], float)
    return Model(languages, chances, (shares + 1) / (shares + 1).sum())


class Seen:
    """Logarithms of words in all languages, a row of a table for each word that was seen."""

    def __init__(self, languages: int):
        self.row: dict[str, int] = {}
        self.values = np.empty((1024, languages))

    def add(self, words: list[str], values: np.ndarray) -> None:
        start = len(self.row)
        if start + len(words) > len(self.values):
            grown = np.empty((max(2 * len(self.values), start + len(words)), self.values.shape[1]))
            grown[:start] = self.values[:start]
            self.values = grown
        self.values[start : start + len(words)] = values
        self.row.update(zip(words, range(start, start + len(words))))


# The words of one model at a time.
_scores: dict[str, Seen] = {}
remembers(lambda: [x.clear() for x in (_scores, _vocabularies, _kind)], __name__)


def _judged(batches, path: str, model, name: str) -> Iterator[tuple]:
    """Batches with the predicted language, its score, and the logarithm and letters of each row."""
    pieces = vocabulary(path)
    chances, shares, languages = model.value.chances, np.log(model.value.shares), model.value.languages
    if name not in _scores:
        _scores.clear()
        _scores[name] = Seen(len(languages))
    seen = _scores[name]
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            words, places, owners, sizes = cut_words(batch.column("text").to_pylist())
            unseen = [x for x in words if x not in seen.row]
            if len(seen.row) + len(unseen) > REMEMBERED:
                seen = _scores[name] = Seen(len(languages))
                unseen = words
            for rows, lattice in pieces.lattices(unseen):
                seen.add([unseen[at] for at in rows.tolist()], np.log(forward(lattice, chances)[1]))
            count = batch.num_rows
            known = seen.values[[seen.row[word] for word in words]]
            sums = np.empty((count, len(languages)))
            for at in range(len(languages)):
                sums[:, at] = np.bincount(owners, known[places, at], count)
            letters = np.bincount(owners, sizes, count).astype(np.int64)
            total = shares + sums
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best, every = odds.argmax(axis=1), np.arange(count)
            scores = np.where(letters > 0, odds[every, best] / odds.sum(axis=1), 0.0)
            logs = np.where(letters > 0, sums[every, best], 0.0)
            predicted = np.where(letters > 0, np.array(languages, object)[best], UNDETERMINED)
            yield batch, predicted, scores, logs, letters


def _predicted(batches, path: str, model, name: str) -> Iterator[pa.RecordBatch]:
    for batch, predicted, scores, *_ in _judged(batches, path, model, name):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )


JUDGED = "_lang string, _score double, _log double, _letters long"


def _marked(batches, path: str, model, name: str) -> Iterator[pa.RecordBatch]:
    """The batches with the columns of JUDGED behind their own."""
    for batch, predicted, scores, logs, letters in _judged(batches, path, model, name):
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns, pa.array(predicted, pa.string()), pa.array(scores, pa.float64()),
                pa.array(logs, pa.float64()), pa.array(letters, pa.int64()),
            ],
            [*batch.schema.names, "_lang", "_score", "_log", "_letters"],
        )


def judged(docs: DataFrame, model: Model, path: str) -> DataFrame:
    """All rows and columns of ``docs`` with what the model makes of their texts: the language,
    its share, its logarithm of the whole text, and the letters that it has."""
    shared, name = _shared(docs.sparkSession, model)
    added = StructType.fromDDL(JUDGED).fields
    return map_arrow(
        docs, lambda batches: _marked(batches, path, shared, name), StructType([*docs.schema.fields, *added])
    )


def usual_rates(found: DataFrame) -> dict[str, float]:
    """The mean logarithm a letter that each language gives its own texts, one number each.

    It is taken over all rows of ``judged`` documents that may be learnt from and whose
    language is found.
    """
    rows = _learnt_from(found).filter("_lang = lang AND _letters > 0")
    means = rows.groupBy("lang").agg(F.avg(F.col("_log") / F.col("_letters")).alias("rate"))
    return {x.lang: x.rate for x in means.collect()}


def _shared(spark: SparkSession, model: Model) -> tuple:
    """The model for all tasks, and a name under which a worker may keep scores of words."""
    if model.handle is None:
        name = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        model.handle = spark.sparkContext.broadcast(model), name
    return model.handle


def accepted(
    docs: DataFrame,
    model: Model | None,
    path: str,
    least: float = 0.5,
    times: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` whose text is in a learnt language, with all their columns.

    Rejected are texts that are null or hold no letter, and those of which no language has
    a share of ``least``. With ``times``, so are texts that their language explains too badly
    to be in it: by less than so many times its usual logarithm a letter, which is a negative
    number. The rates that are usual come from all texts, so these are judged once and
    written with what was found. Without a model nothing is known, and every row stays.
    """
    if model is None:
        return docs
    found = judged(docs, model, path)
    kept = (F.col("_lang") != UNDETERMINED) & (F.col("_score") >= least)
    if times is not None:
        found = stored(found, "judged_texts")
        floors = [F.lit(x) for lang, rate in usual_rates(found).items() for x in (lang, times * rate)]
        if floors:
            floor = F.try_element_at(F.create_map(*floors), F.col("_lang"))
            explained = F.col("_log") >= floor * (F.col("_letters") + SHORT)
            kept = kept & F.coalesce(explained, F.lit(True))
    return found.filter(kept).select(*docs.columns)


def predict(docs: DataFrame, model: Model | None, path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score.

    ``score`` is the share of the predicted language among all learnt ones given the text.
    Texts that are null or hold no letter, and all texts without a model, are ``und`` with
    score 0. Repeated rows are scored each; a null doc_id counts as held out.
    """
    source = docs.select("doc_id", "text")
    if model is None:
        found = source.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        shared, name = _shared(docs.sparkSession, model)
        found = map_arrow(
            source, lambda batches: _predicted(batches, path, shared, name),
            "doc_id long, lang_pred string, score double",
        )
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
