"""SentencePiece merges: encoding by an agenda of adjacent symbol pairs, and decoding.

A text is one symbol per character, white space shown as U+2581 with one put in front. The
agenda holds every adjacent pair whose concatenation is a piece, best score first, then
leftmost; the top pair is merged and its new neighbours join the agenda until none is left.
Symbols that are no piece become the bytes they consist of.

No piece holds U+2581 after another character and line breaks are bytes, so merges never
cross the places before U+2581 and around a line break, nor any place between two characters
that stand side by side in no piece. Texts are cut there; each distinct part is encoded once
per worker, up to a bound, and checked against the library, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from .common import map_arrow, pieces_of
from .word_tokens import cut_texts

SPACE = "\u2581"
REMEMBERED, LONGEST, BATCH_BYTES = 600_000, 48, 8_000_000


def _starts(data: np.ndarray) -> np.ndarray:
    """Before white space (spaces, and U+2581 itself) after anything else; around line breaks."""
    if not len(data):
        return np.zeros(0, bool)
    white = data == 32
    for at in np.flatnonzero(data[:-2] == 0xE2) if len(data) > 2 else ():
        if data[at + 1] == 0x96 and data[at + 2] == 0x81:
            white[at : at + 3] = True
    breaks = data == 10
    return (white & ~np.r_[True, white[:-1]]) | breaks | np.r_[False, breaks[:-1]]


class MergeModel:
    """Pieces and scores of a merge-type model file."""

    def __init__(self, path: str):
        self.library = SentencePieceProcessor(model_file=path)
        self.ids, self.scores, self.bytes, self.surface = {}, {}, {}, {}
        for at in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(at)
            if self.library.is_byte(at):
                self.bytes[int(piece[3:5], 16)] = at
                self.surface[at] = bytes([int(piece[3:5], 16)])
            elif not self.library.is_control(at) and not self.library.is_unknown(at):
                self.ids[piece], self.scores[piece] = at, self.library.get_score(at)
                self.surface[at] = piece.replace(SPACE, " ").encode()
        self.unknown = self.library.unk_id()
        self.pairs = {piece[at : at + 2] for piece in self.ids for at in range(len(piece) - 1)}
        self.seen: dict[str, tuple[str, str]] = {}

    def merge(self, text: str) -> list[int]:
        """Ids of a piece of text in which white space is already U+2581."""
        symbols = list(text)
        count = len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        scores = self.scores
        agenda = []
        for at in range(count - 1):
            pair = symbols[at] + symbols[at + 1]
            if pair in scores:
                agenda.append((-scores[pair], at, pair))
        heapify(agenda)
        while agenda:
            _, at, pair = heappop(agenda)
            right = after[at]
            if symbols[at] is None or right >= count or symbols[at] + symbols[right] != pair:
                continue
            symbols[at], symbols[right] = pair, None
            after[at] = beyond = after[right]
            if beyond < count:
                before[beyond] = at
                wider = pair + symbols[beyond]
                if wider in scores:
                    heappush(agenda, (-scores[wider], at, wider))
            if (left := before[at]) >= 0:
                wider = symbols[left] + pair
                if wider in scores:
                    heappush(agenda, (-scores[wider], left, wider))
        ids: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            known = self.ids.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids += [self.bytes[x] for x in symbol.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def unmerge(self, ids: list[int]) -> str:
        """The text of ids, white space shown as spaces, the one in front still there."""
        return b"".join(self.surface.get(x, b" \xe2\x81\x87 ") for x in ids).decode(errors="replace")

    def by_library(self, parts: list[str]) -> list[list[int]]:
        """The library's ids for pieces of text, each seen as in the middle of a text."""
        led = [x.startswith(SPACE) for x in parts]
        texts = [x[1:] if own else "\n" + x for x, own in zip(parts, led)]
        found = self.library.encode(texts, num_threads=1)
        # an empty text has no ids at all, not even that of the white space in front
        return [
            (ids if part != SPACE else [self.ids[SPACE]]) if own else ids[2:]
            for ids, own, part in zip(found, led, parts)
        ]

    def learn(self, parts: list[str]) -> list[tuple[str, str]]:
        """Ids, joined by commas, and decoded text of each part; known parts are looked up."""
        seen = self.seen
        split = {x: self._split(x) for x in parts if x not in seen}
        unseen = list(dict.fromkeys(y for ys in split.values() for y in ys if y not in seen))
        if len(seen) + len(unseen) > REMEMBERED:
            kept = dict.fromkeys([*parts, *(y for ys in split.values() for y in ys)])
            kept = {x: seen[x] for x in kept if x in seen}
            seen.clear()
            seen.update(kept)
        for part, checked in zip(unseen, self.by_library(unseen)):
            ids = self.merge(part)
            if ids != checked:
                raise ValueError(f"merges differ from the library's on {part[:80]!r}")
            seen[part] = (",".join(map(str, ids)), self.unmerge(ids))
        found = []
        for x in parts:
            ys = split.get(x, (x,))
            both = [seen[y] for y in ys]
            found.append(
                both[0] if len(ys) == 1 else (",".join([y[0] for y in both]), "".join([y[1] for y in both]))
            )
        for part in unseen:
            if len(part) > LONGEST:
                del seen[part]
        return found

    def _split(self, part: str) -> list[str]:
        """The part cut between characters that stand side by side in no piece."""
        pairs, cuts, low = self.pairs, [], 0
        for at in range(1, len(part)):
            if part[at - 1 : at + 1] not in pairs:
                cuts.append(part[low:at])
                low = at
        cuts.append(part[low:])
        return cuts

    def encode(self, text: str | None) -> list[int]:
        parts = self._split(SPACE + text.replace(" ", SPACE)) if text else []
        return [at for part in parts for at in self.merge(part)]

    def decode(self, ids: list[int]) -> str:
        text = self.unmerge(ids)
        return text[1:] if text.startswith(" ") else text


_models: dict[str, MergeModel] = {}


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = _models.get(path) or _models.setdefault(path, MergeModel(path))
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            distinct, places, borders = cut_texts(batch.column("text"), _starts)
            made = model.learn([x.replace(" ", SPACE) for x in distinct])
            heads = borders[:-1][borders[:-1] < borders[1:]]
            # the white space put in front of a text belongs to its first part
            made += model.learn([SPACE + distinct[places[at]].replace(" ", SPACE) for at in heads])
            places = places.copy()
            places[heads] = np.arange(len(distinct), len(made))
            rows = []
            for low, high in zip(borders[:-1].tolist(), borders[1:].tolist()):
                both = [made[at] for at in places[low:high].tolist()]
                ids = ",".join([x[0] for x in both])
                text = "".join([x[1] for x in both]).removeprefix(" ")
                rows.append(
                    (
                        ids.count(",") + 1 if ids else 0,
                        sha256(ids.encode()).hexdigest(),
                        sha256(text.encode()).hexdigest(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in rows], pa.int64()),
                    pa.array([x[1] for x in rows], pa.string()),
                    pa.array([x[2] for x in rows], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ids counted and hashed, text decoded and hashed.

    ``path`` names a merge-type model file that every worker can read. Texts are encoded
    without begin or end ids and without sampling, then decoded again. Null and empty texts
    have no ids and decode to the empty text. Repeated rows are encoded each; a null doc_id
    stays null; other columns are ignored. A vocabulary the merges cannot reproduce ends
    the job with an error.
    """
    return map_arrow(
        docs.select("doc_id", "text"), lambda batches: _encoded(batches, path),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
