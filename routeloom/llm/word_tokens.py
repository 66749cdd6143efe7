"""Library tokenizers applied piece by piece, with pieces cut where no token can cross.

A tokenizer file that drops white space before it merges can be cut at any white space; one
that keeps it may be cut before a run of white space, since no token holds white space after
something else. A file that lowers texts and parts letters from digits and marks is also cut
between these, as far as ASCII goes, and gets its pieces lowered. A batch of texts is cut at
every such place; each distinct piece goes to the library once, in one call per batch, and its
result is remembered up to a bound, so the work follows the distinct pieces and not the text.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .common import remembers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Remembered pieces of one worker, and the longest piece that is remembered.
REMEMBERED, LONGEST = 400_000, 48


def byte_table(chars: str) -> np.ndarray:
    """For each byte whether it is one of some ASCII characters."""
    found = np.zeros(256, bool)
    found[[ord(x) for x in chars]] = True
    return found


def cut_texts(
    texts: pa.Array,
    starts: Callable[[np.ndarray], np.ndarray],
    change: Callable[[np.ndarray], np.ndarray] | None = None,
    dropped: np.ndarray | None = None,
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of a column of texts, the piece at each place, and text borders.

    ``starts`` says for the bytes of all texts in a row where a piece may start; a text
    always starts one. Pieces of text ``i`` are at places ``borders[i]:borders[i + 1]``.
    ``change`` may put other bytes in place of these first; the bytes of the table
    ``dropped`` then belong to no piece.
    """
    texts = pa.compute.fill_null(texts.cast(pa.string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    used = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    ends = ends - ends[0]
    first = starts(used)
    first[ends[:-1][ends[:-1] < len(used)]] = True
    if change is not None:
        used = change(used)
    if dropped is not None:
        kept = ~dropped[used]
        ends = np.r_[0, np.cumsum(kept, dtype=np.int32)][ends]
        used, first = used[kept], first[kept]
    places = np.flatnonzero(first)
    offsets = np.append(places, len(used)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(used.tobytes()))
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.searchsorted(places, ends)


_WHITE = byte_table(" \t\r\n")


def _words(data: np.ndarray) -> np.ndarray:
    white = _WHITE[data]
    return ~white & np.r_[True, white[:-1]] if len(data) else white


def _led(data: np.ndarray) -> np.ndarray:
    white = _WHITE[data]
    return white & ~np.r_[True, white[:-1]] if len(data) else white


def _spaced(data: np.ndarray) -> np.ndarray:
    white = data == 32
    return white & ~np.r_[True, white[:-1]] if len(data) else white


# Letters, runs of one digit and runs of marks are merged apart; an apostrophe may begin what
# letters go on, and "<|" an added token, which nothing before it changes.
_PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _CAPITAL, _SMALL = 1, byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), byte_table("abcdefghijklmnopqrstuvwxyz")
# 1 for letters, 2 for digits, 3 for marks, 0 beyond ASCII
_CLASS = np.where(np.arange(256) < 128, 3, 0).astype(np.uint8)
_CLASS[_CAPITAL | _SMALL] = _LETTER
_CLASS[byte_table("0123456789")] = 2


def _guarded(data: np.ndarray) -> np.ndarray | None:
    """Bytes in a word with "<|", if any: they stay as they are and together."""
    opened = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    if not len(opened):
        return None
    word = np.cumsum(_words(data))
    return np.isin(word, word[opened])


def _parts(data: np.ndarray) -> np.ndarray:
    """Starts of words, and within them of other classes of ASCII characters."""
    first = _words(data)
    if len(data) > 1:
        kind = _CLASS[data]
        turns = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        turns &= (data[:-1] != ord("'")) | (kind[1:] != _LETTER)
        guarded = _guarded(data)
        first[1:] |= turns if guarded is None else turns & ~guarded[1:]
    return first


def _lowered(data: np.ndarray) -> np.ndarray:
    """Capital ASCII letters lowered, unless a byte beyond ASCII follows, which may join them."""
    capital = _CAPITAL[data]
    capital[:-1] &= data[1:] < 128
    guarded = _guarded(data)
    if guarded is not None:
        capital &= ~guarded
    return data + np.uint8(32) * capital


class PieceEncoder:
    """Token ids of texts by the library for ``path``: tokenizers or sentencepiece."""

    def __init__(self, path: str, keep: Callable[[list[int]], object]):
        self.keep, self.seen, self.parts_marks = keep, {}, False
        self.prepare = lambda piece, first: piece
        self.change = self.dropped = None
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            plan = _settings(tokenizer.pre_tokenizer)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.starts = _led
            if _lowers_and_parts(tokenizer):
                self.starts, self.change, self.dropped = _parts, _lowered, _WHITE
            elif _drops_white_space(plan):
                self.starts = _words
                self.prepare = lambda piece, first: piece.strip(" \t\r\n")
                self.parts_marks = len(tokenizer.pre_tokenizer.pre_tokenize_str("ab,")) == 2
            self.encode = lambda parts: [
                x.ids for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            ]
            if self.change is not None:
                self.encode = _by_model(tokenizer, self.encode)
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.starts = _spaced
            self.prepare = lambda piece, first: piece if first or not piece.startswith(" ") else piece[1:]
            # an empty part is a white space that ends its text: one id in the library
            lone = [model.piece_to_id("▁")]
            self.encode = lambda parts: [
                ids if part else lone for part, ids in zip(parts, model.encode(parts, num_threads=1))
            ]

    def learn(self, parts: list[str]) -> list:
        """What ``keep`` makes of the ids of each part."""
        seen = self.seen
        needed = dict.fromkeys(x for x in parts if x not in seen)
        marked = [x for x in needed if self._marked(x)] if self.parts_marks else []
        for x in marked:
            del needed[x]
        needed |= dict.fromkeys(y for x in marked for y in (x[:-1], x[-1]) if y not in seen)
        unseen = list(needed)
        if len(seen) + len(unseen) + len(marked) > REMEMBERED:
            found = {x: seen[x] for x in parts if x in seen}
            found |= {y: seen[y] for x in marked for y in (x[:-1], x[-1]) if y in seen}
            seen.clear()
            seen.update(found)
        if unseen:
            seen.update(zip(unseen, map(self.keep, self.encode(unseen))))
        for x in marked:
            seen[x] = seen[x[:-1]] + seen[x[-1]]
        found = [seen[x] for x in parts]
        for x in unseen:
            if len(x) > LONGEST:
                del seen[x]
        return found

    def _marked(self, part: str) -> bool:
        """A word and one mark after it, which a tokenizer that parts them takes apart."""
        return self.parts_marks and part[-1:] in (",", ".") and part[:-1].isalpha()

    def pieces(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """What ``keep`` made of each distinct piece, the piece at each place, text borders."""
        distinct, places, borders = cut_texts(texts, self.starts, self.change, self.dropped)
        if self.change is not None:  # the pieces are as they go to the library
            return self.learn(distinct), places, borders
        made = self.learn([self.prepare(x, False) for x in distinct])
        starts = borders[:-1][borders[:-1] < borders[1:]]
        odd = [at for at in starts if self.prepare(distinct[places[at]], True) != self.prepare(distinct[places[at]], False)]
        if odd:
            own = self.learn([self.prepare(distinct[places[at]], True) for at in odd])
            places = places.copy()
            for at, value in zip(odd, own):
                places[at] = len(made)
                made.append(value)
        return made, places, borders


# Letters that are composed and small as they are, and not followed by what joins them.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _by_model(tokenizer, encode: Callable[[list[str]], list]) -> Callable[[list[str]], list]:
    """``encode`` that gives plain letters to the model itself, as nothing before it changes them
    but for the names of their bytes."""
    merged, named = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
    names = {at: named(chr(at))[0][0] for at in range(0xDF, 0x100) if _PLAIN.fullmatch(chr(at))}

    def encoded(parts: list[str]) -> list:
        plain = list(map(_PLAIN.fullmatch, parts))
        others = iter(encode([x for x, known in zip(parts, plain) if not known]))
        return [
            [y.id for y in merged(x if x.isascii() else x.translate(names))] if known else next(others)
            for x, known in zip(parts, plain)
        ]

    return encoded


def _drops_white_space(plan: dict) -> bool:
    """Whether a pre-tokenizer keeps only matches that hold no white space."""
    steps = plan.get("pretokenizers", [plan])
    first = steps[0] if steps else {}
    pattern = first.get("pattern", {}).get("Regex", " ")
    kept_white = " " in pattern or r"\s+" in pattern or r"\s*" in pattern
    return (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and not kept_white
    ) or first.get("type") in ("Whitespace", "WhitespaceSplit")


def _settings(step) -> dict:
    """What a tokenizer file says of a step, without reading its vocabulary again."""
    return json.loads(step.__getstate__()) if step is not None else {}


def _lowers_and_parts(tokenizer) -> bool:
    """Whether a tokenizer composes and lowers texts and merges the matches of ``_PARTED``."""
    normal, parts = _settings(tokenizer.normalizer), _settings(tokenizer.pre_tokenizer)
    lowering = normal.get("normalizers", [])
    first, *later = parts.get("pretokenizers") or [{}]
    return (
        [x.get("type") for x in lowering] == ["NFC", "Replace", "Lowercase"]
        and lowering[1].get("pattern") == {"Regex": r"\s+"} and lowering[1].get("content") == " "
        and first.get("type") == "Split" and first.get("pattern") == {"Regex": _PARTED}
        and first.get("behavior") == "Removed" and first.get("invert") is True
        and [(x.get("type"), x.get("add_prefix_space"), x.get("use_regex")) for x in later] == [("ByteLevel", False, False)]
        and all(
            x.content.startswith("<|") and not (x.lstrip or x.rstrip or x.single_word or x.normalized)
            and not any(y.isspace() for y in x.content)
            for x in tokenizer.get_added_tokens_decoder().values()
        )
    )


_encoders: dict[tuple, PieceEncoder] = {}
remembers(
    lambda: [encoder.seen.clear() for encoder in _encoders.values()],
    *[f"{__package__}.{name}" for name in ("packing", "token_counts", "piece_merges")],
)


def encoder(path: str, kind: str) -> PieceEncoder:
    """The worker's encoder for a file: ``lengths``, or ``ids`` as little-endian bytes."""
    if (path, kind) not in _encoders:
        keep = len if kind == "lengths" else lambda ids: struct.pack(f"<{len(ids)}I", *ids)
        _encoders[path, kind] = PieceEncoder(path, keep)
    return _encoders[path, kind]


def sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of the values between consecutive borders."""
    total = np.r_[0, np.cumsum(values)]
    return total[borders[1:]] - total[borders[:-1]]
