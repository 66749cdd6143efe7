"""Work that follows distinct words and existing pieces, with the results of the plain way."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from routeloom.llm import language, word_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "́", "́a", "á ́b", "1́x", "x" * 33, "y" * 97 + "́", "İSTANBUL ΟΔΟΣ Σ",
    "\0a\0", "漢字かな 한국어", "\U0001d400\U00010400ab", "á" * 20, "Don't we'll 12ab34 don't", "\U000e0100a",
]


def test_words_are_cut_for_all_texts_at_once():
    def plain(text):
        found = regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower())
        return [x[at : at + 32] for x in found for at in range(0, len(x), 32)]

    words, places, owners, sizes = language.cut_words(ODD)
    assert len(words) == len(set(words)) and [len(words[at]) for at in places] == sizes.tolist()
    for at, text in enumerate(ODD):
        assert [words[x] for x in places[owners == at]] == plain(text) == language.words_of(text)
    assert language.cut_words([])[0] == []


def test_lattices_hold_only_what_the_vocabulary_has():
    pieces = language.vocabulary(PIECES)
    words = sorted({x for text in ODD for x in language.words_of(text)} | {"incomprehensibilities", "then"})
    ((rows, lattice),) = pieces.lattices(words)
    assert rows.tolist() == [*range(len(words))]
    found = {
        (int(np.searchsorted(lattice.first, end, "right")) - 1, end - size, end, piece)
        for size, ends, kinds, _ in lattice.edges for end, piece in zip(ends.tolist(), kinds.tolist())
    }
    wanted = set()
    for at, (word, first) in enumerate(zip(words, lattice.first.tolist())):
        text = language.SPACE + word
        for low in range(len(text)):
            for high in range(low + 1, len(text) + 1):
                piece = pieces.place.get(text[low:high], len(pieces.place) if high == low + 1 else None)
                if piece is not None:
                    wanted.add((at, first + low, first + high, piece))
    assert found == wanted and sum(len(ends) for _, ends, _, _ in lattice.edges) == len(wanted)


def test_expected_pieces_cover_every_word():
    pieces = language.vocabulary(PIECES)
    words, rng = ["then", "straße", "漢字", "incomprehensibilities"], np.random.default_rng(1)
    chances = rng.random((len(pieces.place) + 2, 2))
    chances[-1] = 0
    counts = np.array([[1.0, 0.0], [2.0, 3.0], [0.0, 4.0], [5.0, 1.0]])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(words), pa.array(counts[:, 0]), pa.array(counts[:, 1])], ["word", "n0", "n1"]
    )
    (found,) = language._expected(iter([batch]), PIECES, SimpleNamespace(value=chances), ["a", "b"])
    sizes = np.array([*map(len, sorted(pieces.place)), 1])
    covered = np.zeros(2)
    for piece, at, expected in zip(*(x.to_pylist() for x in found.columns)):
        covered[at] += sizes[piece] * expected
    assert np.allclose(covered, counts.T @ [len(x) + 1 for x in words])


def test_words_that_differ_in_case_or_marks_are_encoded_once():
    tool = word_tokens.PieceEncoder(WORDS, len)
    tool.pieces(pa.array(["Word WORD word,", "(word) straße, Straße. word"]))
    assert set(tool.seen) == {"word", "straße", ",", ".", "(", ")"}


def test_finer_cuts_keep_the_ids_of_the_library():
    atoms = [
        *"aBJIKs'1,-<| \n\t\x0b\x85éÉßİΣKÅ;`漢ﬁ_²٣", "\0", "\u0301", "\u030c", "\u0307", "\u0338", "\xa0",
        "'s", "'LL", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "Hello", "\u2028", "\U0001d400", " ", " ",
    ]
    rng = np.random.default_rng(3)
    texts = [*ODD, "  a ", "A", "\u030c", "a<", "|b", *("".join(rng.choice(atoms, rng.integers(0, 20))) for _ in range(5_000))]
    library = Tokenizer.from_file(WORDS).encode_batch_fast([x or "" for x in texts], add_special_tokens=False)
    tool = word_tokens.PieceEncoder(WORDS, list)
    column = pa.array(["x", *texts], pa.string())[1:]
    made, places, borders = tool.pieces(column)
    for at, own in enumerate(library):
        assert [y for x in places[borders[at] : borders[at + 1]] for y in made[x]] == own.ids
    assert tool.pieces(column[:0])[1:][0].tolist() == []
