"""Models from all texts."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
import pytest

from routeloom.llm import language

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_languages_and_usual_rates_come_from_all_texts(spark, monkeypatch):
    texts = {"en": "the council met on monday", "de": "der rat traf sich am montag"}
    docs = [(at, f"{texts[lang]} {at:b}", lang) for at in range(1_800) for lang in texts]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    frames, write = {}, language.stored
    monkeypatch.setattr(language, "stored", lambda x, label: frames.setdefault(label, write(x, label)))
    learnt = [x for x in docs if crc32(str(x[0]).encode()) % 4 != 2]
    model = language.learn(frame, PIECES)
    counted = frames["language_words"].groupBy().sum("n0", "n1").first()
    assert tuple(counted) == tuple(
        sum(len(language.words_of(x[1])) for x in learnt if x[2] == lang) for lang in model.languages
    )
    kept = language.accepted(frame, model, PIECES, times=language.FOREIGN)
    assert kept.columns == frame.columns and kept.count() == len(docs)
    rows = frames["judged_texts"].toPandas()
    rows = rows[rows.doc_id.isin({x[0] for x in learnt}) & (rows.lang == rows._lang)]
    means = (rows._log / rows._letters).groupby(rows.lang).mean().to_dict()
    assert language.usual_rates(frames["judged_texts"]) == pytest.approx(means)
