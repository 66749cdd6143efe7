"""Pages that keep their article, IBANs that hold, names of several parts, and the whole pipeline."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from routeloom.llm import html_text, pii

TEXT = "The council met on Monday to speak about the new bridge across the river. " * 4


def main_text(html):
    return html_text.Tree(html).text({})


@pytest.mark.parametrize("page", [
    '<body><div class="content has-sidebar"><article><p>{}</p></article></div></body>',
    '<body><div class="page no-sidebar"><p>{}</p></div><div class="sidebar"><p>Links</p></div></body>',
    '<body><article class="post hentry category-legal"><p>{}</p></article></body>',
    '<body><form id="aspnetForm"><div><p>{}</p></div></form></body>',
    '<body><div class="layout-with-header header"><p>{}</p></div><footer>f</footer></body>',
    '<body><div class="comments-page"><article><p>{}</p></article></div></body>',
])
def test_articles_stay(page):
    assert main_text(page.format(TEXT)) == TEXT.strip()


def test_headlines_stay_and_boilerplate_goes():
    page = (
        '<body><header class="site-header">Site</header><article><header class="entry-header"><h1>Bridge</h1></header>'
        f'<p>{TEXT}</p><div class="social-share">Share</div></article><div class="sidebar widget">More</div>'
        f'<form><input>Search</form><div id="comments"><p>{TEXT * 3}</p></div></body>'
    )
    assert main_text(page) == f"Bridge\n{TEXT.strip()}"


def surrogate(spark, entities, key="k"):
    frame = spark.createDataFrame([(x,) for x in entities], "text string")
    return {x.entity: x.surrogate for x in pii.surrogates(frame, key).collect()}


def valid(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(x, 36)) for x in plain[4:] + plain[:4])) % 97 == 1


def test_ibans_hold_as_they_did(spark):
    good = ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "FR1420041010050500013M02606"]
    wrong = ["DE88 3704 0044 0532 0130 00", "GB30NWBK60161331926819"]
    found = surrogate(spark, good + wrong)
    assert all(valid(x) for x in good) and not any(valid(x) for x in wrong)
    for x in good + wrong:
        made = found[x]
        assert made != x and made[:2] == x[:2] and len(made) == len(x) and valid(made) == (x in good)
        assert [at for at, c in enumerate(made) if c == " "] == [at for at, c in enumerate(x) if c == " "]
    assert len(set(found.values())) == len(found)


def test_names_of_several_parts_and_other_letters(spark):
    text = "Mr. John James Smith met Mrs. Łucja Żółć-Nowak."
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    made = [pii.pseudonymized(frame, key).first().text for key in ("k", "l", "m")]
    for at, word in enumerate(text.replace("-", " ").split()):
        moved = word[0].isupper() and word not in ("Mr.", "Mrs.")
        assert all((x.replace("-", " ").split()[at] != word) == moved for x in made)
    assert len({x.split("Mrs. ")[1][0] for x in made}) > 1  # the first letter moves, too


def write_tables(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, chunk string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_end_to_end(spark, tmp_path):
    """Planted foreign, toxic, near-copied and personal texts among ordinary ones of the tables."""
    data = "/root/testdata/sf0.01"  # enough labels to learn from
    base = spark.read.parquet(f"{data}/documents.parquet").filter("length(text) > 400").collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").filter("toxic = 1").collect()}
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "c") for r in base]
    long = [r for r in base if r.doc_id not in toxic and r.lang == "en" and len(r.text.split()) > 200]
    clean = long[0]
    copy = " ".join([*clean.text.split()[:-1], "changed"])
    planted = [
        (10_001, "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar " * 5, None, "s", 1, None),
        (10_002, "すべての人間は生まれながらにして自由であり" * 5, None, "s", 1, None),
        (10_003, "12345 !!! 678", None, "s", 1, None),
        (10_004, copy, "en", "s", 1, None),
        (10_005, copy, "en", "s", 1, None),
        *[
            (10_010 + at, f"{' '.join(x.text.split()[::-1])} write to jane.doe@mail.com", "en", "s", 1, None)
            for at, x in enumerate(long[1:9])
        ],
        (10_007, None, None, None, None, None),
    ]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{data}/labels.parquet").collect()]
    write_tables(spark, tmp_path, docs + planted, labels)
    kept, frame = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stored(stage(spark, frame, str(tmp_path)), name.replace(" ", "_"))
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
        if name != "packing":
            assert frame.columns == columns
        if name == "PII":
            assert not frame.filter("text LIKE '%jane.doe@mail.com%'").count()
            assert frame.filter("doc_id >= 10010 AND text LIKE '%@%'").count() >= 5
    usual = {r.doc_id for r in base}
    assert not kept["language ID"] & {10_001, 10_002, 10_003, 10_007}
    assert len(usual - kept["language ID"]) <= 0.02 * len(usual) and {10_004, *range(10_010, 10_018)} <= kept["language ID"]
    gone = kept["language ID"] - kept["toxicity"]
    assert len(gone - toxic) <= 0.05 * len(usual) and len(gone & toxic) >= 0.3 * len(toxic & usual)
    if clean.doc_id in kept["toxicity"]:
        assert not kept["n-gram Jaccard join"] & {10_004, 10_005}
    assert kept["packing"] == kept["PII"] == kept["n-gram Jaccard join"]
    whole = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "length").collect()))
    assert whole == sorted(map(str, frame.select("doc_id", "length").collect()))


def test_pipeline_of_nothing(spark, tmp_path):
    write_tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
