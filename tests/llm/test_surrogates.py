"""Surrogates told apart over the whole table, and names wherever they stand."""

from __future__ import annotations

from pyspark.sql import functions as F

from routeloom.llm import pii


def texts(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def done(frame, key="k"):
    return {row.doc_id: row.text for row in pii.pseudonymized(frame, key).collect()}


def test_names_are_replaced_wherever_they_stand(spark):
    made = done(texts(spark, [
        (1, "Brown waited. Mr. Brown met Anna. Later Brown's friend saw Browning and Mr. John James Brown."),
        (2, "Brown bears like brown honey."),
        (3, "Dr. O'Neill-Lee spoke; O'Neill-Lee sat. Mr. Smith's car."),
    ]))
    first = made[1].split()
    name = first[0]
    assert name != "Brown" and "Brown " not in made[1] and "Brown." not in made[1] and "Brown'" not in made[1]
    assert made[1] == (
        f"{name} waited. Mr. {name} met Anna. Later {name}'s friend saw Browning and Mr. "
        f"{first[-3]} {first[-2]} {name}."
    )
    assert first[-3] in pii.NAMES[0] and first[-2] in pii.NAMES[0] and "John" != first[-3] and "James" != first[-2]
    assert made[2] == "Brown bears like brown honey."  # no title in that text
    spoken, sat = made[3].split("; ")
    other = spoken.split()[1]
    assert sat.startswith(f"{other} sat.") and other != "O'Neill-Lee" and made[3].endswith("'s car.")


def test_met_surrogates_are_drawn_again(spark):
    # as from a table in which two entities meet and one equals its surrogate
    pairs = spark.createDataFrame(
        [("name", "Qwert", "James"), ("name", "Peter", "James"), ("name", "Zorro", "Zorro"),
         ("name", "Adama", "Hokum"), ("ip", "10.0.0.1", "9.8.7.6"), ("ip", "10.0.0.01", "9.8.7.6")],
        "kind string, entity string, surrogate string",
    )
    assert {x.surrogate for x in pii.collisions(pairs).collect()} == {"James", "Zorro"}
    drawn = {x.entity: x.surrogate for x in pii.redrawn(pairs, "k").collect()}
    assert set(drawn) == {"Qwert", "Zorro"}
    assert len({*drawn.values(), "James", "Hokum", "9.8.7.6"}) == 5 and drawn["Zorro"] != "Zorro"
    assert pii.redrawn(pairs.filter("entity IN ('Adama', 'Peter')"), "k") is None


def test_nothing_to_move_ends(spark):
    pairs = spark.createDataFrame(
        [("secret", "token: ======", "token: ======")], "kind string, entity string, surrogate string"
    )
    drawn = pii.redrawn(pairs, "k")
    assert [x.surrogate for x in drawn.collect()] == ["token: ======"]


def test_texts_take_what_was_drawn_again(spark, monkeypatch):
    docs = texts(spark, [
        (1, "Write to ann@shop.org, bob@shop.org."), (1, "Write to ann@shop.org, bob@shop.org."),
        (2, "Only bob@shop.org."), (None, "ann@shop.org"), (4, None), (5, ""), (6, "clean"),
    ])
    others = spark.createDataFrame([("bob@shop.org", "else@where.example.org")], "entity string, surrogate string")
    plain = done(docs)
    monkeypatch.setattr(pii, "redrawn", lambda pairs, key: others)
    rows = pii.pseudonymized(docs, "k").collect()
    assert len(rows) == 7
    made = {row.doc_id: row.text for row in rows}
    assert made[2] == "Only else@where.example.org." and made[1].endswith("else@where.example.org.")
    assert made[1].split(",")[0] == plain[1].split(",")[0] and made[None] == plain[None]
    assert (made[4], made[5], made[6]) == (None, "", "clean")


def test_many_entities_stay_apart(spark):
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"),
        F.expr("concat('Mr. ', initcap(translate(cast(100 + id % 900 AS string), '0123456789', 'abcdefghij')), "
               "' from 10.0.', cast(id % 250 AS string), '.', cast(id div 250 AS string))").alias("text"),
    )
    pairs = pii.surrogates(docs, "k")
    others = pii.redrawn(pairs, "k")
    after = pairs if others is None else pairs.join(
        others.withColumnRenamed("surrogate", "again"), "entity", "left"
    ).select("kind", "entity", F.coalesce("again", "surrogate").alias("surrogate"))
    assert pairs.count() == 900 + 4_000 and pii.collisions(after).isEmpty()


def test_no_python_in_the_plan(spark):
    frame = pii.pseudonymized(texts(spark, [(1, "Mr. Brown, ann@shop.org")]), "k")
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
