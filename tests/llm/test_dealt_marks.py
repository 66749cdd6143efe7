"""Buckets of marks dealt one to a task."""

from __future__ import annotations

from routeloom.llm import ngram_join


def test_no_two_buckets_of_marks_meet_in_a_task(spark, monkeypatch):
    found, mapped = [], ngram_join.map_arrow

    def watched(frame, function, schema):
        if function is ngram_join._shared:
            found.append(frame.groupBy("bucket", ngram_join.F.spark_partition_id().alias("task")).count().collect())
        return mapped(frame, function, schema)

    monkeypatch.setattr(ngram_join, "map_arrow", watched)
    texts = [" ".join(f"w{at * 7 + step % 40}" for step in range(90)) for at in range(60)]
    docs = spark.createDataFrame([(at, x) for at, x in enumerate(texts + texts)], "doc_id long, text string")
    assert ngram_join.keep_first(docs, width=5, percent=80).count() == 60
    rows = [row for part in found for row in part]
    assert rows and len({row.task for row in rows}) == len({row.bucket for row in rows}) == len(rows)
