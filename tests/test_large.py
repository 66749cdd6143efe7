"""Work that larger tables need less of: one parting, one fingerprint, replicas side by side."""

from __future__ import annotations

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from routeloom.jobs import clean as clean_job
from routeloom.operators import ordering
from routeloom.plans import samples
from routeloom.registry import queries
from routeloom.sources import adapters
from routeloom.sources.files import read_csv, read_parquet
from routeloom.schemas import CLEAN_SCHEMA


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_two_headers_are_parted_before_the_joins(spark, data, monkeypatch):
    written, write = [], queries.write_raw_csv
    monkeypatch.setattr(queries, "write_raw_csv", lambda rows, *a: (written.append(rows), write(rows, *a)))
    rows = queries.scan_csv(spark, data)
    assert rows.count() == adapters.flights(spark, data).count() == sum(x.count() for x in written)
    assert all(x.count() for x in written)
    for frame in written:
        lines = [x for x in optimized(frame).splitlines() if "xxhash64" in x]
        assert lines and all("l_partkey" in x and "name" not in x for x in lines)


def test_order_lines_are_not_shuffled_for_suppliers(spark, data):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        plan = adapters.flights(spark, data)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_suppkey" not in plan


def test_replicas_are_written_side_by_side(spark, tmp_path, monkeypatch):
    source, meet, write = str(tmp_path / "source"), Barrier(3), samples.write_parquet
    spark.range(100).write.parquet(source)

    def together(table, path):
        meet.wait(30)
        write(table, path)

    monkeypatch.setattr(samples, "write_parquet", together)
    made = samples.write_replicas(spark, source, str(tmp_path / "scaled"))
    assert [(x["scale"], x["rows"]) for x in made] == [("1x", 100), ("2x", 200), ("4x", 400)]
    assert [read_parquet(spark, x["output"]).count() for x in made] == [100, 200, 400]


@pytest.fixture
def rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame = spark.range(4_000).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("a"), (F.col("id") % 900).alias("b")
    )
    frame.unionByName(frame.limit(700)).write.parquet(path)
    return path


def test_fingerprints_are_computed_after_the_shuffle(spark, rows, tmp_path, monkeypatch):
    """Many ties either way: the order is the same, and only where many rows tie are prints keys."""
    given, write = [], ordering.write_ordered
    monkeypatch.setattr(
        ordering, "write_ordered", lambda t, order, *a, **k: (given.append((len(order), "ties" in k)), write(t, order, *a, **k))
    )
    ordering.sort_table(spark, rows, ["a"], str(tmp_path / "few"))
    monkeypatch.setattr(ordering, "ALIKE_ROWS", 0)
    ordering.sort_table(spark, rows, ["a"], str(tmp_path / "many"))
    assert given == [(1, True), (3, False)]
    few, many = (
        [tuple(x) for x in ordering.with_position(spark, str(tmp_path / x)).orderBy("position").collect()]
        for x in ("few", "many")
    )
    assert few == many and [x[2] for x in few] == list(range(1, 4_701))
    for size in (0, 1, 587, 588, 2_350, 4_699, 4_700, 9_000):
        cut = ordering.prefix(spark, str(tmp_path / "few"), size)
        assert sorted(map(str, cut.collect())) == sorted(str(x[:2]).replace("(", "Row(a=").replace(", ", ", b=") for x in few[:size])


def test_rows_of_whole_files_meet_no_condition(spark, tmp_path):
    path = str(tmp_path / "sorted")
    ordering.write_ordered(spark.range(1_000), ["id"], path)
    known = ordering.offset_rows(spark, path)
    assert "Filter" not in optimized(ordering.prefix(spark, path, known[2]["offset"], known))
    assert ordering.prefix(spark, path, known[2]["offset"] + 3, known).agg(F.max("id")).first()[0] == known[2]["offset"] + 2


def test_text_copy_of_the_clean_table_is_packed(spark, data, tmp_path):
    raw, out, text = (str(tmp_path / x) for x in ("raw", "clean", "text"))
    adapters.write_faulty_csv(spark, data, raw)
    clean_job.run(spark, raw, out, text)
    files = [x.name for x in (tmp_path / "text").rglob("part-*")]
    assert files and all(x.endswith(".csv.gz") for x in files)
    kept = read_parquet(spark, out)
    assert not kept.exceptAll(read_csv(spark, text, CLEAN_SCHEMA)).count() and kept.count() == read_csv(spark, text, CLEAN_SCHEMA).count()
    clean_job.run(spark, raw, out, text, "none")
    assert read_csv(spark, text, CLEAN_SCHEMA).count() == kept.count()
