import pytest
from pyspark.sql import functions as F

from routeloom.functions.fingerprint import row_fingerprint
from routeloom.operators import ordering
from routeloom.operators.compare import require_same
from routeloom.operators.ordering import (
    file_offsets,
    prefix,
    row_total,
    sort_table,
    with_position,
    write_ordered,
)
from routeloom.plans import clean as cleaning
from routeloom.plans.samples import target_rows
from routeloom.schemas import SAMPLE_ORDER
from routeloom.sources.adapters import flights


@pytest.fixture
def wide(spark):
    """Adaptive execution would fold tiny sort tasks into one; keep them apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def sorted_table(spark, data, tmp_path_factory):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = tmp_path_factory.mktemp("sorted")
    source, path = str(folder / "clean"), str(folder / "sorted")
    cleaning.clean(flights(spark, data)).write.parquet(source)
    sort_table(spark, source, SAMPLE_ORDER, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return source, path


def limit_form(spark, source, rows):
    """The plain form: sort everything, take the first rows."""
    table = spark.read.parquet(source)
    keys = [F.col(name).asc_nulls_last() for name in SAMPLE_ORDER]
    return table.orderBy(*keys, row_fingerprint(table.columns)).limit(rows)


@pytest.mark.parametrize("rows", [0, 1, 700, 2861, 5722, 5723, 9999])
def test_prefix_equals_sort_and_limit(spark, sorted_table, rows):
    source, path = sorted_table
    cut = prefix(spark, path, rows)
    assert cut.count() == min(rows, row_total(spark, path))
    require_same(cut, limit_form(spark, source, rows))


def test_prefix_reads_only_the_files_it_needs(spark, sorted_table):
    _, path = sorted_table
    files = file_offsets(spark, path).orderBy("offset").collect()
    assert len(files) == 8
    assert [f.offset for f in files] == [sum(g.rows for g in files[:at]) for at in range(8)]
    cut = prefix(spark, path, files[2].offset + 5)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    try:  # now every file read is a scan task of its own
        tasks = cut._jdf.queryExecution().toRdd().getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks == 3


def test_many_copies_of_one_row_are_spread(spark, tmp_path, wide):
    """A third of all rows is one row; it must not end up in one sort task."""
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    numbers = spark.range(30_000, numPartitions=8)
    table = numbers.select(
        F.when(F.col("id") % 3 == 0, F.lit(15_000)).otherwise(F.col("id")).alias("v"),
        F.lit("x").alias("w"),
    )
    table.write.parquet(source)
    sort_table(spark, source, ["v"], path)
    files = file_offsets(spark, path).collect()
    assert max(f.rows for f in files) < 8_000
    positions = with_position(spark, path).orderBy("position").select("v", "position").collect()
    assert [p.position for p in positions] == list(range(1, 30_001))
    values = [p.v for p in positions]
    assert values == sorted(values)
    assert prefix(spark, path, 15_000).count() == 15_000


def test_large_tables_get_more_sort_tasks(spark, sorted_table, tmp_path, monkeypatch):
    source, path = sorted_table
    monkeypatch.setattr(ordering, "SORT_TASK_BYTES", ordering.table_bytes(spark.read.parquet(source)) // 12 + 1)
    sort_table(spark, source, SAMPLE_ORDER, str(tmp_path / "t"))
    assert file_offsets(spark, str(tmp_path / "t")).count() == 12
    places = [with_position(spark, p) for p in (path, str(tmp_path / "t"))]
    require_same(*places)


def test_nulls_come_last(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(None,), (2,), (1,), (None,)], "v int")
    write_ordered(table, ["v"], path)
    found = {r.position: r.v for r in with_position(spark, path).collect()}
    assert found == {1: 1, 2: 2, 3: None, 4: None}


def test_expressions_as_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    write_ordered(spark.range(5), [-F.col("id")], path)
    found = {r.position: r.id for r in with_position(spark, path).collect()}
    assert found == {1: 4, 2: 3, 3: 2, 4: 1, 5: 0}


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_ordered(spark.range(0), ["id"], path)
    assert with_position(spark, path).count() == 0
    assert prefix(spark, path, 3).count() == 0


def test_prefix_has_no_more_groups_than_the_whole(spark, sorted_table):
    _, path = sorted_table
    groups = [
        prefix(spark, path, rows).select("op_unique_carrier", "route").distinct().count()
        for rows in (500, 2000, 5000, 5723)
    ]
    assert groups == sorted(groups)


def test_sample_sizes():
    assert [target_rows(s, 7_061_582) for s in ("100k", "500k", "half", "full")] == [
        100_000, 500_000, 3_530_791, 7_061_582,
    ]


def test_fingerprint_by_hand(spark):
    import hashlib

    row = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    text = "1||__NULL__||2.5"
    assert row.select(row_fingerprint(row.columns)).first()[0] == (
        hashlib.sha256(text.encode()).hexdigest()
    )
