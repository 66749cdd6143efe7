"""Published outputs: whichever step a writer stops at, readers find a whole version."""

from __future__ import annotations

import pytest

from routeloom.operators.quality import GateFailed
from routeloom.sinks.files import publish_csv, publish_parquet, write_checked
from routeloom.sinks.tables import create_table_as
from routeloom.sources import published as module
from routeloom.sources.files import read_parquet
from routeloom.sources.published import Folder, publish, published


class Stopped(Exception):
    pass


def rows(spark, path):
    return read_parquet(spark, str(path)).count()


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 4, 5, 6):
        assert publish_parquet(spark.range(n), path) == n
        assert rows(spark, path) == n
    assert len(Folder(spark, path).names(module.MARKERS)) == module.KEPT_VERSIONS
    assert len([x for x in Folder(spark, path).names() if x.startswith("v-")]) == module.KEPT_VERSIONS


def test_plain_folder_gives_way(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert published(spark, path) == path and rows(spark, path) == 3
    publish_parquet(spark.range(5), path)
    assert rows(spark, path) == 5 and not [x for x in Folder(spark, path).names() if x.startswith("part-")]
    spark.range(7).write.mode("overwrite").parquet(path)  # a plain overwrite takes all of it
    assert rows(spark, path) == 7


@pytest.mark.parametrize("name", ["make", "delete", "names"])
@pytest.mark.parametrize("calls", range(6))
def test_stopping_between_any_two_steps(spark, tmp_path, monkeypatch, name, calls):
    """The writer dies, for good, at its n-th call of one kind to the file system."""
    path = str(tmp_path / "t")
    for n in (3, 4, 5):
        publish_parquet(spark.range(n), path)
    real, left = getattr(Folder, name), [calls]

    def failing(self, *args):
        if not left[0]:
            raise Stopped
        left[0] -= 1
        return real(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Folder, name, failing)
        try:
            publish(spark, path, spark.range(9).write.parquet)
        except Stopped:
            pass
    assert rows(spark, path) in (5, 9)
    assert publish_parquet(spark.range(10), path) == 10 == rows(spark, path)


def test_stopping_while_writing_or_checking(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_parquet(spark.range(3), path)

    def half(place):
        spark.range(9).write.parquet(f"{place}")
        raise Stopped

    with pytest.raises(Stopped):
        publish(spark, path, half)
    with pytest.raises(GateFailed):
        write_checked(spark, spark.range(5).write.parquet, path, 4)
    assert rows(spark, path) == 3 and write_checked(spark, spark.range(4).write.parquet, path, 4) == 4
    assert len([x for x in Folder(spark, path).names() if x.startswith("v-")]) == 2


def test_given_up_versions_go(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_parquet(spark.range(3), path)
    spark.range(1).write.parquet(f"{path}/v-left")
    publish_parquet(spark.range(4), path)
    assert "v-left" in Folder(spark, path).names()  # a writer may still be at it
    monkeypatch.setattr(module, "GIVEN_UP_SECONDS", -1)
    publish_parquet(spark.range(5), path)
    assert "v-left" not in Folder(spark, path).names() and rows(spark, path) == 5


def test_inner_part_and_text(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(10).selectExpr("id", "id % 2 = 0 AS even")
    publish(spark, path, table.write.partitionBy("even").parquet, inner="even=true")
    assert rows(spark, path) == 5 and read_parquet(spark, path).columns == ["id"]
    publish_csv(spark.range(2), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(published(spark, str(tmp_path / "c"))).count() == 2


def test_table_follows_its_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for query, columns in (("SELECT 1 AS a", ["a"]), ("SELECT 2 AS a UNION ALL SELECT 3", ["a"]), ("SELECT 1 AS b", ["b"])):
        table = create_table_as(spark, "routeloom_test", "versions", path, query)
        assert table.columns == columns and sorted(map(str, table.collect())) == sorted(map(str, read_parquet(spark, path).collect()))
    spark.sql("DROP DATABASE routeloom_test CASCADE")
