from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from routeloom.operators.compare import (
    TablesDiffer, bucket_digests, compare, compare_by_digest, only_in_left, require_same, surplus,
)

VALUES = st.lists(
    st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 0.5, float("nan")])),
    max_size=12,
)


def table(spark, rows):
    return spark.createDataFrame(rows, "a int, b double")


def bag(rows):
    return Counter((a, "nan" if b is not None and b != b else b) for a, b in rows)


@settings(max_examples=8, deadline=None)
@given(left=VALUES, right=VALUES)
def test_counts_equal_brute_force(spark, left, right):
    mine = compare(table(spark, left), table(spark, right)).first()
    a, b = bag(left), bag(right)
    expected = (len(left), len(right), (a - b).total(), (b - a).total(), a == b)
    assert tuple(mine) == expected
    for buckets in (1, 3, 4_096):
        assert tuple(compare_by_digest(table(spark, left), table(spark, right), buckets).first()) == expected
    rest = only_in_left(table(spark, left), table(spark, right), piece=2).collect()
    assert bag(rest) == a - b


def test_many_copies_are_cut_into_pieces(spark):
    left = spark.range(50_000).selectExpr("if(id % 3 = 0, 0, id) AS v")
    right = spark.range(0, 50_000, 7).selectExpr("if(id % 2 = 0, 0, id) AS v")
    mine = only_in_left(left, right, piece=1_000)
    assert require_same(mine, left.exceptAll(right))["matching"]
    hot = surplus(left, right).filter("v = 0").first().surplus
    assert hot > 10_000
    tasks = mine.filter("v = 0").groupBy(F.spark_partition_id()).count().collect()
    assert max(task["count"] for task in tasks) < hot


def test_other_names_or_types_are_refused(spark):
    base = spark.createDataFrame([(1, 2)], "a int, b int")
    for schema in ("b int, a int", "a bigint, b int"):
        with pytest.raises(ValueError, match="different columns"):
            compare(base, spark.createDataFrame([(1, 2)], schema))
    with pytest.raises(ValueError):
        only_in_left(base, base.select("a"))


def test_verdict_is_raised(spark):
    one, two = spark.range(3), spark.range(5)
    assert require_same(one, one)["matching"]
    with pytest.raises(TablesDiffer, match="first has 0 rows of its own, second has 2"):
        require_same(one, two, "first", "second")


def test_equal_digests_shuffle_no_full_row(spark):
    """Of equal tables only one row per bucket and task is shuffled, and never a column of theirs."""
    wide = spark.range(20_000).selectExpr("id", "concat('text ', id) AS text", "id / 3 AS ratio")
    moved = wide.repartition(7)
    result = compare_by_digest(wide, moved, 64)
    assert tuple(result.first()) == (20_000, 20_000, 0, 0, True)
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    plan = bucket_digests(wide, 64)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(shuffled) == 1 and "text" not in shuffled[0]
    assert "partial_sum" in plan and bucket_digests(wide, 64).count() == 64


def test_digests_tell_copies_and_zeros(spark):
    rows = [(1, 0.0), (1, 0.0), (2, None), (3, float("nan"))]
    other = [(1, -0.0), (1, 0.0), (2, None), (3, float("nan"))]
    schema = "a int, b double"
    assert compare_by_digest(spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)).first().matching
    fewer = spark.createDataFrame(rows[1:], schema)
    assert tuple(compare_by_digest(spark.createDataFrame(rows, schema), fewer).first()) == (4, 3, 1, 0, False)
    with pytest.raises(TablesDiffer):
        require_same(fewer, spark.createDataFrame(rows, schema), how=compare_by_digest)
    with pytest.raises(ValueError, match="different columns"):
        compare_by_digest(fewer, fewer.withColumnRenamed("b", "c"))
