"""Two-way comparison of tables as multisets of rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TablesDiffer(RuntimeError):
    """The compared tables do not hold the same rows."""


def check_same_columns(left: DataFrame, right: DataFrame) -> None:
    """Names and types must agree: set operations pair columns by place and widen types."""
    shapes = [[(field.name, field.dataType) for field in side.schema] for side in (left, right)]
    if shapes[0] != shapes[1]:
        raise ValueError(
            "the tables have different columns: "
            f"{left.schema.simpleString()} and {right.schema.simpleString()}"
        )


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per distinct row of either table, with its copies in each.

    Copies are counted before the shuffle, so a row with very many of them travels once
    per task.
    """
    check_same_columns(left, right)
    sides = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return sides.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def surplus(left: DataFrame, right: DataFrame, count: str = "surplus") -> DataFrame:
    """The distinct rows of which the left table has more copies, and how many more."""
    extra = (F.col("_l") - F.col("_r")).alias(count)
    return _counted(left, right).filter(F.col("_l") > F.col("_r")).select(*left.columns, extra)


def only_in_left(left: DataFrame, right: DataFrame, piece: int = 10_000) -> DataFrame:
    """Rows of the left table that the right one does not have, copies counted.

    The same rows as ``exceptAll``. Rows with more copies than ``piece`` are cut into
    pieces and the pieces dealt out, so that no task has to repeat one row without end.
    """
    names, n = left.columns, F.col("_n")
    extra = surplus(left, right, "_n")

    def repeat(rows: DataFrame) -> DataFrame:
        return rows.select(*names, F.explode(F.sequence(F.lit(1), n.cast("int")))).select(*names)

    # a stated width, since by their size alone Spark would fold the pieces together again
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.floor((n - 1) / piece)
    at = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_at")
    pieces = (
        extra.filter(n > piece)
        .select(*names, "_n", at)
        .repartition(width, "_at")
        .withColumn("_n", F.least(F.lit(piece), n - F.col("_at") * piece))
    )
    return repeat(extra.filter(n <= piece)).unionAll(repeat(pieces))


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: left_rows, right_rows, left_only_rows, right_only_rows, matching.

    One pass gives both directions.
    """
    more = F.col("_l") - F.col("_r")

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    counts = _counted(left, right).agg(
        total(F.col("_l")).alias("left_rows"),
        total(F.col("_r")).alias("right_rows"),
        total(F.greatest(more, F.lit(0))).alias("left_only_rows"),
        total(F.greatest(-more, F.lit(0))).alias("right_only_rows"),
    )
    same = (F.col("left_only_rows") == 0) & (F.col("right_only_rows") == 0)
    return counts.withColumn("matching", same)


# Buckets that rows are digested in; their digests, one row each, come to the driver.
DIGEST_BUCKETS = 4_096


def _hashed(table: DataFrame) -> list[Column]:
    """Two hashes of a row, the same for rows that a grouping takes for equal."""
    names = [
        F.when(F.col(name) == 0, F.lit(0).cast(kind)).otherwise(F.col(name)) if kind in ("float", "double")
        else F.col(name)
        for name, kind in table.dtypes
    ]
    return [F.xxhash64(*names), F.xxhash64(F.lit(1), *names)]


def bucket_digests(table: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Per bucket of rows a digest that does not depend on their order: bucket, rows, digest.

    Rows are dealt by a hash of all columns. A digest holds sums of the halves of two 64-bit
    hashes, so it tells copies apart and grows no faster than 2^31 rows a bucket allow.
    Sums combine before the shuffle: a task sends at most one row per bucket.
    """
    first, second = _hashed(table)
    halves = [
        F.sum(half)
        for value in (F.col("_h1"), F.col("_h2"))
        for half in (value.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(value, 32))
    ]
    return (
        table.select(first.alias("_h1"), second.alias("_h2"))
        .groupBy(F.pmod("_h1", F.lit(buckets)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), F.array(*halves).alias("digest"))
    )


def compare_by_digest(left: DataFrame, right: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """The same row as ``compare``, shuffling full rows only of buckets whose digests differ.

    Equal digests are taken for equal rows: two 64-bit hashes would have to collide in sum.
    Both tables are read once for the digests and, if any differ, once more for those buckets,
    so they must give the same rows each time.
    """
    check_same_columns(left, right)
    spark = left.sparkSession
    sides = [
        {row["bucket"]: (row["rows"], row["digest"]) for row in bucket_digests(side, buckets).collect()}
        for side in (left, right)
    ]
    differing = sorted(b for b in sides[0].keys() | sides[1].keys() if sides[0].get(b) != sides[1].get(b))
    equal = sum(rows for bucket, (rows, _) in sides[0].items() if sides[1].get(bucket) == (rows, sides[0][bucket][1]))
    names = ["left_rows", "right_rows", "left_only_rows", "right_only_rows"]
    schema = ", ".join(f"{name} long" for name in names)
    same = spark.createDataFrame([(equal, equal, 0, 0)], schema)
    if differing:
        def part(table: DataFrame) -> DataFrame:
            return table.filter(F.pmod(_hashed(table)[0], F.lit(buckets)).isin(differing))

        same = reduce(DataFrame.unionByName, [same, compare(part(left), part(right)).select(*names)])
        same = same.agg(*[F.sum(name).alias(name) for name in names])
    return same.withColumn("matching", F.lit(not differing))


def require_same(
    left: DataFrame,
    right: DataFrame,
    left_label: str = "left",
    right_label: str = "right",
    how: Callable[[DataFrame, DataFrame], DataFrame] = compare,
) -> dict:
    """The comparison as a dict; raises if the tables differ."""
    verdict = how(left, right).first().asDict()
    if not verdict["matching"]:
        raise TablesDiffer(
            f"{left_label} has {verdict['left_only_rows']} rows of its own, "
            f"{right_label} has {verdict['right_only_rows']}"
        )
    return verdict
