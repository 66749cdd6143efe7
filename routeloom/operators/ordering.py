"""Total order over a table: ordered tables, row positions and exact prefixes.

A position over the whole table cannot come from a window without a partition (one task)
nor from ``limit`` over a sort (one task again). Instead the rows are range-partitioned,
sorted and written, one file per sort task; the files' row counts then say where each
file starts, and a row's place inside its file gives its position. The table on shared
storage is the only thing later steps depend on, so losing an executor changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import row_fingerprint

_FILE = "_metadata.file_name"
_ROW = "_metadata.row_index"


# An ordered table has at most so many files, each the work of one sort task; the offsets
# of all of them, one row per file, are about a megabyte.
MAX_FILES = 10_000

# Stored bytes that one sort task is meant to take.
SORT_TASK_BYTES = 256 << 20

# Rows with equal keys that one sort task may always be given, and the share of its rows
# that they may be; the buckets they are looked for in.
ALIKE_ROWS, ALIKE_SHARE, ALIKE_BUCKETS = 5_000, 1 / 4, 16_384


def write_ordered(
    table: DataFrame,
    order: Sequence[str | Column],
    path: str,
    mode: str = "errorifexists",
    stored_bytes: int = 0,
    ties: Sequence[Column] = (),
) -> None:
    """Sort the whole table and write it so that file order is row order.

    Keys are column names or expressions; nulls come last. Expressions are computed once
    per row, before the shuffle, and dropped again after the sort. ``stored_bytes``, if
    known, says how many sort tasks are needed; there are at least as many as the
    session's shuffle width and at most ``MAX_FILES``.

    ``ties`` order the rows that are equal in all keys. They are computed after the shuffle,
    once per row, so these rows must fit one sort task together.
    """
    computed = {f"_key{at}": key for at, key in enumerate(order) if isinstance(key, Column)}
    names = [f"_key{at}" if isinstance(key, Column) else key for at, key in enumerate(order)]
    keys = [F.col(name).asc_nulls_last() for name in names]
    keyed = table.select("*", *[key.alias(name) for name, key in computed.items()])
    tasks = sort_tasks(table.sparkSession, stored_bytes)
    late = {f"_tie{at}": tie for at, tie in enumerate(ties)}
    placed = keyed.repartitionByRange(tasks, *keys).select(
        "*", *[tie.alias(name) for name, tie in late.items()]
    )
    placed = placed.sortWithinPartitions(*keys, *[F.col(name).asc_nulls_last() for name in late])
    (
        placed.select(*table.columns)
        .write.mode(mode)
        .option("maxRecordsPerFile", 0)
        .parquet(path)
    )


def sort_tasks(spark: SparkSession, stored_bytes: int) -> int:
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_FILES, max(width, -(-stored_bytes // SORT_TASK_BYTES)))


def sort_table(
    spark: SparkSession, source: str, order: Sequence[str], path: str, mode: str = "errorifexists"
) -> None:
    """Sort a Parquet table by columns, then by row fingerprint.

    Where no rows equal in the columns are many, fingerprints are computed after the shuffle.
    Else they are keys of the shuffle, too, and rows equal in every column are spread by
    where they are stored, so that many copies of one row fill several sort tasks and not
    one. Any order among them is the same.
    """
    table = spark.read.parquet(source)
    fingerprint, size = F.unhex(row_fingerprint(table.columns)), table_bytes(table)
    if few_alike(table, order, sort_tasks(spark, size)):
        write_ordered(table, order, path, mode, size, ties=[fingerprint])
        return
    spread = F.xxhash64(F.col(_FILE), F.col(_ROW))
    write_ordered(table, [*order, fingerprint, spread], path, mode, size)


def few_alike(table: DataFrame, columns: Sequence[str], tasks: int) -> bool:
    """Whether any rows equal in some columns are a small part of what one of the tasks sorts.

    Looked at are hash buckets, which hold such rows together and others besides; one row
    per bucket and task is shuffled.
    """
    bucket = F.pmod(F.xxhash64(*columns), F.lit(ALIKE_BUCKETS)).alias("bucket")
    counts = table.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    most, total = counts.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) <= max(ALIKE_ROWS, ALIKE_SHARE * (total or 0) / tasks)


def table_bytes(table: DataFrame) -> int:
    """Bytes of the files a table is read from, by their metadata."""
    files = table.select(F.col("_metadata.file_path"), F.col("_metadata.file_size")).distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of an ordered table: rows in it and rows in the files before it.

    Counting reads file footers only. The window sees one row per file, that is per sort
    task, never one per table row. Part numbers are padded, and a longer name means a
    higher number, so length and name together give file order.
    """
    counts = (
        spark.read.parquet(path)
        .groupBy(F.col(_FILE).alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    before = Window.orderBy(F.length("file"), "file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return counts.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def with_position(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The rows of an ordered table with their place in it, from 1.

    The offsets are one row per file, and files are at most ``MAX_FILES``, so they are
    broadcast and the table is not shuffled.
    """
    table = spark.read.parquet(path)
    located = table.select("*", F.col(_FILE).alias("_file"), F.col(_ROW).alias("_row"))
    offsets = file_offsets(spark, path).select(F.col("file").alias("_file"), "offset")
    return located.join(F.broadcast(offsets), "_file").select(
        *table.columns, (F.col("offset") + F.col("_row") + 1).alias(name)
    )


def offset_rows(spark: SparkSession, path: str) -> list:
    """The offsets of an ordered table's files on the driver: at most ``MAX_FILES`` rows."""
    return file_offsets(spark, path).collect()


def prefix(spark: SparkSession, path: str, rows: int, offsets: list | None = None) -> DataFrame:
    """Exactly the first rows of an ordered table; only the files they are in are read.

    Several prefixes of one table share the ``offset_rows`` they are given.
    """
    table = spark.read.parquet(path)
    if rows <= 0:
        return table.filter(F.lit(False))
    known = offset_rows(spark, path) if offsets is None else offsets
    last = next((x for x in known if x["offset"] < rows < x["offset"] + x["rows"]), None)
    whole = [f"{path}/{x['file']}" for x in known if x["offset"] + x["rows"] <= rows]
    if last is None and len(whole) == len(known):
        return table
    parts = [spark.read.schema(table.schema).parquet(*whole)] if whole else []
    if last is not None:
        # Spark drops the other files while planning, by the condition on the name alone;
        # rows of whole files go through no condition.
        named = table.filter(F.col(_FILE) == last["file"])
        parts.append(named.filter(F.col(_ROW) < rows - last["offset"]))
    return reduce(DataFrame.unionByName, parts)


def row_total(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from its footers."""
    return spark.read.parquet(path).count()
