"""Prefix samples, scaled replicas and short previews of the clean table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import offset_rows, prefix, row_total, sort_table
from ..operators.replicate import replicate
from ..schemas import SAMPLE_ORDER, SAMPLE_ROWS, SAMPLE_SIZES, SCALE_FACTORS
from ..sinks.files import write_checked, write_parquet
from ..sources.files import variant_path
from ..sources.published import published


def target_rows(size: str, total: int) -> int:
    """Rows a named sample asks for; a small table may have fewer."""
    if size == "half":
        return total // 2
    return total if size == "full" else SAMPLE_ROWS[size]


def write_samples(spark: SparkSession, source: str, root: str) -> list[dict]:
    """Sort the table once as the full sample, and cut the others off its front."""
    source = published(spark, source)
    total = row_total(spark, source)
    full = variant_path("full", root, root)
    write_checked(spark, lambda path: sort_table(spark, source, SAMPLE_ORDER, path), full, total)
    ordered = published(spark, full)
    offsets = offset_rows(spark, ordered)  # once for all samples
    made = []
    for size in SAMPLE_SIZES:
        path, target = variant_path(size, root, root), target_rows(size, total)
        rows = total
        if size != "full":
            first = prefix(spark, ordered, target, offsets)
            rows = write_checked(spark, partial(write_parquet, first), path, min(target, total))
        made.append({"sample": size, "target_rows": target, "rows": rows, "output": path})
    return made


def write_replicas(spark: SparkSession, source: str, root: str) -> list[dict]:
    """Write the table once, twice and four times over, and check the row counts.

    The replicas are written at the same time, the largest first, so that the tasks of one
    fill the places that the last tasks of another leave idle.
    """
    source = published(spark, source)
    table = spark.read.parquet(source)
    total = row_total(spark, source)

    def write(size: str) -> dict:
        factor, path = SCALE_FACTORS[size], variant_path(size, root, root)
        copies = replicate(table, factor)
        rows = write_checked(spark, partial(write_parquet, copies), path, total * factor)
        return {"scale": size, "factor": factor, "rows": rows, "output": path}

    largest_first = sorted(SCALE_FACTORS, key=SCALE_FACTORS.get, reverse=True)
    with ThreadPoolExecutor(len(largest_first)) as writers:
        made = dict(zip(largest_first, writers.map(write, largest_first)))
    return [made[size] for size in SCALE_FACTORS]


def preview(table: DataFrame, order: Sequence[str | Column], rows: int) -> DataFrame:
    """The first rows in an order; each task keeps no more than that many."""
    return table.orderBy(*order).limit(rows)


def number_few(table: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Number the rows of a preview. Not for whole tables: see ``operators.ordering``."""
    return table.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
