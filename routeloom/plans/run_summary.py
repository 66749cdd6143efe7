"""Consolidating run records and laying them out for comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import list_rank
from ..functions.text import seconds_text
from ..operators.quality import holds, require_zero
from ..schemas import (
    ANALYSES,
    SAMPLE_SIZES,
    SCALE_SIZES,
    SUMMARY_COLUMNS,
    SUMMARY_COLUMNS_WITH_ENVIRONMENT,
    TECHNOLOGIES,
)

ALL_SIZES = (*SAMPLE_SIZES, *SCALE_SIZES)


def keep_sizes(records: DataFrame, sizes: Sequence[str]) -> DataFrame:
    return records.filter(F.col("run_size").isin(*sizes))


def listing_order(sizes: Sequence[str]) -> list[Column]:
    """Analysis, run size, technology, each in its listed order, others last."""
    return [
        list_rank(F.col("analysis"), ANALYSES),
        list_rank(F.col("run_size"), sizes),
        list_rank(F.col("technology"), TECHNOLOGIES),
    ]


def require_listed(records: DataFrame) -> None:
    """Raise if a record names no analysis or technology, or one that is not listed."""
    counts = records.agg(
        F.count_if(~holds(F.col("analysis").isin(*ANALYSES))).alias("unknown_analyses"),
        F.count_if(~holds(F.col("technology").isin(*TECHNOLOGIES))).alias("unknown_technologies"),
    )
    require_zero(counts.first().asDict())


def summary(records: DataFrame, environment: bool = False) -> DataFrame:
    """The columns of a summary in their order, seconds as text with three decimals."""
    names = SUMMARY_COLUMNS_WITH_ENVIRONMENT if environment else SUMMARY_COLUMNS
    return records.withColumn(
        "execution_time_seconds", seconds_text(F.col("execution_time_seconds"))
    ).select(*names)


def combine(sample_records: DataFrame, scale_records: DataFrame) -> DataFrame:
    return sample_records.unionByName(scale_records, allowMissingColumns=True)


def run_matrix(records: DataFrame, place: str) -> DataFrame:
    """Seconds per analysis and run size, one column per technology.

    Of several records of one cell the one with the greatest ``place`` counts.
    """
    return (
        records.groupBy("analysis", "run_size")
        .pivot("technology", list(TECHNOLOGIES))
        .agg(F.max_by("execution_time_seconds", place))
    )


def matrix_of_summary(records: DataFrame) -> DataFrame:
    """The matrix of records that only carry their time: the latest counts."""
    place = F.struct("run_timestamp", "output_rows", "execution_time_seconds")
    return run_matrix(records.withColumn("_place", place), "_place")
