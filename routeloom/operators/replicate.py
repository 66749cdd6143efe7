"""Scale a table up by whole copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate(table: DataFrame, copies: int) -> DataFrame:
    """Every row ``copies`` times, from a single scan and without a shuffle."""
    if copies < 1:
        raise ValueError("a table is replicated at least once")
    if copies == 1:
        return table
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy")
    return table.select("*", copy).drop("_copy")


def replicate_by_union(table: DataFrame, copies: int) -> DataFrame:
    """The same rows by repeated union: one scan per copy. Kept as a cross-check."""
    if copies < 1:
        raise ValueError("a table is replicated at least once")
    return reduce(DataFrame.unionByName, [table] * copies)
