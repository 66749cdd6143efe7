"""Row accounting and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    """A quality gate did not hold."""


def holds(condition: Column) -> Column:
    """The condition as a filter sees it: unknown counts as not held."""
    return F.coalesce(condition, F.lit(False))


def broken_rules(table: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows break each rule, in one pass."""
    return table.agg(
        *[F.count_if(~holds(rule)).alias(f"broken_{name}") for name, rule in rules.items()]
    )


def any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition


def require_zero(counts: Mapping[str, int]) -> None:
    """Raise if any of the counts is not zero."""
    bad = {name: value for name, value in counts.items() if value}
    if bad:
        raise GateFailed(", ".join(f"{name}={value}" for name, value in bad.items()))


def require_rows(found: int, expected: int) -> None:
    if found != expected:
        raise GateFailed(f"{found} rows where {expected} were expected")
