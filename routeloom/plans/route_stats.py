"""Delay statistics per carrier and route."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.grouping import group_stats, member_lists

KEYS = ("op_unique_carrier", "route")
MEASURES = (
    "flight_count", "min_arr_delay", "max_arr_delay",
    "avg_arr_delay", "cancellation_rate", "operating_months",
)


def route_stats(clean: DataFrame) -> DataFrame:
    """Count, min, max and mean arrival delay, cancellation rate and months flown."""
    return group_stats(
        clean,
        KEYS,
        measure="arr_delay",
        flag="is_cancelled",
        member="month",
        names=MEASURES,
    )


def order() -> list[str]:
    return list(KEYS)


def operating_months(clean: DataFrame) -> DataFrame:
    """The months flown alone."""
    return member_lists(clean, KEYS, "month", "operating_months")


def operating_months_padded(clean: DataFrame) -> DataFrame:
    """The same by sorting zero-padded text."""
    return member_lists(clean, KEYS, "month", "operating_months", padded=True)
