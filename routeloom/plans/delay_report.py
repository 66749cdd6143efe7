"""Delays and most frequent causes per origin, month and delay band.

Three plans with the same rows:

``one_pass``   counts per group and cause, ranks a group's counts, then adds them up and
               lists the first three. Two shuffles; causes of any name and number. The default.
``counted``    one aggregation that counts each cause of a given list in a column of its
               own. One shuffle; only for data known to hold no other cause.
``windowed``   metrics and ranked causes apart, joined at the end. Any causes at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import list_rank
from ..operators.grouping import (
    item_counts,
    mean,
    rank_items,
    top_items_text,
    top_items_text_by_rank,
)
from ..schemas import BANDS, CAUSES, NO_CAUSE

KEYS = ("origin", "month", "departure_delay_band")
CAUSE = "primary_disruption_cause"
TOP = 3
COLUMNS = (*KEYS, "flight_count", "avg_dep_delay", "avg_arr_delay", "top_3_causes")


def banded(clean: DataFrame) -> DataFrame:
    """Rows with a known delay band, with the columns the report needs."""
    wanted = clean.select(*KEYS, "dep_delay", "arr_delay", CAUSE)
    return wanted.filter(F.col("departure_delay_band").isin(*BANDS))


def has_cause() -> Column:
    return F.col(CAUSE).isNotNull() & (F.col(CAUSE) != NO_CAUSE)


def order() -> list[str | Column]:
    """Origin, month, then bands from low to high."""
    return ["origin", "month", list_rank(F.col("departure_delay_band"), BANDS)]


def band_metrics(clean: DataFrame) -> DataFrame:
    return (
        banded(clean)
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            mean("dep_delay").alias("avg_dep_delay"),
            mean("arr_delay").alias("avg_arr_delay"),
        )
    )


def cause_counts(clean: DataFrame) -> DataFrame:
    return item_counts(banded(clean).filter(has_cause()), KEYS, CAUSE, "cause_count")


def ranked_causes(clean: DataFrame) -> DataFrame:
    return rank_items(cause_counts(clean), KEYS, CAUSE, "cause_count", "cause_rank")


def top_causes(clean: DataFrame, by_rank: bool = False) -> DataFrame:
    """The three most frequent causes as text, for groups that have any."""
    build = top_items_text_by_rank if by_rank else top_items_text
    return build(
        ranked_causes(clean), KEYS, CAUSE, "cause_count", "cause_rank", TOP, "top_3_causes"
    )


def windowed(clean: DataFrame, by_rank: bool = False) -> DataFrame:
    causes = top_causes(clean, by_rank)
    text = F.coalesce(F.nullif(F.col("top_3_causes"), F.lit("")), F.lit(NO_CAUSE))
    return (
        band_metrics(clean)
        .join(causes, list(KEYS), "left")
        .withColumn("top_3_causes", text)
        .select(*COLUMNS)
    )


def _top_text(entries: Column) -> Column:
    """Text of the first entries, most frequent first, equal counts by cause."""
    best = F.slice(F.array_sort(entries), 1, TOP)
    labels = F.transform(
        best, lambda entry: F.concat(entry["cause"], F.lit(":"), (-entry["minus"]).cast("string"))
    )
    return F.coalesce(F.nullif(F.array_join(labels, ","), F.lit("")), F.lit(NO_CAUSE))


def _entry(cause: Column, count: Column) -> Column:
    return F.struct((-count).alias("minus"), cause.alias("cause"))


def one_pass(clean: DataFrame) -> DataFrame:
    """Partial sums per group and cause, ranked in a sort that may spill.

    However many causes a group has, no more than three are collected.
    """
    fine = (
        banded(clean)
        .groupBy(*KEYS, CAUSE)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("dep_delay").alias("dep_sum"),
            F.count("dep_delay").alias("dep_n"),
            F.sum("arr_delay").alias("arr_sum"),
            F.count("arr_delay").alias("arr_n"),
        )
    )
    best_first = Window.partitionBy(*KEYS).orderBy(has_cause().desc(), F.desc("n"), F.asc(CAUSE))
    fine = fine.withColumn("_rank", F.row_number().over(best_first))
    entry = F.when(has_cause() & (F.col("_rank") <= TOP), _entry(F.col(CAUSE), F.col("n")))

    def merged_mean(part: str) -> Column:
        return F.round(F.try_divide(F.sum(f"{part}_sum"), F.sum(f"{part}_n")), 2)

    return (
        fine.groupBy(*KEYS)
        .agg(
            F.sum("n").alias("flight_count"),
            merged_mean("dep").alias("avg_dep_delay"),
            merged_mean("arr").alias("avg_arr_delay"),
            F.collect_list(entry).alias("_entries"),
        )
        .withColumn("top_3_causes", _top_text(F.col("_entries")))
        .select(*COLUMNS)
    )


def counted(clean: DataFrame, causes: Sequence[str] = CAUSES) -> DataFrame:
    """All causes counted side by side; a cause not listed stops the query."""
    slots = {cause: f"_n{at}" for at, cause in enumerate(causes)}
    stray = has_cause() & ~F.col(CAUSE).isin(*causes)
    entries = F.filter(
        F.array(*[_entry(F.lit(cause), F.col(slot)) for cause, slot in slots.items()]),
        lambda e: e["minus"] < 0,
    )
    problem = F.raise_error(F.lit("a cause is not listed; use one_pass or windowed"))
    return (
        banded(clean)
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            mean("dep_delay").alias("avg_dep_delay"),
            mean("arr_delay").alias("avg_arr_delay"),
            *[F.count_if(F.col(CAUSE) == cause).alias(slot) for cause, slot in slots.items()],
            F.count_if(stray).alias("_stray"),
        )
        .withColumn(
            "top_3_causes",
            F.when(F.col("_stray") == 0, _top_text(entries)).otherwise(problem.cast("string")),
        )
        .select(*COLUMNS)
    )


PLANS = {"one_pass": one_pass, "counted": counted, "windowed": windowed}


def delay_report(clean: DataFrame, plan: str = "one_pass") -> DataFrame:
    return PLANS[plan](clean)
