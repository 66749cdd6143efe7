"""Group statistics and the most frequent items of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mean(column: str, digits: int = 2) -> Column:
    """Average without nulls, rounded half up; null when there is no value."""
    return F.round(F.avg(column), digits)


def member_text(member: str) -> Column:
    """The whole numbers of a group, sorted, as text, from rows that hold each one once."""
    members = F.array_sort(F.collect_list(member))
    return F.array_join(F.transform(members, lambda each: each.cast("string")), ",")


def member_text_padded(member: str) -> Column:
    """The same by sorting zero-padded text, for numbers from 0 of any length."""
    padded = F.array_sort(F.collect_list(F.lpad(F.col(member).cast("string"), 20, "0")))
    return F.array_join(F.transform(padded, lambda each: F.regexp_replace(each, "^0+(?=.)", "")), ",")


def member_lists(
    table: DataFrame, keys: Sequence[str], member: str, name: str, padded: bool = False
) -> DataFrame:
    """The distinct members of each group as text, empty text if there is none.

    Members are made distinct by a hash aggregation that combines before the shuffle; only
    the few that are left per group are collected.
    """
    text = member_text_padded if padded else member_text
    return table.select(*keys, member).distinct().groupBy(*keys).agg(text(member).alias(name))


def group_stats(
    table: DataFrame,
    keys: Sequence[str],
    *,
    measure: str,
    flag: str,
    member: str,
    names: Sequence[str],
) -> DataFrame:
    """Count, min, max and mean of a measure, rate of a 0/1 flag, and a member list.

    ``names`` are the six result columns. Rows are first added up per group and member, in
    buffers of fixed size that combine before the shuffle, so a hot group sends one row per
    member and task; the sums of a group's members are then added up and listed.
    """
    count, least, most, average, rate, members = names
    fine = table.groupBy(*keys, member).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(measure).alias("_least"),
        F.max(measure).alias("_most"),
        F.sum(measure).alias("_sum"),
        F.count(measure).alias("_known"),
        F.sum(flag).alias("_flags"),
        F.count(flag).alias("_flagged"),
    )
    return fine.groupBy(*keys).agg(
        F.sum("_rows").alias(count),
        F.min("_least").alias(least),
        F.max("_most").alias(most),
        F.round(F.try_divide(F.sum("_sum"), F.sum("_known")), 2).alias(average),
        F.round(F.try_divide(F.sum("_flags"), F.sum("_flagged")), 4).alias(rate),
        member_text(member).alias(members),
    )


def item_counts(table: DataFrame, keys: Sequence[str], item: str, count: str) -> DataFrame:
    """Rows per group and item."""
    return table.groupBy(*keys, item).agg(F.count(F.lit(1)).alias(count))


def rank_items(
    counts: DataFrame, keys: Sequence[str], item: str, count: str, rank: str
) -> DataFrame:
    """Number the items of a group: most frequent first, equal counts by item.

    A following ``rank <= k`` is applied before the shuffle too, so a group with very many
    items sends at most k of them per task.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(count).desc(), F.col(item).asc())
    return counts.withColumn(rank, F.row_number().over(order))


def item_label(item: str, count: str) -> Column:
    return F.concat(F.col(item), F.lit(":"), F.col(count).cast("string"))


def top_items_text(
    ranked: DataFrame, keys: Sequence[str], item: str, count: str, rank: str, k: int, name: str
) -> DataFrame:
    """The top k items of each group as ``item:count,...``, by a sorted list of structs."""
    entry = F.struct(F.col(rank).alias("at"), item_label(item, count).alias("label"))
    return (
        ranked.filter(F.col(rank) <= k)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(*keys, F.array_join(F.col("_entries.label"), ",").alias(name))
    )


def top_items_text_by_rank(
    ranked: DataFrame, keys: Sequence[str], item: str, count: str, rank: str, k: int, name: str
) -> DataFrame:
    """The same text by one conditional maximum per rank."""
    slots = [
        F.max(F.when(F.col(rank) == place, item_label(item, count))) for place in range(1, k + 1)
    ]
    return (
        ranked.filter(F.col(rank) <= k)
        .groupBy(*keys)
        .agg(F.nullif(F.concat_ws(",", *slots), F.lit("")).alias(name))
    )


def top_k_by_count(table: DataFrame, keys: Sequence[str], item: str, k: int) -> DataFrame:
    """The k most frequent items of each group as rows with their count and rank."""
    counts = item_counts(table, keys, item, "item_count")
    return rank_items(counts, keys, item, "item_count", "item_rank").filter(
        F.col("item_rank") <= k
    )
