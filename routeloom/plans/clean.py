"""From raw text rows to the clean table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text
from ..operators.quality import any_null, broken_rules, holds
from ..schemas import (
    BAND_CUTS,
    BANDS,
    CANCELLATION_CAUSES,
    CLEAN_COLUMNS,
    DELAY_CAUSES,
    NO_CAUSE,
    RAW_COLUMNS,
    UNKNOWN_BAND,
    UNKNOWN_CANCELLATION,
)

# the type each kind of text is read as
KINDS = {"code": "string", "name": "string", "int_via_double": "int"}
KEY_COLUMNS = ("fl_date", "month", "op_unique_carrier", "origin", "dest")


def typed(raw: DataFrame) -> DataFrame:
    """The used columns with their types; text that cannot be read becomes null."""
    already = {name.lower(): kind for name, kind in raw.dtypes}
    columns = []
    for name, kind in RAW_COLUMNS.items():
        column = F.col(name)
        needs_reading = kind in ("code", "name") or already[name] != KINDS.get(kind, kind)
        columns.append((text.READERS[kind](column) if needs_reading else column).alias(name))
    return raw.select(*columns)


def rules() -> dict[str, Column]:
    """What a typed row must satisfy to be kept; unknown is not enough."""
    return {
        "date": F.col("fl_date").isNotNull(),
        "month": F.col("month").between(1, 12),
        "carrier": F.col("op_unique_carrier") != "",
        "origin": F.col("origin") != "",
        "dest": F.col("dest") != "",
        "route": F.col("origin") != F.col("dest"),
        "diverted": F.coalesce(F.col("diverted"), F.lit(0)) == 0,
    }


def kept() -> Column:
    condition = F.lit(True)
    for rule in rules().values():
        condition = condition & rule
    return condition


def route() -> Column:
    return F.concat_ws("-", "origin", "dest")


def is_cancelled() -> Column:
    return labels.flag(F.col("cancelled") == 1)


def delay_band() -> Column:
    return labels.band(F.col("dep_delay"), BAND_CUTS, BANDS, UNKNOWN_BAND)


def primary_cause() -> Column:
    """Cancelled rows by their code, others by their longest delay."""
    cancelled = labels.label_of_code(
        F.col("cancellation_code"), CANCELLATION_CAUSES, UNKNOWN_CANCELLATION
    )
    delayed = labels.argmax_label(DELAY_CAUSES, NO_CAUSE)
    return F.when(F.col("cancelled") == 1, cancelled).otherwise(delayed)


def derived(typed_rows: DataFrame) -> DataFrame:
    return typed_rows.withColumns(
        {
            "route": route(),
            "is_cancelled": is_cancelled(),
            "primary_disruption_cause": primary_cause(),
            "departure_delay_band": delay_band(),
        }
    )


# where a row of a cleaning run belongs; a kept row that breaks a gate is faulty
PART, KEPT, REMOVED, NULL_KEY, DIVERTED = "part", "kept", "removed", "null_key", "diverted"
BOTH = f"{NULL_KEY}_{DIVERTED}"


def parted(raw: DataFrame) -> DataFrame:
    """Every row typed and derived, the 27 columns and the part it belongs to."""
    null_key, diverted = any_null(KEY_COLUMNS), holds(F.col("diverted") == 1)
    part = (
        F.when(~holds(kept()), REMOVED)
        .when(null_key & diverted, BOTH)
        .when(null_key, NULL_KEY)
        .when(diverted, DIVERTED)
        .otherwise(KEPT)
    )
    return derived(typed(raw).withColumn(PART, part)).select(*CLEAN_COLUMNS, PART)


def account_parts(rows: DataFrame) -> DataFrame:
    """The counts of a cleaning run from parted rows; where they lie in a folder per part,
    file footers are all that is read."""
    part = F.col(PART)
    return rows.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(part != REMOVED).alias("processed_rows"),
        F.count_if(part == REMOVED).alias("removed_rows"),
        F.count_if(part.isin(NULL_KEY, BOTH)).alias("null_key_rows"),
        F.count_if(part.isin(DIVERTED, BOTH)).alias("diverted_rows"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """Type, filter and derive; the 27 columns of the clean table."""
    return derived(typed(raw).filter(kept())).select(*CLEAN_COLUMNS)


def rule_counts(raw: DataFrame) -> DataFrame:
    return broken_rules(typed(raw), rules())


def account_columns() -> list[Column]:
    """Aggregates over typed rows: rows in, kept, removed, and the two gates."""
    keep = holds(kept())
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(keep).alias("processed_rows"),
        F.count_if(~keep).alias("removed_rows"),
        F.count_if(keep & any_null(KEY_COLUMNS)).alias("null_key_rows"),
        F.count_if(keep & holds(F.col("diverted") == 1)).alias("diverted_rows"),
    ]


def account(raw: DataFrame) -> DataFrame:
    """One row with the counts of a cleaning run, in one pass over the raw rows."""
    return typed(raw).agg(*account_columns())
