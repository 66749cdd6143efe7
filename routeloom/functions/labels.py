"""Labels derived from values: flags, bands, the largest of several columns, list ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def band(
    value: Column,
    cuts: Sequence[tuple[float, bool]],
    labels: Sequence[str],
    null_label: str,
) -> Column:
    """Name the interval a value falls in.

    ``cuts`` are rising upper bounds with a mark whether the bound itself belongs to the
    interval; there is one label more than cuts.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("give one label more than cuts")
    chain = F.when(value.isNull(), F.lit(null_label))
    for (bound, inclusive), label in zip(cuts, labels):
        chain = chain.when(value <= bound if inclusive else value < bound, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def label_of_code(value: Column, labels: Mapping[str, str], default: str) -> Column:
    """The label of a code, or the default for null and for codes not listed."""
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def argmax_label(labels: Mapping[str, str], none_label: str) -> Column:
    """The label of the column with the largest value; null counts as 0.

    Of equal columns the first listed wins. If nothing is above 0 the answer is
    ``none_label``. One comparison of (value, precedence, label) entries: the short code
    it compiles to matters, since the JVM never compiles a stage's method beyond 8000
    bytes and would interpret the whole cleaning stage instead.
    """
    entries = [(F.lit(0.0), 1, none_label)]
    for at, (name, label) in enumerate(labels.items()):
        entries.append((F.coalesce(F.col(name), F.lit(0.0)), -at, label))
    best = F.greatest(
        *[
            F.struct(value.alias("value"), F.lit(rank).alias("rank"), F.lit(label).alias("label"))
            for value, rank, label in entries
        ]
    )
    return best["label"]


def list_rank(value: Column, order: Sequence[str]) -> Column:
    """Position of a value in a list, from 1; values not in it come after all of them."""
    known = F.array(*[F.lit(item) for item in order])
    found = F.nullif(F.array_position(known, value), F.lit(0))
    return F.coalesce(found, F.lit(len(order) + 1)).cast("int")
