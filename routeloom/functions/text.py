"""Reading typed values out of text, without failing on bad text.

Under ANSI rules a plain cast of bad text stops the query. These expressions give null
for it instead, and accept what the non-ANSI casts of earlier Spark versions accepted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def code(column: Column) -> Column:
    """A code: blanks cut off both ends, upper case."""
    return F.upper(F.trim(column))


def name(column: Column) -> Column:
    """A name: blanks cut off both ends."""
    return F.trim(column)


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_int(column: Column) -> Column:
    """Whole numbers; a decimal part such as ``3.0`` is cut off, and ``.5`` is 0."""
    whole = F.regexp_replace(column.cast("string"), r"^\s*([+-]?)(\d*)\.\d*\s*$", "$10$2")
    return whole.try_cast("int")


def to_int_via_double(column: Column) -> Column:
    """Whole part of any number text; not-a-number is 0, the ends are clamped."""
    number = to_double(column)
    return (
        F.when(F.isnan(number), F.lit(0))
        .when(number > _INT_MAX, F.lit(_INT_MAX))
        .when(number < _INT_MIN, F.lit(_INT_MIN))
        .otherwise(number.cast("int"))
    )


def to_date(column: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(column.cast("string"), pattern)


READERS: dict[str, Callable[[Column], Column]] = {
    "code": code,
    "name": name,
    "double": to_double,
    "int": to_int,
    "int_via_double": to_int_via_double,
    "date": to_date,
}


def seconds_text(column: Column) -> Column:
    """Seconds with three decimals, as text."""
    return F.format_string("%.3f", column.cast("double"))
