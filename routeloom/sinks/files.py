"""File sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import require_rows
from ..sources.published import publish


def write_parquet(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def packed_text(codec: str) -> dict[str, str]:
    """Options of a text writer: a codec that text readers know by the files' names, or ``none``."""
    return {"compression": codec, "zlib.compress.level": "BEST_SPEED"}


def write_csv(table: DataFrame, path: str, codec: str = "none") -> None:
    table.write.mode("overwrite").options(header=True, **packed_text(codec)).csv(path)


def publish_parquet(table: DataFrame, path: str) -> int:
    """A new version of a Parquet output; gives its row count, from its footers.

    An observed count would be free, but a stage run again after an executor is lost can
    count its rows twice.
    """
    rows = publish(table.sparkSession, path, lambda place: write_parquet(table, place))
    return table.sparkSession.read.parquet(rows).count()


def publish_csv(table: DataFrame, path: str, codec: str = "none") -> None:
    publish(table.sparkSession, path, lambda place: write_csv(table, place, codec))


def write_checked(spark: SparkSession, write: Callable[[str], None], path: str, expected: int) -> int:
    """Write a new version, check the rows that were written, and only then let it count.

    ``write`` is given the place to write to. If the count is not as expected, what was at
    ``path`` before stays as it was.
    """

    def check(place: str) -> None:
        require_rows(spark.read.parquet(place).count(), expected)

    publish(spark, path, write, check)
    return expected
