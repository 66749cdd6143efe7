"""The reports by name, and writing one out with its row count."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..sinks.files import publish_csv, publish_parquet
from ..sinks.tables import create_table_as, export_directory
from ..sources.files import read_parquet
from ..sources.tables import external_table
from ..schemas import CLEAN_SCHEMA
from . import delay_report, route_stats, samples
from .sql_reports import (
    DELAY_REPORT_EXPORT_SQL,
    DELAY_REPORT_SQL,
    ROUTE_STATS_EXPORT_SQL,
    ROUTE_STATS_SQL,
)


@dataclass(frozen=True)
class Report:
    build: Callable[[DataFrame], DataFrame]
    order: Callable[[], list[str | Column]]
    query: str
    export: str


REPORTS = {
    "route_stats": Report(
        route_stats.route_stats, route_stats.order, ROUTE_STATS_SQL, ROUTE_STATS_EXPORT_SQL
    ),
    "delay_report": Report(
        delay_report.delay_report, delay_report.order, DELAY_REPORT_SQL, DELAY_REPORT_EXPORT_SQL
    ),
}


def write_report(
    spark: SparkSession, name: str, source: str, parquet_path: str, csv_path: str
) -> int:
    """A report over a clean Parquet table, written in order twice; gives its row count.

    The text copy is made from the Parquet copy, so both hold the same numbers and the
    input is read once.
    """
    report = REPORTS[name]
    result = report.build(read_parquet(spark, source)).orderBy(*report.order())
    rows = publish_parquet(result, parquet_path)
    publish_csv(read_parquet(spark, parquet_path).orderBy(*report.order()), csv_path)
    return rows


def write_report_tables(
    spark: SparkSession,
    name: str,
    source: str,
    parquet_path: str,
    csv_path: str,
    database: str = "routeloom",
    size: str = "full",
) -> int:
    """The same by tables: an external table, a table from a query, an ordered export."""
    report = REPORTS[name]
    clean = external_table(spark, database, f"flights_clean_{name}_{size}", CLEAN_SCHEMA, source)
    table = create_table_as(
        spark, database, f"{name}_{size}", parquet_path, report.query, flights=clean
    )
    export_directory(spark, csv_path, report.export, report=table)
    return table.count()


def preview_report(spark: SparkSession, name: str, parquet_path: str, rows: int = 10) -> DataFrame:
    return samples.preview(read_parquet(spark, parquet_path), REPORTS[name].order(), rows)
