"""Table sinks: a table from a query, and an ordered text export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.published import publish
from ..sources.tables import _name, columns_ddl, drop_table, location
from .files import write_parquet


def create_table_as(
    spark: SparkSession, database: str, table: str, path: str, query: str, **views: DataFrame
) -> DataFrame:
    """A Parquet table at a location from a query; ``{view}`` in it names a DataFrame.

    The rows are a new version of the path. An earlier table of that name is pointed to it,
    which is one change in the catalog, or made anew if its columns are others.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    result = spark.sql(query, **views)
    full_name = _name(database, table)
    rows = publish(spark, path, lambda place: write_parquet(result, place))
    schema = spark.read.parquet(rows).schema
    if spark.catalog.tableExists(full_name) and spark.table(full_name).schema == schema:
        spark.sql(f"ALTER TABLE {full_name} SET LOCATION {location(rows)}")
        spark.catalog.refreshTable(full_name)
    else:
        drop_table(spark, database, table)
        spark.sql(
            f"CREATE TABLE {full_name} ({columns_ddl(schema)}) USING PARQUET LOCATION {location(rows)}"
        )
    return spark.table(full_name)


def export_directory(spark: SparkSession, path: str, query: str, **views: DataFrame) -> None:
    """A new version of a directory with the rows of a query as headed, quoted text."""

    def write(place: str) -> None:
        spark.sql(
            f"INSERT OVERWRITE DIRECTORY {location(place)} USING csv OPTIONS (header 'true') {query}",
            **views,
        )

    publish(spark, path, write)
