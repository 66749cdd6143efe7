"""Catalog tables: databases, external tables and temporary views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .published import published


def _name(*parts: str) -> str:
    for part in parts:
        if not re.fullmatch(r"\w+", part):
            raise ValueError(f"not a plain name: {part}")
    return ".".join(parts)


def location(path: str) -> str:
    """A path as an SQL string literal."""
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def register_view(table: DataFrame, name: str) -> None:
    table.createOrReplaceTempView(name)


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    spark.sql(f"USE {_name(database)}")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Forget a table; files at a location of its own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(database, table)}")


def external_table(
    spark: SparkSession, database: str, table: str, schema: T.StructType, path: str
) -> DataFrame:
    """A table with explicit columns over a Parquet directory that exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    drop_table(spark, database, table)
    spark.sql(
        f"CREATE TABLE {_name(database, table)} ({columns_ddl(schema)}) "
        f"USING PARQUET LOCATION {location(published(spark, path))}"
    )
    return spark.table(_name(database, table))
