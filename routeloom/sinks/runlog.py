"""Run records: append, and the consolidated summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import seconds_text
from ..schemas import RUN_SCHEMA, RUN_SCHEMA_WITH_ENVIRONMENT
from ..sources.published import Folder
from ..sources.runlog import log_files, part_name, part_number

# numbers that have been given out below a root of logs, as names of empty files
_NUMBERS = "_appends"


def next_append(spark: SparkSession, root: str) -> int:
    """A number greater than that of every append below a root.

    It is taken by making an empty file of that name, which only one writer can do; the
    numbers in the names of the logs count as well, so copied logs are followed on.
    """
    folder = Folder(spark, root)
    given = [int(name) for name in folder.names(_NUMBERS) if name.isdigit()]
    written = [part_number(file.path) for file in log_files(spark, root)]
    number = max([0, *given, *[x[0] for x in written if x]]) + 1
    while not folder.make(f"{_NUMBERS}/{number:020d}"):
        number += 1
    for name in folder.names(_NUMBERS):
        if name.isdigit() and int(name) < number:
            folder.delete(f"{_NUMBERS}/{name}")
    return number


def append_run_records(
    records: DataFrame, path: str, reset: bool = False, root: str | None = None
) -> None:
    """Add records to a log, or start it anew with them.

    Appends to any log below ``root`` (the log itself, if not given) are numbered one after
    the other. A reset counts from the moment its rows are there; what it puts away is
    deleted after that.
    """
    spark = records.sparkSession
    schema = RUN_SCHEMA_WITH_ENVIRONMENT if "environment" in records.columns else RUN_SCHEMA
    rows = records.select(
        *[
            (seconds_text(F.col(name)) if name == "execution_time_seconds" else F.col(name)).alias(
                name
            )
            for name in schema.names
        ]
    )
    number = next_append(spark, root or path)
    rows.write.option("header", True).option("quoteAll", True).csv(f"{path}/{part_name(number, reset)}")
    if reset:
        folder = Folder(spark, path)
        for name in folder.names():
            part = part_number(f"/{name}/file")
            if not name.startswith("_") and (part is None or part[0] < number):
                folder.delete(name)


def run_record(
    spark: SparkSession,
    analysis: str,
    technology: str,
    run_size: str,
    input_path: str,
    output_path: str,
    seconds: float,
    output_rows: int,
    environment: str | None = None,
) -> DataFrame:
    """One record, stamped with the time of its writing in UTC."""
    values = {
        "analysis": F.lit(analysis),
        "technology": F.lit(technology),
        "run_size": F.lit(run_size),
        "input_path": F.lit(input_path),
        "output_path": F.lit(output_path),
        "execution_time_seconds": F.lit(float(seconds)),
        "output_rows": F.lit(output_rows).cast("long"),
        "run_timestamp": F.date_format(
            F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ),
    }
    if environment is not None:
        values["environment"] = F.lit(environment)
    return spark.range(0, 1, 1, 1).select(*[value.alias(name) for name, value in values.items()])
