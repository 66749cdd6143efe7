"""Run records: one row per timed run, kept as headed CSV.

A log is a file or a folder named ``timings.csv``. In a folder every append has a part of
its own, whose name holds the number of the append: ``append-N`` adds to the log, ``reset-N``
starts it anew. The number comes before any clock, and goes along when files are copied.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    RUN_SCHEMA,
    RUN_SCHEMA_WITH_ENVIRONMENT,
    SUMMARY_COLUMNS,
    SUMMARY_COLUMNS_WITH_ENVIRONMENT,
)
from .files import read_csv, read_csv_or_empty

# fixed values: where logs lie below their root, at any depth
SAMPLE_LOGS = r"analysis_3_[^/]*/(?:[^/]+/)*timings\.csv"
SCALE_LOGS = r"scalability/analysis_3_[^/]*/(?:[^/]+/)*timings\.csv"

# the part of an append or reset in a log folder
_PART = r"/(append|reset)-(\d{20})/[^/]+$"


@dataclass(frozen=True)
class LogFile:
    """A file of a log: its path, the same as Spark reports it of a row, size and age."""

    path: str
    place: str
    log: str
    size: int
    changed: float


def part_name(number: int, reset: bool) -> str:
    return f"{'reset' if reset else 'append'}-{number:020d}"


def part_number(path: str) -> tuple[int, bool] | None:
    """The number of the append that wrote a file, and whether it started the log anew."""
    found = re.search(_PART, path)
    return (int(found[2]), found[1] == "reset") if found else None


def log_files(spark: SparkSession, root: str, rule: str = ".*") -> list[LogFile]:
    """The files of the logs below a root that a rule on their place in it lets in.

    Folders are searched at any depth, by Spark's own listing. Parts of a log that a later
    reset has put away are left out. No root, no files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = files.load(root).select(
            "path", "_metadata.file_path", "_metadata.file_size",
            F.unix_millis("_metadata.file_modification_time").alias("changed"),
        ).collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(root)
    base = place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toString()
    logs = defaultdict(list)
    for row in found:
        inner = row["path"][len(base) :].lstrip("/")
        match = re.match(f"(?:{rule})(?=/|$)", inner)
        if match or not inner:
            log = match[0] if match and rule != ".*" else ""
            logs[log].append(LogFile(row["path"], row["file_path"], log, row["file_size"], row["changed"] / 1000))
    return [file for each in logs.values() for file in _live(each)]


def _live(files: list[LogFile]) -> list[LogFile]:
    """The files of one log from its last reset on."""
    numbers = {file.path: part_number(file.path) for file in files}
    last = max((x[0] for x in numbers.values() if x and x[1]), default=None)
    return [
        file for file in files
        if last is None or (numbers[file.path] and numbers[file.path][0] >= last)
    ]


def read_log_files(spark: SparkSession, files: list[LogFile], environment: bool = False) -> DataFrame:
    """The records of log files, with ``log_place`` and ``log_file`` telling where each was read.

    Logs with and without the environment column are different families and are read
    apart; a log of the wrong family stops the query instead of being misread.
    """
    schema = _schema(environment)
    if not files:
        whole = T.StructType([*schema, T.StructField("log_place", _PLACE), T.StructField("log_file", T.StringType())])
        return spark.createDataFrame([], whole)
    records = read_csv(spark, [file.path for file in files], schema)
    return records.select("*", _log_place().alias("log_place"), F.col("_metadata.file_path").alias("log_file"))


def read_run_records(spark: SparkSession, log: str, environment: bool = False) -> DataFrame:
    """All records of one log; no log, no records."""
    return read_log_files(spark, log_files(spark, log), environment).drop("log_file")


def read_logs(spark: SparkSession, root: str, rule: str, environment: bool = False) -> DataFrame:
    """All records of one family of logs below a root, at any depth."""
    return read_log_files(spark, log_files(spark, root, rule), environment).drop("log_file")


def _schema(environment: bool) -> T.StructType:
    return RUN_SCHEMA_WITH_ENVIRONMENT if environment else RUN_SCHEMA


_PLACE = (
    T.StructType()
    .add("append", T.LongType())
    .add("run", T.StringType())
    .add("written", T.TimestampType())
    .add("folder", T.StringType())
    .add("file", T.StringType())
    .add("block", T.LongType())
    .add("line", T.LongType())
)


def _log_place() -> Column:
    """Later records compare greater: by the number of their append, then by the time in the
    record, which survives copying, then by age, folder, file and line. Records that were
    not appended by this library have no number and come before those that were."""
    number = F.regexp_extract("_metadata.file_path", _PART, 2)
    return F.struct(
        F.nullif(number, F.lit("")).cast("long").alias("append"),
        F.col("run_timestamp").alias("run"),
        F.col("_metadata.file_modification_time").alias("written"),
        F.regexp_replace("_metadata.file_path", "[^/]*$", "").alias("folder"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_summary(spark: SparkSession, path: str, environment: bool = False) -> DataFrame:
    """A consolidated summary, or no rows if there is none yet."""
    schema = _schema(environment)
    names = SUMMARY_COLUMNS_WITH_ENVIRONMENT if environment else SUMMARY_COLUMNS
    return read_csv_or_empty(spark, path, T.StructType([schema[name] for name in names]))
