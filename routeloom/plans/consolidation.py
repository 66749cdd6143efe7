"""Consolidating run logs step by step: only files that are new since the last time are read.

What has been read is kept as a published table of records, each with the file it came from,
beside the list of these files with size and age. A next run keeps the records of files that
are still there as they were, drops those of files that went or changed, and reads the rest.
The result is that of reading all logs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import write_parquet
from ..sources.published import Folder, publish, published
from ..sources.runlog import log_files, read_log_files
from .run_summary import keep_sizes

RECORDS, FILES = "records", "files"
FILE_SCHEMA = "log_file string, size long, changed double"


def consolidate(
    spark: SparkSession,
    root: str,
    rule: str,
    store: str,
    environment: bool = False,
    sizes: Sequence[str] | None = None,
) -> dict:
    """Bring a store of records up to the logs below a root; gives what was done.

    With ``sizes`` only records of these run sizes are kept. A run that finds no such record
    at all leaves the store as it is: an empty or mistyped root, or logs that hold nothing
    listed, never take away what was consolidated before.
    """
    present = log_files(spark, root, rule)
    known = _known_files(spark, store)
    same = [file for file in present if known.get(file.place) == (file.size, file.changed)]
    added = [file for file in present if known.get(file.place) != (file.size, file.changed)]
    done = {"files_kept": len(same), "files_read": len(added), "files_gone": len(known.keys() - {x.place for x in present})}
    if known and not added and not done["files_gone"]:
        return {**done, "changed": False}
    records = read_log_files(spark, added, environment)
    if sizes is not None:
        records = keep_sizes(records, sizes)
    if same:
        kept = spark.createDataFrame([(file.place,) for file in same], "log_file string")
        records = stored_records(spark, store).join(kept, "log_file", "left_semi").unionByName(records)
    if records.isEmpty():
        return {**done, "changed": False}
    files = spark.createDataFrame([(x.place, x.size, x.changed) for x in present], FILE_SCHEMA)

    def write(place: str) -> None:
        write_parquet(records, f"{place}/{RECORDS}")
        write_parquet(files.coalesce(1), f"{place}/{FILES}")

    publish(spark, store, write)
    return {**done, "changed": True}


def _known_files(spark: SparkSession, store: str) -> dict[str, tuple[int, float]]:
    place = published(spark, store)
    if FILES not in Folder(spark, place).names():
        return {}
    return {
        row["log_file"]: (row["size"], row["changed"])
        for row in spark.read.parquet(f"{place}/{FILES}").collect()
    }


def stored_records(spark: SparkSession, store: str) -> DataFrame:
    """The records of a store, with ``log_place`` and ``log_file``."""
    return spark.read.parquet(f"{published(spark, store)}/{RECORDS}")


def has_records(spark: SparkSession, store: str) -> bool:
    return RECORDS in Folder(spark, published(spark, store)).names()
