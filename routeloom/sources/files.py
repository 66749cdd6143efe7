"""File sources."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import RAW_COLUMNS, SAMPLE_SIZES, SCALE_SIZES
from .published import published


# Files whose first lines are read at a time.
HEADER_READERS = 16


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files below a folder, a file or a pattern that Spark would read, in order."""
    listed = spark.read.format("binaryFile").load(path).select("path")
    return sorted(row["path"] for row in listed.collect())


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, compressed or not; null if it is empty."""
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        text = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def header_census(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a path by their header line; files without a line are left out.

    Only the first block of each file is opened, as for Parquet footers, some files at a
    time. What is kept is the names of files, which Spark's own listing holds as well.
    """
    files = files_of(spark, path)
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        lines = list(readers.map(lambda file: first_line(spark, file), files))
    groups = defaultdict(list)
    for file, line in zip(files, lines):
        if line is not None:
            groups[line].append(file)
    return dict(groups)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows as text, with the columns the headers name.

    Spark fills CSV columns by place, so files are grouped by their header line, each group
    is read by its own header, and the groups are put together by name. Every header must
    have the used columns, in any order and case; a column that only some files have is
    null in the others' rows.
    """
    groups = header_census(spark, path)
    if not groups:
        raise ValueError(f"no header line in {path}")
    frames = []
    for files in groups.values():
        header = spark.read.option("header", True).csv(files[0]).columns
        found = {name.lower() for name in header}
        missing = [name for name in RAW_COLUMNS if name not in found]
        if missing:
            raise ValueError(f"columns missing in {files[0]}: {', '.join(missing)}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        # one group is the whole path, and stays readable by it
        source = path if len(groups) == 1 else files
        reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        frames.append(reader.option("enforceSchema", False).csv(source))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A headed CSV with known types; the header must agree with the schema."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(published(spark, path) if isinstance(path, str) else path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(published(spark, path))


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_csv``, but a missing path is an empty table."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def variant_path(size: str, samples_root: str, scaled_root: str) -> str:
    """Where the clean table of a sample size or scale factor is kept."""
    if size in SCALE_SIZES:
        root = scaled_root
    elif size in SAMPLE_SIZES:
        root = samples_root
    else:
        raise ValueError(f"unknown size {size}")
    return f"{root.rstrip('/')}/flights_clean_{size}.parquet"


def sizes(choice: str) -> tuple[str, ...]:
    """The sizes a sweep covers: ``all``, ``scale_all`` or one by name."""
    if choice == "all":
        return SAMPLE_SIZES
    if choice == "scale_all":
        return SCALE_SIZES
    if choice in SAMPLE_SIZES + SCALE_SIZES:
        return (choice,)
    raise ValueError(f"unknown size {choice}")
