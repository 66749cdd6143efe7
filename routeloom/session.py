"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates and text timestamps are UTC everywhere. The rest are defaults that a submit command
# may override: adaptive execution folds small shuffle partitions and splits skewed join
# partitions; larger scan splits mean fewer tasks, each with one row per group to shuffle.
# Spark still cuts small inputs finer than this, to use all cores.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    # the few parts of a cleaning run are written side by side instead of being sorted first
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # the JVM interprets longer methods; beyond this Spark splits the stage's code instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def open_session(app_name: str) -> SparkSession:
    """The session for a submitted job; settings given at submit time win."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    width = max(200, 4 * spark.sparkContext.defaultParallelism)
    settings = {
        **SETTINGS, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width)
    }
    for key, value in settings.items():
        if key not in given or key == "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder: on a cluster a
    machine-local folder would be lost with its machine, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="routeloom-", dir="/tmp")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever written over."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/routeloom/{app}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the scratch folder.

    For the end of a job: tables made by queries of this application that were not yet
    read are gone with it.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/routeloom/{context.applicationId}"
    )
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
