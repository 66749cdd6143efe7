"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query is run once cold and
``$BENCH_RUNS`` times warm; the median of the warm runs counts. A ``job_`` query does what
a submitted job does: it reads a table from disk and writes its results to disk.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from routeloom.operators.compare import require_same  # noqa: E402
from routeloom.plans import clean as cleaning  # noqa: E402
from routeloom.operators.replicate import replicate  # noqa: E402
from routeloom.plans import delay_report, route_stats  # noqa: E402
from routeloom.plans.reports import write_report, write_report_tables  # noqa: E402
from routeloom.plans.samples import write_replicas, write_samples  # noqa: E402
from routeloom.registry.queries import QUERIES  # noqa: E402
from routeloom.sinks.files import write_csv, write_parquet  # noqa: E402
from routeloom.sources.adapters import flights  # noqa: E402
from routeloom.sources.files import read_parquet  # noqa: E402
from routeloom.jobs import clean as clean_job  # noqa: E402
from routeloom.session import SETTINGS, remove_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# replicas of the clean table: 7, 14 and 28 million rows from sf0.1
LARGE = {"12x": 12, "24x": 24, "49x": 49}

# registered queries that start from the driver's tables, run to a sink that keeps nothing
FROM_TABLES = (
    "clean_table_typed", "quality_metrics", "route_stats_report", "delay_report_counted",
    "delay_report_onepass", "delay_report_windowed", "row_fingerprints", "events_stats",
    "events_top_types", "run_matrix",
)


def discard(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def workload(spark: SparkSession, root: str) -> dict:
    """Queries by name, in an order in which each finds its inputs."""
    raw, clean = f"{root}/raw", f"{root}/clean"
    scaled = {size: f"{root}/scaled/flights_clean_{size}.parquet" for size in ("1x", "2x", "4x")}
    write_csv(flights(spark, SF_DIR), raw)

    def report(name, source, label, write=write_report):
        out = f"{root}/out/{label}"
        return lambda: write(spark, name, source, f"{out}/parquet", f"{out}/csv")

    def over_clean(build):
        return lambda: discard(build(read_parquet(spark, clean)))

    def same_forms():
        table = read_parquet(spark, clean)
        require_same(delay_report.windowed(table), delay_report.one_pass(table))

    todo = {
        "job_clean_from_csv": lambda: clean_job.run(spark, raw, clean, f"{root}/clean_csv"),
        "job_clean_from_tables": lambda: write_parquet(
            cleaning.clean(flights(spark, SF_DIR)), f"{root}/clean_from_tables"
        ),
        "job_samples": lambda: write_samples(spark, clean, f"{root}/samples"),
        "job_replicas": lambda: write_replicas(spark, clean, f"{root}/scaled"),
        "job_route_stats": report("route_stats", clean, "r1"),
        "job_delay_report": report("delay_report", clean, "r2"),
        "job_route_stats_tables": report("route_stats", clean, "r1t", write_report_tables),
        "job_delay_report_tables": report("delay_report", clean, "r2t", write_report_tables),
    }
    for size, factor in LARGE.items():
        scaled[size] = f"{root}/scaled/flights_clean_{size}.parquet"
        todo[f"write_{size}"] = lambda factor=factor, path=scaled[size]: write_parquet(
            replicate(read_parquet(spark, clean), factor), path
        )
    for size, path in scaled.items():
        todo[f"job_route_stats_{size}"] = report("route_stats", path, f"r1_{size}")
        todo[f"job_delay_report_{size}"] = report("delay_report", path, f"r2_{size}")
    todo |= {
        "route_stats": over_clean(route_stats.route_stats),
        "operating_months_set": over_clean(route_stats.operating_months),
        **{f"delay_report_{plan}_only": over_clean(build)
           for plan, build in delay_report.PLANS.items()},
        "compare_delay_reports": same_forms,
    }
    for name in FROM_TABLES:
        todo[f"tables_{name}"] = lambda name=name: discard(QUERIES[name](spark, SF_DIR))
    return todo


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("routeloom-bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # a folder of this run alone, on the one machine the bench runs on
    root = tempfile.mkdtemp(prefix="routeloom-bench-", dir="/tmp")
    cold, warm = {}, {}
    for name, run in workload(spark, root).items():
        times = []
        while len(times) <= RUNS:
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        cold[name] = round(times[0], 3)
        warm[name] = round(statistics.median(times[1:]), 3)
    remove_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of the median warm times of all queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "warm_runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
