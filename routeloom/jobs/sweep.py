"""Run a report over sample sizes or scale factors, timed, one log record per run."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from ..plans.reports import REPORTS
from ..schemas import SCALE_SIZES
from ..session import open_session
from ..sinks.runlog import append_run_records, run_record
from ..sources.files import sizes, variant_path
from .common import arguments, show
from .report import FORMS, write

# fixed values: the names the reports go by in run records
RECORD_NAMES = {"route_stats": "analysis_3_1", "delay_report": "analysis_3_2"}


def run(
    spark: SparkSession,
    report: str,
    choice: str,
    samples_root: str,
    scaled_root: str,
    outputs_root: str,
    logs_root: str,
    form: str = "dataframe",
    technology: str = "spark_sql",
    environment: str | None = None,
) -> list[dict]:
    """A sweep over all sizes starts its log anew; a single size adds to it."""
    analysis, done = RECORD_NAMES[report], []
    for at, size in enumerate(sizes(choice)):
        family = "scalability/" if size in SCALE_SIZES else ""
        place = f"{family}{analysis}/{technology}"
        source = variant_path(size, samples_root, scaled_root)
        output = f"{outputs_root}/{place}/{size}"
        start = time.monotonic()
        rows = write(spark, form, report, size, source, f"{output}/parquet", f"{output}/csv")
        seconds = time.monotonic() - start
        record = run_record(
            spark, analysis, technology, size, source, output, seconds, rows, environment
        )
        reset = at == 0 and choice in ("all", "scale_all")
        append_run_records(record, f"{logs_root}/{place}/timings.csv", reset, logs_root)
        done.append({"run_size": size, "seconds": round(seconds, 3), "output_rows": rows})
    return done


def main() -> None:
    parser = arguments(
        __doc__, "report", "size", "samples-root", "scaled-root", "outputs-root", "logs-root"
    )
    parser.add_argument("--form", choices=FORMS, default="dataframe")
    parser.add_argument("--technology", default="spark_sql")
    parser.add_argument("--environment")
    args = parser.parse_args()
    if args.report not in REPORTS:
        parser.error(f"unknown report {args.report}")
    spark = open_session("routeloom-sweep")
    for record in run(
        spark, args.report, args.size, args.samples_root, args.scaled_root,
        args.outputs_root, args.logs_root, args.form, args.technology, args.environment,
    ):
        show(record)
    spark.stop()


if __name__ == "__main__":
    main()
