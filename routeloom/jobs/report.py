"""One report over a clean table, as Parquet and as CSV, with a preview."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..plans.reports import REPORTS, preview_report, write_report, write_report_tables
from ..schemas import SAMPLE_SIZES, SCALE_SIZES
from ..session import open_session
from .common import arguments, show

FORMS = ("dataframe", "tables")


def write(
    spark: SparkSession, form: str, report: str, size: str, source: str, parquet: str, csv: str
) -> int:
    """Write a report in one of its forms; tables are named by report and size."""
    if form == "tables":
        return write_report_tables(spark, report, source, parquet, csv, size=size)
    return write_report(spark, report, source, parquet, csv)


def main() -> None:
    parser = arguments(__doc__, "input", "parquet-output", "csv-output")
    parser.add_argument("--report", choices=sorted(REPORTS), required=True)
    parser.add_argument("--form", choices=FORMS, default="dataframe")
    parser.add_argument("--run-size", choices=(*SAMPLE_SIZES, *SCALE_SIZES), default="full")
    args = parser.parse_args()
    spark = open_session(f"routeloom-{args.report}")
    rows = write(
        spark, args.form, args.report, args.run_size,
        args.input, args.parquet_output, args.csv_output,
    )
    show({"run_size": args.run_size, "input": args.input, "output_rows": rows})
    preview_report(spark, args.report, args.parquet_output).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
