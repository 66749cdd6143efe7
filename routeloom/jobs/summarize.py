"""Consolidate run logs into summaries and the seconds-per-technology matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import GateFailed
from ..plans import run_summary
from ..plans.consolidation import consolidate, has_records, stored_records
from ..schemas import SAMPLE_SIZES, SCALE_SIZES
from ..session import open_session
from ..sinks.files import publish_csv
from ..sources.runlog import SAMPLE_LOGS, SCALE_LOGS, read_logs, read_summary
from .common import arguments, show

# the summaries: name, rule for its logs, listed run sizes
FAMILIES = (
    ("benchmark_summary", SAMPLE_LOGS, SAMPLE_SIZES),
    ("scalability_summary", SCALE_LOGS, SCALE_SIZES),
)


def run(
    spark: SparkSession,
    logs_root: str,
    output_root: str,
    environment: bool = False,
    incremental: bool = False,
) -> dict:
    """Write ``benchmark_summary``, ``scalability_summary`` and ``run_matrix``.

    Logs with an environment keep listed sizes only, and every name in them must be
    listed; logs without keep all their records and list unknown names last. Where nothing
    is left to summarize, without sample records the job ends with an error, without scale
    records that summary is left as it is: an empty or mistyped root, or logs that hold
    nothing listed, never replace a summary.

    ``incremental`` keeps the records that have been read beside the summaries, and reads
    only logs that are new or have changed; the summaries are the same.
    """
    found = []
    for name, rule, listed in FAMILIES:
        sizes = listed if environment else None
        if incremental:
            store = f"{output_root}/{name}_records"
            consolidate(spark, logs_root, rule, store, environment, sizes)
            records = stored_records(spark, store) if has_records(spark, store) else None
        else:
            records = read_logs(spark, logs_root, rule, environment)
            records = records if sizes is None else run_summary.keep_sizes(records, sizes)
        if records is None or records.isEmpty():
            if name == "benchmark_summary":
                raise GateFailed(f"no run records below {logs_root}")
            continue
        if environment:
            run_summary.require_listed(records)
        found.append((name, listed, records))
    counts = {name: 0 for name, _, _ in FAMILIES}
    for name, listed, records in found:
        ordered = records.orderBy(*run_summary.listing_order(listed), "log_place")
        publish_csv(run_summary.summary(ordered, environment), f"{output_root}/{name}")
        counts[name] = records.count()
    combined = reduce(run_summary.combine, [records for _, _, records in found])
    publish_csv(run_summary.run_matrix(combined, "log_place"), f"{output_root}/run_matrix")
    return counts


def matrix_of_saved(spark: SparkSession, output_root: str, environment: bool = False) -> DataFrame:
    """The run matrix from saved summaries, listed sizes only.

    A summary does not say where its records came from, so of several in one cell the one
    with the latest time counts, then the one with more rows and the longer time.
    """
    families = [
        run_summary.keep_sizes(read_summary(spark, f"{output_root}/{name}", environment), listed)
        for name, _, listed in FAMILIES
    ]
    return run_summary.matrix_of_summary(run_summary.combine(*families))


def main() -> None:
    parser = arguments(__doc__, "logs-root", "output-root")
    parser.add_argument("--with-environment", action="store_true")
    parser.add_argument("--incremental", action="store_true", help="read only logs that are new or changed")
    parser.add_argument("--matrix-of-saved", action="store_true", help="show the matrix of earlier summaries, read no log")
    args = parser.parse_args()
    spark = open_session("routeloom-summarize")
    if args.matrix_of_saved:
        matrix_of_saved(spark, args.output_root, args.with_environment).show(100, truncate=False)
    else:
        show(run(spark, args.logs_root, args.output_root, args.with_environment, args.incremental))
    spark.stop()


if __name__ == "__main__":
    main()
