"""The registered queries. Each takes a session and a table folder and gives a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fingerprint import row_fingerprint
from ..jobs import clean as clean_job
from ..jobs import summarize
from ..plans import consolidation
from ..operators import grouping
from ..operators.compare import compare, compare_by_digest, only_in_left, surplus
from ..operators.ordering import offset_rows, prefix, row_total, sort_table, with_position
from ..operators.ordering import write_ordered
from ..operators.replicate import replicate, replicate_by_union
from ..plans import clean as cleaning
from ..plans import delay_report, route_stats, run_summary, samples
from ..plans.sql_reports import (
    DELAY_REPORT_EXPORT_SQL,
    DELAY_REPORT_SQL,
    ROUTE_STATS_EXPORT_SQL,
    ROUTE_STATS_SQL,
)
from ..schemas import (
    CLEAN_SCHEMA,
    DELAY_CAUSES,
    DELAY_REPORT_SCHEMA,
    ROUTE_STATS_SCHEMA,
    RUN_SCHEMA,
    SAMPLE_ORDER,
    SAMPLE_SIZES,
    SCALE_SIZES,
)
from ..session import scratch_path
from ..sinks.files import write_csv, write_parquet
from ..sinks.runlog import append_run_records
from ..sinks.tables import create_table_as, export_directory
from ..sources.adapters import (
    faulty_flights,
    flights,
    read_table,
    run_records,
    write_faulty_csv,
    write_raw_csv,
)
from ..sources.files import read_csv, read_parquet, read_raw_csv, sizes, variant_path
from ..sources.runlog import SAMPLE_LOGS, SCALE_LOGS, read_logs, read_run_records, read_summary
from ..sources.tables import drop_table, external_table, register_view, use_database

DATABASE = "routeloom"

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(flights(spark, sf_dir))


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights with faults, written as CSV and read back."""
    path = scratch_path(spark, "raw_csv")
    write_faulty_csv(spark, sf_dir, path)
    return read_raw_csv(spark, path)


def clean_path(spark: SparkSession, sf_dir: str) -> str:
    """The clean table, written as a Parquet folder."""
    path = scratch_path(spark, "clean")
    write_parquet(clean(spark, sf_dir), path)
    return path


def sorted_path(spark: SparkSession, sf_dir: str) -> str:
    """The clean table in sample order, written."""
    path = scratch_path(spark, "sorted")
    sort_table(spark, clean_path(spark, sf_dir), SAMPLE_ORDER, path)
    return path


def ordered(table: DataFrame, order) -> DataFrame:
    """The table with a position column that states its order."""
    spark = table.sparkSession
    path = scratch_path(spark, "ordered")
    write_ordered(table, order, path)
    return with_position(spark, path)


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem")


@query
def scan_csv(spark, sf_dir):
    """Raw text in files of two column orders, read by their headers, every column as text.

    The rows are parted by a column of the order lines alone, before anything is joined to
    them, so that both parts together take the work of one.
    """
    path = scratch_path(spark, "two_headers")
    rows = faulty_flights(spark, sf_dir)
    first = F.pmod(F.xxhash64("op_carrier_fl_num"), F.lit(2)) == 0
    write_raw_csv(rows.filter(first), path)
    write_raw_csv(rows.filter(~first).select(*reversed(rows.columns)), path, "append")
    return read_raw_csv(spark, path).select(*rows.columns)


@query
def scan_temp_view(spark, sf_dir):
    register_view(clean(spark, sf_dir), "flights_clean_view")
    return spark.sql(
        "SELECT origin, dest, count(*) AS flight_count FROM flights_clean_view GROUP BY ALL"
    )


@query
def write_parquet_overwrite(spark, sf_dir):
    """Written twice to one path: the second write replaces the first."""
    path = scratch_path(spark, "parquet")
    source = read_parquet(spark, clean_path(spark, sf_dir))
    write_parquet(source.filter(F.col("is_cancelled") == 1), path)
    write_parquet(source, path)
    return read_parquet(spark, path)


@query
def write_csv_overwrite(spark, sf_dir):
    path = scratch_path(spark, "csv")
    source = read_parquet(spark, clean_path(spark, sf_dir))
    write_csv(source.filter(F.col("is_cancelled") == 1), path)
    write_csv(source, path)
    return read_csv(spark, path, CLEAN_SCHEMA)


def _external(spark, sf_dir, table):
    return external_table(spark, DATABASE, table, CLEAN_SCHEMA, clean_path(spark, sf_dir))


@query
def external_table_scan(spark, sf_dir):
    """Create, drop and create again: dropping must leave the files in place.

    Read by its plain name in the database in use; the one used before is put back.
    """
    before = spark.catalog.currentDatabase()
    _external(spark, sf_dir, "flights_clean")
    drop_table(spark, DATABASE, "flights_clean")
    _external(spark, sf_dir, "flights_clean")
    use_database(spark, DATABASE)
    try:
        table = spark.table("flights_clean")
    finally:
        spark.catalog.setCurrentDatabase(before)
    return table.groupBy("op_unique_carrier").agg(
        F.count(F.lit(1)).alias("flight_count"), F.min("fl_date").alias("first_date")
    )


@query
def ctas_route_stats(spark, sf_dir):
    source = _external(spark, sf_dir, "flights_clean_r1")
    path = scratch_path(spark, "ctas_route_stats")
    return create_table_as(spark, DATABASE, "route_stats", path, ROUTE_STATS_SQL, flights=source)


@query
def ctas_delay_report(spark, sf_dir):
    source = _external(spark, sf_dir, "flights_clean_r2")
    path = scratch_path(spark, "ctas_delay_report")
    return create_table_as(spark, DATABASE, "delay_report", path, DELAY_REPORT_SQL, flights=source)


@query
def export_route_stats(spark, sf_dir):
    path = scratch_path(spark, "export")
    report = ctas_route_stats(spark, sf_dir)
    export_directory(spark, path, ROUTE_STATS_EXPORT_SQL, report=report)
    return read_csv(spark, path, ROUTE_STATS_SCHEMA)


@query
def export_delay_report(spark, sf_dir):
    path = scratch_path(spark, "export")
    report = ctas_delay_report(spark, sf_dir)
    export_directory(spark, path, DELAY_REPORT_EXPORT_SQL, report=report)
    return read_csv(spark, path, DELAY_REPORT_SCHEMA)


# --- cleaning --------------------------------------------------------------------------


@query
def typed_projection(spark, sf_dir):
    return cleaning.typed(raw_text(spark, sf_dir))


@query
def normalize_codes(spark, sf_dir):
    raw = raw_text(spark, sf_dir).select("op_unique_carrier", "origin", "origin_city_name")
    read = raw.select(
        F.col("op_unique_carrier").alias("raw_carrier"),
        F.col("origin").alias("raw_origin"),
        cleaning.text.code(F.col("op_unique_carrier")).alias("carrier"),
        cleaning.text.code(F.col("origin")).alias("origin"),
        cleaning.text.name(F.col("origin_city_name")).alias("city"),
    )
    return read.groupBy(*read.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def parse_dates(spark, sf_dir):
    raw = raw_text(spark, sf_dir)
    read = raw.select(
        F.col("fl_date").alias("raw_date"), cleaning.text.to_date(F.col("fl_date")).alias("fl_date")
    )
    return read.groupBy(*read.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def derive_route(spark, sf_dir):
    routes = flights(spark, sf_dir).select("origin", "dest", cleaning.route().alias("route"))
    return routes.groupBy("origin", "dest", "route").agg(F.count(F.lit(1)).alias("n"))


@query
def cancel_flag(spark, sf_dir):
    rows = cleaning.typed(raw_text(spark, sf_dir))
    flags = rows.select("cancelled", cleaning.is_cancelled().alias("is_cancelled"))
    return flags.groupBy("cancelled", "is_cancelled").agg(F.count(F.lit(1)).alias("n"))


@query
def delay_bands(spark, sf_dir):
    rows = flights(spark, sf_dir)
    bands = rows.select("dep_delay", cleaning.delay_band().alias("departure_delay_band"))
    return bands.groupBy(*bands.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def primary_cause(spark, sf_dir):
    inputs = ["cancelled", "cancellation_code", *DELAY_CAUSES]
    causes = flights(spark, sf_dir).select(
        *inputs, cleaning.primary_cause().alias("primary_disruption_cause")
    )
    return causes.groupBy(*causes.columns).agg(F.count(F.lit(1)).alias("n"))


@query
def clean_rules(spark, sf_dir):
    return cleaning.rule_counts(raw_text(spark, sf_dir))


@query
def clean_table(spark, sf_dir):
    return cleaning.clean(raw_text(spark, sf_dir))


@query
def clean_table_typed(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def quality_metrics(spark, sf_dir):
    return cleaning.account(raw_text(spark, sf_dir))


@query
def clean_job_published(spark, sf_dir):
    """The cleaning job over raw text, twice to one path: its published rows."""
    raw, path = scratch_path(spark, "raw_csv"), scratch_path(spark, "published")
    write_faulty_csv(spark, sf_dir, raw, clean_job.TEXT_CODEC)
    for _ in range(2):
        clean_job.run(spark, raw, path, f"{path}_csv")
    return read_parquet(spark, path)


@query
def quality_metrics_parts(spark, sf_dir):
    """The counts of a cleaning run from its parts."""
    return cleaning.account_parts(cleaning.parted(raw_text(spark, sf_dir)))


# --- route statistics ------------------------------------------------------------------


@query
def route_stats_report(spark, sf_dir):
    return route_stats.route_stats(clean(spark, sf_dir))


def wide_months(spark, sf_dir):
    """The clean table with month numbers of one to three digits, some beyond any calendar."""
    month = F.col("month") + F.col("month") % 3 * 60
    return clean(spark, sf_dir).withColumn("month", month.cast("int"))


@query
def route_stats_wide_months(spark, sf_dir):
    return route_stats.route_stats(wide_months(spark, sf_dir))


@query
def ctas_route_stats_wide_months(spark, sf_dir):
    path = scratch_path(spark, "wide_months")
    write_parquet(wide_months(spark, sf_dir), path)
    source = external_table(spark, DATABASE, "flights_clean_wide", CLEAN_SCHEMA, path)
    target = scratch_path(spark, "ctas_route_stats_wide")
    return create_table_as(spark, DATABASE, "route_stats_wide", target, ROUTE_STATS_SQL, flights=source)


@query
def operating_months_padded_wide(spark, sf_dir):
    return route_stats.operating_months_padded(wide_months(spark, sf_dir))


@query
def delay_report_new_cause(spark, sf_dir):
    """A cause that no list names."""
    cause = F.when(
        (F.col("month") % 2 == 0) & (F.col("primary_disruption_cause") != "none"), "strike"
    ).otherwise(F.col("primary_disruption_cause"))
    table = clean(spark, sf_dir).withColumn("primary_disruption_cause", cause)
    return delay_report.delay_report(table)


@query
def replica_variants(spark, sf_dir):
    """Replicas written, found by size name and counted, beside the rows they should have."""
    root, source = scratch_path(spark, "scaled"), clean_path(spark, sf_dir)
    made = {x["scale"]: x for x in samples.write_replicas(spark, source, root)}
    total = row_total(spark, source)
    parts = [
        read_parquet(spark, variant_path(size, root, root)).agg(
            F.lit(size).alias("scale"),
            F.lit(total * made[size]["factor"]).cast("long").alias("expected_rows"),
            F.count(F.lit(1)).alias("variant_rows"),
        )
        for size in sizes("scale_all")
    ]
    return samples.union_all(parts)


@query
def operating_months(spark, sf_dir):
    return route_stats.operating_months(clean(spark, sf_dir))


@query
def operating_months_padded(spark, sf_dir):
    return route_stats.operating_months_padded(clean(spark, sf_dir))


@query
def route_stats_ordered(spark, sf_dir):
    return ordered(route_stats_report(spark, sf_dir), route_stats.order())


@query
def preview_top10(spark, sf_dir):
    """The first ten rows; numbering ten rows needs no more than one task."""
    first = samples.preview(route_stats_report(spark, sf_dir), route_stats.order(), 10)
    return samples.number_few(first, route_stats.order())


# --- delay-band report -----------------------------------------------------------------


@query
def band_metrics(spark, sf_dir):
    return delay_report.band_metrics(clean(spark, sf_dir))


@query
def cause_counts(spark, sf_dir):
    return delay_report.cause_counts(clean(spark, sf_dir))


@query
def ranked_causes(spark, sf_dir):
    return delay_report.ranked_causes(clean(spark, sf_dir))


@query
def top_causes_struct(spark, sf_dir):
    return delay_report.top_causes(clean(spark, sf_dir))


@query
def top_causes_pivot(spark, sf_dir):
    return delay_report.top_causes(clean(spark, sf_dir), by_rank=True)


@query
def delay_report_counted(spark, sf_dir):
    return delay_report.counted(clean(spark, sf_dir))


@query
def delay_report_onepass(spark, sf_dir):
    return delay_report.one_pass(clean(spark, sf_dir))


@query
def delay_report_windowed(spark, sf_dir):
    return delay_report.windowed(clean(spark, sf_dir))


@query
def delay_report_windowed_pivot(spark, sf_dir):
    return delay_report.windowed(clean(spark, sf_dir), by_rank=True)


@query
def delay_report_ordered(spark, sf_dir):
    return ordered(delay_report_onepass(spark, sf_dir), delay_report.order())


# --- samples, replicas, comparison -----------------------------------------------------


@query
def row_fingerprints(spark, sf_dir):
    table = clean(spark, sf_dir)
    prints = table.select(row_fingerprint(table.columns).alias("fingerprint"), "fl_date", "route")
    return prints.groupBy(*prints.columns).agg(F.count(F.lit(1)).alias("copies"))


@query
def sample_order(spark, sf_dir):
    """The whole clean table with each row's place in sample order."""
    return with_position(spark, sorted_path(spark, sf_dir))


@query
def prefix_sample(spark, sf_dir):
    """The first half of the clean table in sample order."""
    path = sorted_path(spark, sf_dir)
    return prefix(spark, path, row_total(spark, path) // 2)


@query
def prefix_variants(spark, sf_dir):
    """Rows and last date of each named sample."""
    path = sorted_path(spark, sf_dir)
    total, offsets = row_total(spark, path), offset_rows(spark, path)
    parts = []
    for size in SAMPLE_SIZES:
        rows = samples.target_rows(size, total)
        part = prefix(spark, path, rows, offsets).agg(
            F.lit(size).alias("sample"),
            F.lit(rows).cast("long").alias("target_rows"),
            F.count(F.lit(1)).alias("sample_rows"),
            F.max("fl_date").alias("last_date"),
            F.sum("arr_delay").alias("arr_delay_sum"),
        )
        parts.append(part)
    return samples.union_all(parts)


@query
def replicate_rows(spark, sf_dir):
    """Rows per scale factor and carrier, by explode and by union."""
    table = clean(spark, sf_dir).select("op_unique_carrier")
    parts = []
    for size, copies in samples.SCALE_FACTORS.items():
        for form, build in (("explode", replicate), ("union", replicate_by_union)):
            part = build(table, copies).groupBy("op_unique_carrier").agg(
                F.count(F.lit(1)).alias("n")
            )
            parts.append(part.select(F.lit(size).alias("scale"), F.lit(form).alias("form"), "*"))
    return samples.union_all(parts)


@query
def route_stats_scaled(spark, sf_dir):
    return route_stats.route_stats(replicate(clean(spark, sf_dir), 4))


@query
def delay_report_scaled(spark, sf_dir):
    return delay_report.delay_report(replicate(clean(spark, sf_dir), 4))


@query
def compare_outputs(spark, sf_dir):
    """Two forms of the delay report hold the same rows."""
    table = read_parquet(spark, clean_path(spark, sf_dir))
    return compare(delay_report.windowed(table, by_rank=True), delay_report.one_pass(table))


@query
def compare_outputs_differing(spark, sf_dir):
    """Two tables with common rows, rows of their own and different numbers of copies."""
    table = read_parquet(spark, clean_path(spark, sf_dir))
    rows = table.select("origin", "month", "departure_delay_band")
    return compare(rows.filter("month <= 8"), rows.filter("month >= 5"))


@query
def compare_outputs_digest(spark, sf_dir):
    """As ``compare_outputs``; equal digests leave no full row to shuffle."""
    table = read_parquet(spark, clean_path(spark, sf_dir))
    return compare_by_digest(delay_report.windowed(table, by_rank=True), delay_report.one_pass(table))


@query
def compare_outputs_digest_differing(spark, sf_dir):
    """As ``compare_outputs_differing``, where the buckets of both differ."""
    table = read_parquet(spark, clean_path(spark, sf_dir))
    rows = table.select("origin", "month", "departure_delay_band")
    return compare_by_digest(rows.filter("month <= 8"), rows.filter("month >= 5"))


def _halves(spark, sf_dir):
    table = read_parquet(spark, clean_path(spark, sf_dir))
    names = ["origin", "dest", "departure_delay_band"]
    return table.filter("month <= 6").select(*names), table.filter("month > 6").select(*names)


@query
def multiset_difference(spark, sf_dir):
    """Rows of one half of the year beyond their copies in the other."""
    return only_in_left(*_halves(spark, sf_dir))


@query
def multiset_surplus(spark, sf_dir):
    """The same counted per distinct row."""
    return surplus(*_halves(spark, sf_dir))


# --- run records -----------------------------------------------------------------------


def _plain(records: DataFrame) -> DataFrame:
    return records.select(*RUN_SCHEMA.names)


@query
def append_run_record(spark, sf_dir):
    """A log reset by one write and grown by two more."""
    path = scratch_path(spark, "log")
    records = run_records(spark, sf_dir)
    append_run_records(_plain(records), path)
    append_run_records(_plain(records.filter("event_id % 3 = 0")), path, reset=True)
    append_run_records(_plain(records.filter("event_id % 3 = 1")), path)
    append_run_records(_plain(records.filter("event_id % 3 = 2")), path)
    return read_run_records(spark, path).drop("log_place")


@query
def consolidate_runs(spark, sf_dir):
    """Logs of two families written, read by pattern, filtered, joined up and listed."""
    root = scratch_path(spark, "logs")
    records = run_records(spark, sf_dir)
    local = _plain(records.filter("environment IS NULL"))
    is_scale = F.col("run_size").isin(*SCALE_SIZES)
    place = "analysis_3_x/engine/timings.csv"
    append_run_records(local.filter(~is_scale), f"{root}/local/{place}")
    append_run_records(local.filter(is_scale), f"{root}/local/scalability/{place}")
    append_run_records(
        records.filter("environment IS NOT NULL").drop("event_id"), f"{root}/cluster/{place}"
    )
    read = run_summary.combine(
        run_summary.combine(
            read_logs(spark, f"{root}/local", SAMPLE_LOGS),
            read_logs(spark, f"{root}/local", SCALE_LOGS),
        ),
        run_summary.keep_sizes(
            read_logs(spark, f"{root}/cluster", SAMPLE_LOGS, environment=True),
            run_summary.ALL_SIZES,
        ),
    )
    write_csv(run_summary.summary(read, environment=True), f"{root}/summary")
    listed = read_summary(spark, f"{root}/summary", environment=True).unionByName(
        read_summary(spark, f"{root}/no_such_summary", environment=True)
    )
    order = [*run_summary.listing_order(run_summary.ALL_SIZES), "run_timestamp", "output_rows"]
    return ordered(run_summary.summary(listed, environment=True), order)


@query
def consolidate_runs_incremental(spark, sf_dir):
    """Logs consolidated when half of them were there, after one was started anew, and at the end."""
    root = scratch_path(spark, "growing_logs")
    records = run_records(spark, sf_dir)
    local, cluster = records.filter("environment IS NULL"), records.filter("environment IS NOT NULL")
    early = F.col("event_id") % 2 == 0
    place = "analysis_3_x/engine"

    def bring_up() -> list[DataFrame]:
        for name, environment, sizes in (("local", False, None), ("cluster", True, run_summary.ALL_SIZES)):
            consolidation.consolidate(spark, f"{root}/{name}", SAMPLE_LOGS, f"{root}/{name}_store", environment, sizes)
        return [consolidation.stored_records(spark, f"{root}/{name}_store") for name in ("local", "cluster")]

    append_run_records(_plain(local.filter(early)), f"{root}/local/{place}/timings.csv")
    append_run_records(_plain(local), f"{root}/local/{place}/late/timings.csv")
    append_run_records(cluster.filter(early).drop("event_id"), f"{root}/cluster/{place}/timings.csv")
    bring_up()
    append_run_records(_plain(local.filter(~early)), f"{root}/local/{place}/late/timings.csv", reset=True)
    append_run_records(cluster.filter(~early).drop("event_id"), f"{root}/cluster/{place}/timings.csv")
    read = run_summary.combine(*bring_up())
    order = [*run_summary.listing_order(run_summary.ALL_SIZES), "run_timestamp", "output_rows"]
    return ordered(run_summary.summary(read, environment=True), order)


@query
def run_matrix_from_logs(spark, sf_dir):
    """Records appended to logs at one, two and seven levels; the last append counts."""
    root = scratch_path(spark, "matrix_logs")
    stamped = run_records(spark, sf_dir).filter("environment IS NULL").withColumn(
        "run_timestamp", F.lpad(F.col("event_id").cast("string"), 12, "0")
    )
    for turn, place in enumerate(("z/y/x/w/v/u/t", "a", "m/n")):
        part = stamped.filter(F.col("event_id") % 3 == turn)
        append_run_records(_plain(part), f"{root}/analysis_3_x/{place}/timings.csv", root=root)
    read = read_logs(spark, root, SAMPLE_LOGS)
    return run_summary.run_matrix(run_summary.keep_sizes(read, run_summary.ALL_SIZES), "log_place")


@query
def run_matrix_of_saved(spark, sf_dir):
    """The matrix of summaries that the summary job has saved from logs of both families."""
    root = scratch_path(spark, "saved")
    local = _plain(run_records(spark, sf_dir).filter("environment IS NULL"))
    is_scale = F.col("run_size").isin(*SCALE_SIZES)
    append_run_records(local.filter(~is_scale), f"{root}/logs/analysis_3_x/timings.csv")
    append_run_records(local.filter(is_scale), f"{root}/logs/scalability/analysis_3_x/timings.csv")
    summarize.run(spark, f"{root}/logs", f"{root}/out")
    return summarize.matrix_of_saved(spark, f"{root}/out")


@query
def run_matrix(spark, sf_dir):
    records = run_records(spark, sf_dir)
    both = run_summary.combine(
        run_summary.keep_sizes(records, SAMPLE_SIZES), run_summary.keep_sizes(records, SCALE_SIZES)
    )
    return run_summary.run_matrix(both, "event_id")


# --- the same operators on another table -----------------------------------------------


def _events(spark, sf_dir):
    """Events with the value in whole cents, so that sums are exact in any order."""
    events = read_table(spark, sf_dir, "events")
    return events.select(
        "user_id",
        "event_type",
        F.month("ts").alias("event_month"),
        F.dayofmonth("ts").alias("day"),
        F.round(F.col("value") * 100).alias("cents"),
        cleaning.labels.flag(F.col("event_type") == "error").alias("is_error"),
    )


@query
def events_stats(spark, sf_dir):
    return grouping.group_stats(
        _events(spark, sf_dir),
        ["user_id"],
        measure="cents",
        flag="is_error",
        member="day",
        names=["event_count", "min_cents", "max_cents", "avg_cents", "error_rate", "days"],
    )


@query
def events_top_types(spark, sf_dir):
    return grouping.top_k_by_count(
        _events(spark, sf_dir), ["user_id", "event_month"], "event_type", 3
    )
