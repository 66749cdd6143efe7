"""What the physical plans must look like to hold at scale."""

import re

import pytest

from routeloom.plans import clean as cleaning
from routeloom.plans import delay_report, route_stats
from routeloom.operators.compare import compare
from routeloom.operators.ordering import with_position
from routeloom.operators.replicate import replicate
from routeloom.registry.queries import QUERIES
from routeloom.session import scratch_path, scratch_root
from routeloom.sources.adapters import faulty_flights, flights


@pytest.fixture(scope="module")
def table(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    cleaning.clean(flights(spark, data)).write.parquet(path)
    return spark.read.parquet(path)


def plan(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text


def test_route_stats_combines_rows_by_hash(table):
    """Rows are combined per group and month by hash; only the months left are collected."""
    text = plan(route_stats.route_stats(table))
    assert text.count("Exchange hashpartitioning") <= 2
    assert "HashAggregate(keys=[op_unique_carrier" in text or "HashAggregate" in text
    assert "ReadSchema: struct<month:int,op_unique_carrier:string,route:string,arr_delay:double" in text


def test_delay_report_is_one_hash_aggregation(table):
    text = plan(delay_report.counted(table))
    assert text.count("Exchange") == 1 and "Join" not in text and "Window" not in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    assert "PushedFilters: [In(departure_delay_band" in text


def test_one_pass_scans_once(table):
    text = plan(delay_report.one_pass(table))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


def test_top_items_are_cut_before_the_shuffle(table):
    text = plan(delay_report.top_causes(table))
    assert text.count("WindowGroupLimit") == 2


def test_comparison_is_one_row_shuffle(table):
    text = plan(compare(route_stats.route_stats(table), route_stats.route_stats(table)))
    assert "Generate" not in text and "CartesianProduct" not in text


def test_positions_do_not_shuffle_the_table(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    frame = with_position(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(frame.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_replica_needs_no_shuffle(table):
    text = plan(replicate(table, 4))
    assert "Exchange" not in text and text.count("FileScan") == 1


@pytest.mark.parametrize(
    "name", ["route_stats_report", "delay_report_counted", "clean_table", "quality_metrics",
             "delay_report_windowed", "run_matrix", "events_stats", "events_top_types"]
)
def test_no_python_and_no_cross_join(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert bad not in text


JIT_LIMIT = 8000


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize(
    "name", ["clean_table", "clean_table_typed", "typed_projection", "quality_metrics",
             "route_stats_report", "delay_report_counted", "delay_report_windowed",
             "row_fingerprints", "clean_rules", "scan_csv"]
)
def test_stages_are_short_enough_to_be_compiled(spark, data, whole_plans, name):
    """The JVM interprets methods beyond 8000 bytes, ten times slower."""
    frame = QUERIES[name](spark, data).select("*")
    text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert max(sizes, default=0) < JIT_LIMIT


def test_faulty_rows_are_short_enough_to_be_compiled(spark, data, whole_plans):
    frame = faulty_flights(spark, data).select("*")
    text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < JIT_LIMIT


def test_scratch_follows_the_cluster_setting(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or scratch_root(spark) == before.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
