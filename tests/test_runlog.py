import os
import shutil

import pytest

from routeloom.plans import run_summary
from routeloom.operators.quality import GateFailed
from routeloom.schemas import RUN_SCHEMA, RUN_SCHEMA_WITH_ENVIRONMENT
from routeloom.jobs import summarize
from routeloom.sinks.runlog import append_run_records, run_record
from routeloom.plans.consolidation import consolidate, stored_records
from routeloom.sources.published import Folder, published
from routeloom.sources.runlog import SAMPLE_LOGS, SCALE_LOGS, log_files, read_logs, read_run_records, read_summary

HEAD = ",".join(RUN_SCHEMA.names)
LONG_HEAD = ",".join(RUN_SCHEMA_WITH_ENVIRONMENT.names)


def line(analysis, technology, size, seconds, environment=None):
    text = f'"{analysis}","{technology}","{size}","/in","/out, x",{seconds},7,"2024-01-01T00:00:00Z"'
    return text if environment is None else f'{text},"{environment}"'


def put(root, place, lines):
    path = root / place / "timings.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture
def logs(tmp_path):
    put(tmp_path, "analysis_3_1/hive", [
        HEAD, line("analysis_3_1", "hive", "full", 3), line("analysis_3_1", "hive", "100k", 1.5),
        line("analysis_3_1", "hive", "100k", 1.25), line("analysis_3_1", "hive", "odd", 9),
    ])
    put(tmp_path, "analysis_3_1/spark_sql", [
        HEAD, line("analysis_3_1", "spark_sql", "100k", 2.0004), line("analysis_3_1", "other", "100k", 4),
    ])
    put(tmp_path, "scalability/analysis_3_2/hive", [HEAD, line("analysis_3_2", "hive", "2x", 8)])
    return tmp_path


def test_summaries_and_matrix(spark, logs, tmp_path):
    out = tmp_path / "out"
    counts = summarize.run(spark, str(logs), str(out))
    assert counts == {"benchmark_summary": 6, "scalability_summary": 1}
    text = spark.read.option("header", True).csv(published(spark, str(out / "benchmark_summary")))
    assert text.columns[:5] == [
        "analysis", "technology", "run_size", "execution_time_seconds", "output_rows"
    ]
    listed = [(r.run_size, r.technology, r.execution_time_seconds) for r in text.collect()]
    assert listed == [
        ("100k", "spark_sql", "2.000"), ("100k", "hive", "1.500"), ("100k", "hive", "1.250"),
        ("100k", "other", "4.000"), ("full", "hive", "3.000"), ("odd", "hive", "9.000"),
    ]
    cells = spark.read.option("header", True).csv(published(spark, str(out / "run_matrix"))).collect()
    found = {(r.analysis, r.run_size): (r.spark_sql, r.spark_core, r.hive) for r in cells}
    assert found[("analysis_3_1", "100k")] == ("2.0004", None, "1.25")
    assert found[("analysis_3_2", "2x")] == (None, None, "8.0")


def test_family_with_environment(spark, tmp_path):
    put(tmp_path, "analysis_3_1/hive", [
        LONG_HEAD, line("analysis_3_1", "hive", "full", "3.100", "cluster"),
        line("analysis_3_1", "hive", "odd", "9.000", "cluster"),
    ])
    counts = summarize.run(spark, str(tmp_path), str(tmp_path / "out"), environment=True)
    assert counts == {"benchmark_summary": 1, "scalability_summary": 0}
    summary = read_summary(spark, str(tmp_path / "out/benchmark_summary"), environment=True)
    assert summary.columns == RUN_SCHEMA_WITH_ENVIRONMENT.names
    assert summary.first().environment == "cluster"
    put(tmp_path, "analysis_3_1/other", [
        LONG_HEAD, line("analysis_3_1", "other", "full", "3.100", "cluster"),
    ])
    with pytest.raises(GateFailed, match="unknown_technologies=1"):
        summarize.run(spark, str(tmp_path), str(tmp_path / "out"), environment=True)


def test_wrong_family_is_refused(spark, tmp_path):
    put(tmp_path, "analysis_3_1/hive", [LONG_HEAD, line("a", "hive", "full", 3, "cluster")])
    with pytest.raises(Exception, match="(?i)header"):
        read_run_records(spark, str(tmp_path / "analysis_3_1/hive/timings.csv")).collect()


def test_missing_summary_is_empty(spark, tmp_path):
    assert read_summary(spark, str(tmp_path / "nothing")).count() == 0
    assert read_logs(spark, str(tmp_path / "nothing"), SAMPLE_LOGS).count() == 0
    assert read_run_records(spark, str(tmp_path / "nothing/x.csv")).count() == 0


def test_log_is_reset_then_grows(spark, tmp_path):
    path = str(tmp_path / "timings.csv")
    for at, reset in enumerate((False, False, True, False)):
        record = run_record(spark, "analysis_3_1", "hive", "full", '/a "b", c', "/o", at + 0.5, at)
        append_run_records(record, path, reset)
    rows = read_run_records(spark, path).orderBy("log_place").collect()
    assert [(r.output_rows, r.execution_time_seconds) for r in rows] == [(2, 2.5), (3, 3.5)]
    assert rows[0].input_path == '/a "b", c'
    assert rows[0].run_timestamp.endswith("Z") and len(rows[0].run_timestamp) == 20


def test_combining_families_fills_the_environment(spark):
    short = spark.createDataFrame([], RUN_SCHEMA)
    long = run_record(spark, "a", "t", "1x", "i", "o", 1, 1, "cluster")
    both = run_summary.combine(short, long)
    assert both.columns == RUN_SCHEMA_WITH_ENVIRONMENT.names and both.count() == 1


def test_logs_at_any_depth_and_nothing_else(spark, tmp_path):
    for depth, place in enumerate(("analysis_3_1", "analysis_3_1/a", "analysis_3_2/a/b/c/d/e/f/g")):
        put(tmp_path, place, [HEAD, line("analysis_3_1", "hive", "full", depth)])
    put(tmp_path, "scalability/analysis_3_1/a/b", [HEAD, line("analysis_3_1", "hive", "2x", 7)])
    put(tmp_path, "other/analysis_3_1", ["not,a,log", "1,2,3"])
    (tmp_path / "analysis_3_1/timings.csv.bak").write_text("nor this\n")
    found = read_logs(spark, str(tmp_path), SAMPLE_LOGS).collect()
    assert sorted(r.execution_time_seconds for r in found) == [0, 1, 2]
    assert [r.run_size for r in read_logs(spark, str(tmp_path), SCALE_LOGS).collect()] == ["2x"]


@pytest.mark.parametrize("first, second", [("a", "b"), ("b", "a"), ("a/z", "a"), ("a", "a/z")])
def test_the_later_of_two_appends_in_one_second_counts(spark, tmp_path, first, second):
    """Whatever the folders are called, and after the logs were copied file by file in any order."""
    root = str(tmp_path / "logs")
    for seconds, place in ((1.0, first), (2.0, second)):
        record = run_record(spark, "analysis_3_1", "hive", "full", "/i", "/o", seconds, 1)
        same_time = record.withColumn("run_timestamp", record.run_timestamp.substr(1, 0))
        append_run_records(same_time, f"{root}/analysis_3_1/{place}/timings.csv", root=root)
    copied = str(tmp_path / "copied")
    for file in sorted(log_files(spark, root, SAMPLE_LOGS), key=lambda x: x.path, reverse=first == "a"):
        target = file.path.removeprefix("file:").replace(root, copied)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        shutil.copyfile(file.path.removeprefix("file:"), target)
    for place in (root, copied):
        cell = run_summary.run_matrix(read_logs(spark, place, SAMPLE_LOGS), "log_place").first()
        assert cell.hive == 2.0
    # numbers go on after a copy
    record = run_record(spark, "analysis_3_1", "hive", "full", "/i", "/o", 3.0, 1)
    append_run_records(record, f"{copied}/analysis_3_1/{first}/timings.csv", root=copied)
    numbers = sorted(r.log_place["append"] for r in read_logs(spark, copied, SAMPLE_LOGS).collect())
    assert numbers == [1, 2, 3]


def test_a_reset_counts_before_it_has_deleted(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "timings.csv")
    for seconds in (1.0, 2.0):
        append_run_records(run_record(spark, "a", "t", "full", "/i", "/o", seconds, 1), path)
    monkeypatch.setattr(Folder, "delete", lambda self, name: None)
    append_run_records(run_record(spark, "a", "t", "full", "/i", "/o", 3.0, 1), path, reset=True)
    append_run_records(run_record(spark, "a", "t", "full", "/i", "/o", 4.0, 1), path)
    assert sorted(r.execution_time_seconds for r in read_run_records(spark, path).collect()) == [3.0, 4.0]


def test_incremental_consolidation(spark, logs, tmp_path):
    """Only new and changed logs are read; the result is that of reading all of them."""
    store, root = str(tmp_path / "store"), str(logs)

    def step(**kwargs):
        done = consolidate(spark, root, SAMPLE_LOGS, store, **kwargs)
        mine = sorted(map(str, stored_records(spark, store).drop("log_place", "log_file").collect()))
        assert mine == sorted(map(str, read_logs(spark, root, SAMPLE_LOGS).drop("log_place").collect()))
        return done["files_kept"], done["files_read"], done["files_gone"], done["changed"]

    assert step() == (0, 2, 0, True)
    assert step() == (2, 0, 0, False)
    put(logs, "analysis_3_2/x/y/z", [HEAD, line("analysis_3_2", "hive", "half", 5)])
    assert step() == (2, 1, 0, True)
    put(logs, "analysis_3_1/hive", [HEAD, line("analysis_3_1", "hive", "full", 3.25)])
    assert step() == (2, 1, 0, True)
    os.remove(logs / "analysis_3_2/x/y/z/timings.csv")
    assert step() == (2, 0, 1, True)
    before = published(spark, store)
    for args in (("/no/such/root", None), (root, ["unlisted"])):
        other = consolidate(spark, args[0], SAMPLE_LOGS, store, sizes=args[1])
        assert not other["changed"] and published(spark, store) == before


def test_incremental_summary_job_equals_the_full_one(spark, logs, tmp_path):
    whole, grown = str(tmp_path / "whole"), str(tmp_path / "grown")
    assert summarize.run(spark, str(logs), grown, incremental=True) == {"benchmark_summary": 6, "scalability_summary": 1}
    put(logs, "analysis_3_2/late", [HEAD, line("analysis_3_2", "spark_core", "half", 6)])
    assert summarize.run(spark, str(logs), grown, incremental=True) == summarize.run(spark, str(logs), whole)
    for name in ("benchmark_summary", "scalability_summary", "run_matrix"):
        texts = [spark.read.text(published(spark, f"{root}/{name}")).collect() for root in (whole, grown)]
        assert sorted(map(str, texts[0])) == sorted(map(str, texts[1]))
    cells = {(r.analysis, r.run_size): r.hive for r in summarize.matrix_of_saved(spark, whole).collect()}
    assert cells == {("analysis_3_1", "100k"): 1.5, ("analysis_3_1", "full"): 3.0, ("analysis_3_2", "2x"): 8.0,
                     ("analysis_3_2", "half"): None}


@pytest.mark.parametrize("incremental", [False, True])
def test_logs_with_nothing_listed_leave_the_summary(spark, tmp_path, incremental):
    out = str(tmp_path / "out")
    put(tmp_path, "good/analysis_3_1/hive", [LONG_HEAD, line("analysis_3_1", "hive", "full", 3, "cluster")])
    summarize.run(spark, str(tmp_path / "good"), out, environment=True, incremental=incremental)
    put(tmp_path, "odd/analysis_3_1/hive", [LONG_HEAD, line("analysis_3_1", "hive", "odd", 9, "cluster")])
    if incremental:  # what was consolidated stays as it is
        summarize.run(spark, str(tmp_path / "odd"), out, environment=True, incremental=True)
    else:
        with pytest.raises(GateFailed, match="no run records"):
            summarize.run(spark, str(tmp_path / "odd"), out, environment=True)
    assert read_summary(spark, f"{out}/benchmark_summary", environment=True).count() == 1
