"""The jobs one after another, from raw text to the run matrix."""

import os
import subprocess
import sys

import pytest

from routeloom.jobs import clean as clean_job
from routeloom.jobs import summarize, sweep
from routeloom.session import remove_scratch, scratch_path
from routeloom.sinks.files import write_checked
from routeloom.operators.compare import require_same
from routeloom.operators.quality import GateFailed
from routeloom.plans import clean as cleaning
from routeloom.plans.reports import preview_report, write_report, write_report_tables
from routeloom.plans.samples import write_replicas, write_samples
from routeloom.schemas import CLEAN_SCHEMA, DELAY_REPORT_SCHEMA, ROUTE_STATS_SCHEMA
from routeloom.sources.adapters import write_faulty_csv
from routeloom.sources.files import read_csv, read_parquet, read_raw_csv, sizes, variant_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def made(spark, data, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw = str(root / "raw")
    write_faulty_csv(spark, data, raw)
    counts = clean_job.run(spark, raw, str(root / "clean"), str(root / "clean_csv"))
    samples = write_samples(spark, str(root / "clean"), str(root / "samples"))
    replicas = write_replicas(spark, str(root / "clean"), str(root / "scaled"))
    return root, counts, samples, replicas


def test_clean_job(spark, made, data):
    root, counts, _, _ = made
    assert counts["raw_rows"] == 6000
    assert counts["processed_rows"] + counts["removed_rows"] == 6000
    assert counts["null_key_rows"] == counts["diverted_rows"] == 0
    parquet = read_parquet(spark, str(root / "clean"))
    require_same(parquet, cleaning.clean(read_raw_csv(spark, str(root / "raw"))))
    require_same(parquet, read_csv(spark, str(root / "clean_csv"), CLEAN_SCHEMA))


def test_samples_and_replicas(spark, made):
    root, counts, samples, replicas = made
    total = counts["processed_rows"]
    assert [s["rows"] for s in samples] == [total, total, total // 2, total]
    assert [r["rows"] for r in replicas] == [total, 2 * total, 4 * total]
    full = read_parquet(spark, variant_path("full", str(root / "samples"), ""))
    require_same(full, read_parquet(spark, str(root / "clean")))


@pytest.mark.parametrize(
    "name,schema", [("route_stats", ROUTE_STATS_SCHEMA), ("delay_report", DELAY_REPORT_SCHEMA)]
)
def test_both_forms_of_a_report(spark, made, name, schema):
    root, source = made[0], str(made[0] / "clean")
    rows = write_report(spark, name, source, str(root / name / "p"), str(root / name / "c"))
    for _ in range(2):  # a second run replaces the first
        again = write_report_tables(
            spark, name, source, str(root / name / "tp"), str(root / name / "tc")
        )
    assert rows == again > 0
    frame = read_parquet(spark, str(root / name / "p"))
    require_same(frame, read_parquet(spark, str(root / name / "tp")))
    for text in ("c", "tc"):
        read = read_csv(spark, str(root / name / text), schema)
        require_same(frame.select(*schema.names), read)
    assert [f.name for f in frame.schema] == schema.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in schema]
    first = [tuple(r) for r in preview_report(spark, name, str(root / name / "p")).collect()]
    assert len(first) == 10 and first[0][0] == min(r[0] for r in frame.collect())


def test_sweep_and_summary(spark, made):
    root = made[0]
    places = [str(root / p) for p in ("samples", "scaled", "outputs", "logs")]
    sweep.run(spark, "route_stats", "all", *places)
    done = sweep.run(spark, "route_stats", "all", *places)
    assert [d["run_size"] for d in done] == ["100k", "500k", "half", "full"]
    scaled = sweep.run(spark, "route_stats", "scale_all", *places, form="tables", technology="hive")
    assert len({d["output_rows"] for d in scaled}) == 1
    counts = summarize.run(spark, str(root / "logs"), str(root / "summary"))
    assert counts == {"benchmark_summary": 4, "scalability_summary": 3}


def test_sizes():
    assert sizes("scale_all") == ("1x", "2x", "4x") and sizes("half") == ("half",)
    for bad in (sizes, lambda size: variant_path(size, "a", "b")):
        with pytest.raises(ValueError):
            bad("3x")
    assert variant_path("2x", "s", "r/") == "r/flights_clean_2x.parquet"


def test_failed_gate_stops_the_job(spark, made, monkeypatch):
    root = made[0]
    monkeypatch.setattr(cleaning, "kept", lambda: cleaning.F.lit(True))
    before = sorted(map(str, read_parquet(spark, str(root / "clean")).collect()))
    with pytest.raises(GateFailed):
        clean_job.run(spark, str(root / "raw"), str(root / "clean"), str(root / "bad_csv"))
    assert not (root / "bad_csv").exists()
    assert sorted(map(str, read_parquet(spark, str(root / "clean")).collect())) == before


def test_wrong_count_leaves_earlier_output(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(spark, spark.range(3).write.parquet, path, 3)
    with pytest.raises(GateFailed):
        write_checked(spark, spark.range(5).write.parquet, path, 4)
    assert read_parquet(spark, path).count() == 3
    assert [x.name for x in tmp_path.iterdir()] == ["t"]


def test_scratch_is_removed(spark):
    path = scratch_path(spark, "kept")
    spark.range(1).write.parquet(path)
    remove_scratch(spark)
    assert not os.path.exists(path)


def test_submitted_job(made):
    root = made[0]
    run = subprocess.run(
        [sys.executable, "-m", "routeloom.jobs.compare",
         "--left", str(root / "clean"), "--right", str(root / "clean")],
        cwd=ROOT, capture_output=True, text=True, timeout=180,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"},
    )
    assert "matching=true" in run.stdout, run.stderr[-2000:]
