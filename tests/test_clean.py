import gzip
import math

import pytest
from pyspark.sql import functions as F

from routeloom.functions import labels, text
from routeloom.jobs import clean as clean_job
from routeloom.operators.quality import GateFailed, require_rows, require_zero
from routeloom.plans import clean as cleaning
from routeloom.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA, RAW_COLUMNS
from routeloom.sources.adapters import flights, write_faulty_csv
from routeloom.sources.files import header_census, read_parquet, read_raw_csv

from .fixtures import CASES, raw_lines, write_raw


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    raw = read_raw_csv(spark, write_raw(tmp_path_factory.mktemp("raw")))
    return {row.op_carrier_fl_num: row for row in cleaning.clean(raw).collect()}


@pytest.mark.parametrize("at,name", list(enumerate(CASES)))
def test_hand_written_rows(cleaned, at, name):
    expected = CASES[name][1]
    if expected is None:
        assert at not in cleaned
        return
    found = cleaned[at].asDict()
    assert {key: found[key] for key in expected if key != "op_carrier_fl_num"} == {
        key: value for key, value in expected.items() if key != "op_carrier_fl_num"
    }


def test_not_a_number_is_kept(cleaned):
    assert math.isnan(cleaned[list(CASES).index("not_a_number")].dep_delay)


def test_clean_schema(spark, tmp_path):
    table = cleaning.clean(read_raw_csv(spark, write_raw(tmp_path)))
    assert table.columns == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 27
    assert [f.dataType for f in table.schema] == [f.dataType for f in CLEAN_SCHEMA]


def test_city_with_comma_is_one_field(cleaned):
    assert cleaned[0].origin_city_name == "New York, NY"


def test_short_and_long_rows(spark, tmp_path):
    head, row = raw_lines()[:2]
    (tmp_path / "a.csv").write_text("\n".join([head, row + ",9,9", "1,2024,3,5"]) + "\n")
    rows = read_raw_csv(spark, str(tmp_path / "a.csv")).collect()
    assert rows[0].air_time == "2"
    assert rows[1].fl_date is None and rows[1].month == "3"


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("year,month\n2024,1\n")
    with pytest.raises(ValueError, match="fl_date"):
        read_raw_csv(spark, str(tmp_path / "a.csv"))


def test_header_in_capitals(spark, tmp_path):
    head, *rows = raw_lines()
    (tmp_path / "a.csv").write_text("\n".join([head.upper(), *rows]) + "\n")
    table = cleaning.clean(read_raw_csv(spark, str(tmp_path / "a.csv")))
    assert table.columns == CLEAN_COLUMNS
    assert table.count() == sum(expected is not None for _, expected in CASES.values())


INT_TEXTS = ["7", " 7 ", "-7", "+7", "7.0", "7.9", "-7.9", "abc", "", "7x", "1e3", "99999999999",
             "7.", "2147483647", "2147483648", "1.2.3", "--3", "0", "007", None]
DOUBLE_TEXTS = INT_TEXTS + ["NaN", "Infinity", "-Infinity", "1e400", ".5", "1,5", "3e9", "-3e9"]
DATE_TEXTS = ["2024-03-05", "2024-13-40", "2024-02-30", "", "x", None, "2024-03-05 10:00:00"]


def test_reading_equals_lenient_casts(spark):
    """The text readers under ANSI rules equal plain casts without them."""
    ints = spark.createDataFrame([(t,) for t in INT_TEXTS], "t string")
    doubles = spark.createDataFrame([(t,) for t in DOUBLE_TEXTS], "t string")
    dates = spark.createDataFrame([(t,) for t in DATE_TEXTS], "t string")
    column = F.col("t")

    def values(table, expression):
        return [str(row[0]) for row in table.select(expression).collect()]

    mine = [
        values(ints, text.to_int(column)),
        values(doubles, text.to_double(column)),
        values(doubles, text.to_int_via_double(column)),
        values(dates, text.to_date(column)),
    ]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [
            values(ints, column.cast("int")),
            values(doubles, column.cast("double")),
            values(doubles, column.cast("double").cast("int")),
            values(dates, F.to_date(column, "yyyy-MM-dd")),
        ]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert mine == plain


def test_band_and_rank_check_their_arguments(spark):
    with pytest.raises(ValueError):
        labels.band(F.col("x"), ((1, True),), ("a",), "none")
    ranks = spark.createDataFrame([("b",), ("z",), (None,), ("a",)], "v string").select(
        labels.list_rank(F.col("v"), ["a", "b"])
    )
    assert [row[0] for row in ranks.collect()] == [2, 3, 3, 1]


def test_account_matches_rows(spark, data, tmp_path):
    write_faulty_csv(spark, data, str(tmp_path / "raw"))
    raw = read_raw_csv(spark, str(tmp_path / "raw"))
    counts = cleaning.account(raw).first()
    assert counts.raw_rows == raw.count()
    assert counts.processed_rows == cleaning.clean(raw).count()
    assert counts.raw_rows == counts.processed_rows + counts.removed_rows
    assert counts.null_key_rows == counts.diverted_rows == 0


def test_typed_input_is_not_read_again(spark, data):
    typed = cleaning.typed(flights(spark, data))
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan and "gettimestamp" not in plan.lower()
    assert typed.columns == list(RAW_COLUMNS)


def test_known_counts(spark):
    table = cleaning.clean(flights(spark, "/root/testdata/sf0.001"))
    bands = {r[0]: r[1] for r in table.groupBy("departure_delay_band").count().collect()}
    causes = {r[0]: r[1] for r in table.groupBy("primary_disruption_cause").count().collect()}
    assert bands == {"low": 1998, "medium": 1593, "high": 1866, "unknown": 266}
    assert causes == {
        "none": 1903, "nas": 1467, "carrier": 1200, "late_aircraft": 554, "weather": 396,
        "cancellation_unknown": 108, "security": 95,
    }


def test_gates_raise():
    require_zero({"null_key_rows": 0})
    with pytest.raises(GateFailed, match="null_key_rows=3"):
        require_zero({"null_key_rows": 3, "diverted_rows": 0})
    require_rows(4, 4)
    with pytest.raises(GateFailed):
        require_rows(3, 4)


def put_text(path, lines, gz=False):
    text = ("\n".join(lines) + "\n").encode()
    path.write_bytes(gzip.compress(text) if gz else text)


def test_files_of_several_column_orders(spark, tmp_path):
    """Each file by its own header; a column that only some have is null elsewhere."""
    names = list(RAW_COLUMNS)
    turned = [*reversed(names), "extra"]
    put_text(tmp_path / "a.csv", [",".join(names), ",".join(f"{n}1" for n in names)])
    put_text(tmp_path / "b.csv", [",".join(x.upper() for x in turned), ",".join(f"{n}2" for n in turned)])
    put_text(tmp_path / "c.csv.gz", [",".join(names), ",".join(f"{n}3" for n in names)], gz=True)
    (tmp_path / "empty.csv").write_text("")
    census = header_census(spark, str(tmp_path))
    assert sorted(len(files) for files in census.values()) == [1, 2]
    found = read_raw_csv(spark, str(tmp_path)).orderBy("year").collect()
    assert [row.year for row in found] == ["year1", "year2", "year3"]
    assert all(row[name] == f"{name}{at + 1}" for at, row in enumerate(found) for name in names)
    assert [row.EXTRA for row in found] == [None, "extra2", None]
    put_text(tmp_path / "d.csv", [",".join(names[1:]), ",".join(names[1:])])
    with pytest.raises(ValueError, match=f"columns missing in .*d.csv: {names[0]}"):
        read_raw_csv(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no header line"):
        read_raw_csv(spark, str(tmp_path / "empty.csv"))


def test_cleaning_job_reads_the_text_once(spark, data, tmp_path, monkeypatch):
    """One scan of the raw text for rows, counts and gates, and no output when a gate fails."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "clean")
    write_faulty_csv(spark, data, raw)
    reads = []

    def counting(session, path):
        reads.append(path)
        # a function that cannot be folded: every evaluation of a row counts
        tally = session.sparkContext.accumulator(0)
        reads.append(tally)
        rows = read_raw_csv(session, path)
        seen = F.udf(lambda x: (tally.add(1), x)[1], "string").asNondeterministic()
        return rows.withColumn("year", seen("year"))

    monkeypatch.setattr(clean_job, "read_raw_csv", counting)
    counts = clean_job.run(spark, raw, out, str(tmp_path / "csv"))
    assert len(reads) == 2 and reads[1].value == counts["raw_rows"] == 6000
    assert counts == cleaning.account(read_raw_csv(spark, raw)).first().asDict()
    assert read_parquet(spark, out).columns == list(CLEAN_COLUMNS)
    nothing = tmp_path / "none"
    nothing.mkdir()
    put_text(nothing / "a.csv", [",".join(RAW_COLUMNS)])
    monkeypatch.setattr(clean_job, "read_raw_csv", read_raw_csv)
    assert clean_job.run(spark, str(nothing), out, str(tmp_path / "csv"))["raw_rows"] == 0
    assert read_parquet(spark, out).count() == 0
