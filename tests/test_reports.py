import math

import pytest
from pyspark.sql import functions as F

from routeloom.operators.grouping import member_lists
from routeloom.operators.compare import compare, require_same
from routeloom.operators.replicate import replicate, replicate_by_union
from routeloom.plans import clean as cleaning
from routeloom.plans import delay_report, route_stats
from routeloom.schemas import CLEAN_SCHEMA
from routeloom.sources.adapters import flights

COLUMNS = "origin string, month int, departure_delay_band string, dep_delay double, " \
          "arr_delay double, primary_disruption_cause string"


@pytest.fixture(scope="module")
def table(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "t")
    cleaning.clean(flights(spark, data)).write.parquet(path)
    return spark.read.parquet(path)


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_all_forms_of_the_delay_report_agree(table):
    base = delay_report.windowed(table)
    for other in (
        delay_report.windowed(table, by_rank=True),
        delay_report.one_pass(table),
        delay_report.counted(table),
    ):
        require_same(base, other)
    assert base.count() == 360


def test_all_forms_of_the_months_agree(table):
    names = [*route_stats.KEYS, "operating_months"]
    base = route_stats.route_stats(table).select(*names)
    require_same(base, route_stats.operating_months(table))
    require_same(base, route_stats.operating_months_padded(table))
    assert base.count() == 873


def brute_delay_report(data):
    """Plain Python over collected rows."""
    groups = {}
    for origin, month, band, dep, arr, cause in data:
        if band in ("low", "medium", "high"):
            groups.setdefault((origin, month, band), []).append((dep, arr, cause))
    out = []
    for key, members in groups.items():
        def mean(at):
            values = [m[at] for m in members if m[at] is not None]
            return round(sum(values) / len(values), 2) if values else None
        tally = {}
        for _, _, cause in members:
            if cause not in (None, "none"):
                tally[cause] = tally.get(cause, 0) + 1
        best = sorted(tally.items(), key=lambda item: (-item[1], item[0]))[:3]
        text = ",".join(f"{c}:{n}" for c, n in best) or "none"
        out.append((*key, len(members), mean(0), mean(1), text))
    return sorted(out)


HAND = [
    ("JFK", 1, "low", 1.0, 2.0, "nas"),
    ("JFK", 1, "low", 2.0, None, "weather"),
    ("JFK", 1, "low", 3.0, 4.0, "carrier"),
    ("JFK", 1, "low", 4.0, 4.0, "security"),
    ("JFK", 1, "low", 4.0, 4.0, "security"),
    ("JFK", 1, "high", 90.0, None, "none"),
    ("JFK", 1, "high", 91.0, None, None),
    ("LAX", 12, "medium", 20.0, 5.0, "cancellation_unknown"),
    ("LAX", 12, "unknown", None, 5.0, "carrier"),
]


@pytest.mark.parametrize("plan", list(delay_report.PLANS))
def test_ties_nulls_and_groups_without_causes(spark, plan):
    table = spark.createDataFrame(HAND, COLUMNS)
    assert rows(delay_report.delay_report(table, plan)) == brute_delay_report(HAND)


def test_cause_outside_the_list(spark):
    """Only the plan that is given a list refuses it."""
    table = spark.createDataFrame([*HAND, ("JFK", 1, "low", 1.0, 1.0, "birds")], COLUMNS)
    with pytest.raises(Exception, match="a cause is not listed"):
        delay_report.counted(table).collect()
    expected = brute_delay_report([*HAND, ("JFK", 1, "low", 1.0, 1.0, "birds")])
    assert rows(delay_report.delay_report(table)) == expected
    assert rows(delay_report.windowed(table)) == expected
    listed = delay_report.counted(table, (*delay_report.CAUSES, "birds"))
    assert rows(listed) == expected


@pytest.mark.parametrize("padded", [False, True])
def test_members_of_any_size(spark, padded):
    rows_in = [("a", 12), ("a", 123), ("a", 1), ("a", 12), ("b", None), ("c", 0), ("c", 1000)]
    table = spark.createDataFrame(rows_in, "k string, m int")
    lists = member_lists(table, ["k"], "m", "members", padded)
    assert rows(lists) == [("a", "1,12,123"), ("b", ""), ("c", "0,1000")]


def test_route_stats_by_hand(spark):
    base = dict.fromkeys(CLEAN_SCHEMA.names)
    made = [
        {**base, "op_unique_carrier": "AA", "route": "JFK-LAX", "arr_delay": delay,
         "is_cancelled": flag, "month": month}
        for delay, flag, month in ((1.0, 0, 10), (2.0, 0, 2), (None, 1, 10))
    ]
    made.append({**base, "op_unique_carrier": "AA", "route": "LAX-JFK", "is_cancelled": 1, "month": 1})
    result = rows(route_stats.route_stats(spark.createDataFrame(made, CLEAN_SCHEMA)))
    assert result == [
        ("AA", "JFK-LAX", 3, 1.0, 2.0, 1.5, 0.3333, "2,10"),
        ("AA", "LAX-JFK", 1, None, None, None, 1.0, "1"),
    ]


def test_not_a_number_is_the_largest(spark):
    base = dict.fromkeys(CLEAN_SCHEMA.names)
    made = [{**base, "op_unique_carrier": "A", "route": "r", "month": 1, "is_cancelled": 0,
             "arr_delay": v} for v in (1.0, float("nan"))]
    row = route_stats.route_stats(spark.createDataFrame(made, CLEAN_SCHEMA)).first()
    assert row.min_arr_delay == 1.0 and math.isnan(row.max_arr_delay)


@pytest.mark.parametrize("factor", [1, 2, 4])
def test_replicas_scale_counts_only(table, factor):
    copies = replicate(table, factor)
    assert copies.count() == table.count() * factor
    assert copies.columns == table.columns
    verdict = compare(copies, replicate_by_union(table, factor)).first()
    assert verdict.matching
    before, after = route_stats.route_stats(table), route_stats.route_stats(copies)
    require_same(before.withColumn("flight_count", F.col("flight_count") * factor), after)


def test_replicate_needs_a_copy(table):
    for build in (replicate, replicate_by_union):
        with pytest.raises(ValueError):
            build(table, 0)


def test_one_pass_collects_three_of_very_many_causes(spark):
    """A group with 100,000 causes: three reach the list, whatever the others are."""
    rows = spark.range(300_000).selectExpr(
        "'A' AS origin", "1 AS month", "'low' AS departure_delay_band", "1.0 AS dep_delay", "2.0 AS arr_delay",
        "if(id < 200000, concat('c', lpad(id % 100000, 6, '0')), if(id < 299990, 'none', 'd')) AS primary_disruption_cause",
    )
    more = rows.filter("primary_disruption_cause IN ('c000007', 'c000003')")
    report = delay_report.one_pass(rows.unionByName(more).unionByName(rows.limit(0)))
    found = report.first()
    assert (found.flight_count, found.top_3_causes) == (300_004, "d:10,c000003:4,c000007:4")
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Window") == 1
