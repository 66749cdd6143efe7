"""SQL counterparts of the registered queries, for an independent engine.

Averages are rounded through a decimal, since the other engine's rounding of doubles
differs in rare cases from rounding the printed value half up.
"""

from __future__ import annotations

from ..schemas import CLEAN_COLUMNS, RUN_SCHEMA, RUN_SCHEMA_WITH_ENVIRONMENT

_CLEAN_LIST = ", ".join(CLEAN_COLUMNS)
_RUN_LIST = ", ".join(RUN_SCHEMA.names)


def _round(value: str, digits: int) -> str:
    decimal = f"cast(cast({value} AS varchar) AS decimal(38, 15))"
    return f"cast(round({decimal}, {digits}) AS double)"


LEGS = """
legs AS (
    SELECT l.*, s_nationkey, c_nationkey, c_mktsegment,
           sn.n_name AS origin_name, cn.n_name AS dest_name,
           l_returnflag = 'R' AND l_linenumber <= 2 AS called_off,
           cast(l_shipdate AS date) AS day,
           l_quantity * 3 - 40 AS late,
           round(l_discount * 100) AS discount, round(l_tax * 100) AS tax
    FROM lineitem l
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation sn ON sn.n_nationkey = s_nationkey
    JOIN nation cn ON cn.n_nationkey = c_nationkey
)"""

FLIGHTS = (
    LEGS
    + """,
flights AS (
    SELECT l_orderkey,
           cast(year(day) AS integer) AS year, cast(month(day) AS integer) AS month,
           cast(day(day) AS integer) AS day_of_month,
           cast(isodow(day) AS integer) AS day_of_week,
           day AS fl_date,
           CASE WHEN l_linenumber = 7 THEN ' ' || lower(c_mktsegment) || ' '
                ELSE c_mktsegment END AS op_unique_carrier,
           cast(l_partkey AS integer) AS op_carrier_fl_num,
           origin_name AS origin, origin_name AS origin_city_name, origin_name AS origin_state_nm,
           dest_name AS dest, dest_name AS dest_city_name, dest_name AS dest_state_nm,
           CASE WHEN NOT (called_off AND l_linestatus = 'F') THEN late END AS dep_delay,
           CASE WHEN NOT called_off THEN late + discount - 5 END AS arr_delay,
           CASE WHEN called_off THEN 1 ELSE 0 END AS cancelled,
           CASE WHEN called_off THEN
                CASE l_suppkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                                   WHEN 3 THEN 'D' END END AS cancellation_code,
           CASE WHEN l_linenumber = 7 AND discount = 0 THEN 1 ELSE 0 END AS diverted,
           abs(s_nationkey - c_nationkey) * 100.0e0 + 100.0e0 AS distance,
           CASE WHEN l_quantity >= 19 THEN (l_partkey % 5) * 10.0e0 END AS carrier_delay,
           CASE WHEN l_quantity >= 19 THEN (l_suppkey % 4) * 10.0e0 END AS weather_delay,
           CASE WHEN l_quantity >= 19 THEN discount * 5 END AS nas_delay,
           CASE WHEN l_quantity >= 19 THEN (l_linenumber % 3) * 5.0e0 END AS security_delay,
           CASE WHEN l_quantity >= 19 THEN tax * 5 END AS late_aircraft_delay
    FROM legs
)"""
)

TEXT = (
    FLIGHTS
    + """,
texts AS (
    SELECT cast(year AS varchar) AS year,
           CASE WHEN l_orderkey % 59 = 0 THEN '13' WHEN l_orderkey % 59 = 1 THEN '0'
                WHEN l_orderkey % 59 = 2 THEN 'x1'
                WHEN l_orderkey % 59 = 3 THEN cast(month AS varchar) || '.0'
                ELSE cast(month AS varchar) END AS month,
           cast(day_of_month AS varchar) AS day_of_month,
           cast(day_of_week AS varchar) AS day_of_week,
           CASE WHEN l_orderkey % 53 = 0 THEN '2024-13-40'
                WHEN l_orderkey % 53 <> 1 THEN cast(fl_date AS varchar) END AS fl_date,
           CASE WHEN l_orderkey % 61 = 0 THEN '  '
                WHEN l_orderkey % 61 <> 1 THEN op_unique_carrier END AS op_unique_carrier,
           cast(op_carrier_fl_num AS varchar) || '.0' AS op_carrier_fl_num,
           CASE WHEN l_orderkey % 79 = 0 THEN '  ' || lower(origin)
                WHEN l_orderkey % 79 = 1 THEN ' ' ELSE origin END AS origin,
           ' ' || origin_city_name || ', X ' AS origin_city_name, origin_state_nm,
           CASE WHEN l_orderkey % 83 = 0 THEN lower(dest) || ' '
                WHEN l_orderkey % 83 <> 1 THEN dest END AS dest,
           dest_city_name, dest_state_nm,
           CASE WHEN l_orderkey % 67 = 0 THEN 'abc'
                ELSE cast(dep_delay AS varchar) END AS dep_delay,
           cast(arr_delay AS varchar) AS arr_delay,
           CASE WHEN l_orderkey % 71 <> 0 THEN cast(cancelled AS varchar) || '.0' END AS cancelled,
           lower(' ' || cancellation_code) AS cancellation_code,
           CASE WHEN l_orderkey % 73 <> 0 THEN cast(diverted AS varchar) || '.0' END AS diverted,
           cast(distance AS varchar) AS distance,
           cast(carrier_delay AS varchar) AS carrier_delay,
           cast(weather_delay AS varchar) AS weather_delay,
           cast(nas_delay AS varchar) AS nas_delay,
           cast(security_delay AS varchar) AS security_delay,
           cast(late_aircraft_delay AS varchar) AS late_aircraft_delay
    FROM flights
)"""
)

_INTS = ("year", "month", "day_of_month", "day_of_week")
_WHOLE = ("op_carrier_fl_num", "cancelled", "diverted")
_CODES = ("op_unique_carrier", "origin", "dest", "cancellation_code")
_NAMES = ("origin_city_name", "origin_state_nm", "dest_city_name", "dest_state_nm")
_DELAYS = (
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
)


def _typed(source: str) -> str:
    columns = [
        *[f"try_cast(try_cast({c} AS double) AS integer) AS {c}" for c in (*_INTS, *_WHOLE)],
        "try_cast(fl_date AS date) AS fl_date",
        *[f"upper(trim({c})) AS {c}" for c in _CODES],
        *[f"trim({c}) AS {c}" for c in _NAMES],
        *[
            f"try_cast({c} AS double) AS {c}"
            for c in ("dep_delay", "arr_delay", "distance", *_DELAYS)
        ],
    ]
    return f"typed AS (SELECT {', '.join(columns)} FROM {source})"


_BAND = """CASE WHEN dep_delay IS NULL THEN 'unknown' WHEN dep_delay < 15 THEN 'low'
                WHEN dep_delay <= 60 THEN 'medium' ELSE 'high' END"""

_FLAG = "CASE WHEN cancelled = 1 THEN 1 ELSE 0 END"


def _cause() -> str:
    zeroed = {c: f"coalesce({c}, 0)" for c in _DELAYS}
    most = f"greatest({', '.join(zeroed.values())})"
    picks = " ".join(
        f"WHEN {value} = {most} THEN '{c.removesuffix('_delay')}'" for c, value in zeroed.items()
    )
    return f"""CASE WHEN cancelled = 1 THEN
                CASE cancellation_code WHEN 'A' THEN 'carrier' WHEN 'B' THEN 'weather'
                     WHEN 'C' THEN 'nas' WHEN 'D' THEN 'security' ELSE 'cancellation_unknown' END
                WHEN {most} <= 0 THEN 'none' {picks} END"""


_RULES = {
    "date": "fl_date IS NOT NULL",
    "month": "month BETWEEN 1 AND 12",
    "carrier": "op_unique_carrier <> ''",
    "origin": "origin <> ''",
    "dest": "dest <> ''",
    "route": "origin <> dest",
    "diverted": "coalesce(diverted, 0) = 0",
}
_KEEP = " AND ".join(_RULES.values())

_CLEAN = f"""clean AS (
    SELECT {_CLEAN_LIST} FROM (
        SELECT *, origin || '-' || dest AS route, {_FLAG} AS is_cancelled,
               {_cause()} AS primary_disruption_cause, {_BAND} AS departure_delay_band
        FROM typed WHERE {_KEEP})
)"""

CLEAN = f"{FLIGHTS}, {_typed('flights')}, {_CLEAN}"
CLEAN_TEXT = f"{TEXT}, {_typed('texts')}, {_CLEAN}"

_ROUTE_STATS = f"""
    SELECT op_unique_carrier, route, count(*) AS flight_count,
           min(arr_delay) AS min_arr_delay, max(arr_delay) AS max_arr_delay,
           {_round('avg(arr_delay)', 2)} AS avg_arr_delay,
           {_round('avg(is_cancelled)', 4)} AS cancellation_rate,
           array_to_string(list_sort(list(DISTINCT month)), ',') AS operating_months
    FROM {{source}} GROUP BY op_unique_carrier, route"""

_MONTHS = """
    SELECT op_unique_carrier, route,
           array_to_string(list_sort(list(DISTINCT month)), ',') AS operating_months
    FROM clean GROUP BY op_unique_carrier, route"""

_KEYS = "origin, month, departure_delay_band"


def _delay_ctes(source: str) -> str:
    return f"""known AS (
    SELECT {_KEYS}, dep_delay, arr_delay, nullif(primary_disruption_cause, 'none') AS cause
    FROM {source} WHERE departure_delay_band <> 'unknown'
), tally AS (
    SELECT {_KEYS}, cause AS primary_disruption_cause, count(*) AS cause_count
    FROM known WHERE cause IS NOT NULL GROUP BY ALL
), best AS (
    SELECT {_KEYS}, array_to_string(list(primary_disruption_cause || ':' || cause_count
               ORDER BY cause_count DESC, primary_disruption_cause)[1:3], ',') AS top_3_causes
    FROM tally GROUP BY ALL
), figures AS (
    SELECT {_KEYS}, count(*) AS flight_count,
           {_round('avg(dep_delay)', 2)} AS avg_dep_delay,
           {_round('avg(arr_delay)', 2)} AS avg_arr_delay
    FROM known GROUP BY {_KEYS}
), delay_report AS (
    SELECT figures.*, coalesce(top_3_causes, 'none') AS top_3_causes
    FROM figures NATURAL LEFT JOIN best
)"""


_DELAY = f"WITH {CLEAN}, {_delay_ctes('clean')}"
_FOUR = "four AS (SELECT c.* FROM clean c, range(4))"

_PRINT = " || '||' || ".join(f"coalesce(cast({c} AS varchar), '__NULL__')" for c in CLEAN_COLUMNS)
_SAMPLE_ORDER = ", ".join(
    f"{c} ASC NULLS LAST"
    for c in (
        "fl_date", "op_unique_carrier", "op_carrier_fl_num", "origin", "dest",
        "dep_delay", "arr_delay", "cancelled", "route", f"sha256({_PRINT})",
    )
)
_PLACED = f"""placed AS (
    SELECT {_CLEAN_LIST}, row_number() OVER (ORDER BY {_SAMPLE_ORDER}) AS position FROM clean
)"""

_TARGETS = """targets AS (
    SELECT * FROM (VALUES ('100k', 100000), ('500k', 500000)) AS v(sample, target_rows)
    UNION ALL SELECT 'half', count(*) // 2 FROM clean
    UNION ALL SELECT 'full', count(*) FROM clean
)"""

RECORDS = """records AS (
    SELECT event_id,
           ['analysis_3_1', 'analysis_3_2', 'analysis_9'][user_id % 3 + 1] AS analysis,
           CASE event_type WHEN 'view' THEN 'spark_sql' WHEN 'click' THEN 'spark_core'
                WHEN 'purchase' THEN 'hive' ELSE event_type END AS technology,
           ['100k', '500k', 'half', 'full', '1x', '2x', '4x', '8x'][event_id % 8 + 1] AS run_size,
           '/data/' || run_size AS input_path, '/out/' || event_id AS output_path,
           value AS execution_time_seconds, event_id AS output_rows,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS run_timestamp,
           CASE WHEN user_id % 2 = 1 THEN 'cluster' END AS environment
    FROM events
)"""


def _grouped(source: str, columns: str, names: str) -> str:
    return f"SELECT {columns}, count(*) AS n FROM {source} GROUP BY {names}"


def _compare(left: str, right: str, columns: str) -> str:
    return f"""
    SELECT *, left_only_rows = 0 AND right_only_rows = 0 AS matching FROM (
    SELECT (SELECT count(*) FROM {left}) AS left_rows,
           (SELECT count(*) FROM {right}) AS right_rows,
           (SELECT count(*) FROM (SELECT {columns} FROM {left} EXCEPT ALL
                                  SELECT {columns} FROM {right})) AS left_only_rows,
           (SELECT count(*) FROM (SELECT {columns} FROM {right} EXCEPT ALL
                                  SELECT {columns} FROM {left})) AS right_only_rows)"""


_RUN_ORDER = """coalesce(list_position(['analysis_3_1', 'analysis_3_2'], analysis), 3),
    coalesce(list_position(['100k', '500k', 'half', 'full', '1x', '2x', '4x'], run_size), 8),
    coalesce(list_position(['spark_sql', 'spark_core', 'hive'], technology), 4),
    run_timestamp, output_rows"""

_WHOLE_CLEAN = f"WITH {CLEAN} SELECT * FROM clean"
_R1 = f"WITH {CLEAN} {_ROUTE_STATS.format(source='clean')}"
_WIDE = "wide AS (SELECT * REPLACE (month + month % 3 * 60 AS month) FROM clean)"
_R1_WIDE = f"WITH {CLEAN}, {_WIDE} {_ROUTE_STATS.format(source='wide')}"
_R2 = f"{_DELAY} SELECT * FROM delay_report"
_R1_PLACED = f"""WITH {CLEAN}, stats AS ({_ROUTE_STATS.format(source='clean')})
    SELECT *, row_number() OVER (ORDER BY op_unique_carrier, route) AS position FROM stats"""
_BAND_RANK = "list_position(['low', 'medium', 'high'], departure_delay_band)"

def _local_matrix(latest: str) -> str:
    """The matrix of the records without an environment; ``latest`` is greatest for the one that counts."""
    cells = ", ".join(
        f"arg_max(round(execution_time_seconds, 3), {latest}) FILTER (WHERE technology = '{name}') AS {name}"
        for name in ("spark_sql", "spark_core", "hive")
    )
    return f"""WITH {RECORDS}
        SELECT analysis, run_size, {cells}
        FROM records WHERE run_size <> '8x' AND environment IS NULL GROUP BY analysis, run_size"""


ORACLE = {
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_csv": f"WITH {TEXT} SELECT * FROM texts",
    "scan_temp_view": f"""WITH {CLEAN}
        SELECT origin, dest, count(*) AS flight_count FROM clean GROUP BY origin, dest""",
    "write_parquet_overwrite": _WHOLE_CLEAN,
    "write_csv_overwrite": _WHOLE_CLEAN,
    "external_table_scan": f"""WITH {CLEAN}
        SELECT op_unique_carrier, count(*) AS flight_count, min(fl_date) AS first_date
        FROM clean GROUP BY op_unique_carrier""",
    "ctas_route_stats": _R1,
    "ctas_delay_report": _R2,
    "export_route_stats": _R1,
    "export_delay_report": _R2,
    "typed_projection": f"WITH {TEXT}, {_typed('texts')} SELECT * FROM typed",
    "normalize_codes": f"""WITH {TEXT}
        SELECT op_unique_carrier AS raw_carrier, origin AS raw_origin,
               upper(trim(op_unique_carrier)) AS carrier, upper(trim(origin)) AS origin,
               trim(origin_city_name) AS city, count(*) AS n
        FROM texts GROUP BY op_unique_carrier, texts.origin, origin_city_name""",
    "parse_dates": f"""WITH {TEXT}
        SELECT fl_date AS raw_date, try_cast(fl_date AS date) AS fl_date, count(*) AS n
        FROM texts GROUP BY texts.fl_date""",
    "derive_route": f"WITH {FLIGHTS} "
    + _grouped("flights", "origin, dest, origin || '-' || dest AS route", "origin, dest"),
    "cancel_flag": f"WITH {TEXT}, {_typed('texts')} "
    + _grouped("typed", f"cancelled, {_FLAG} AS is_cancelled", "cancelled"),
    "delay_bands": f"WITH {FLIGHTS} "
    + _grouped("flights", f"dep_delay, {_BAND} AS departure_delay_band", "dep_delay"),
    "primary_cause": f"WITH {FLIGHTS} "
    + _grouped(
        "flights",
        f"cancelled, cancellation_code, {', '.join(_DELAYS)}, "
        f"{_cause()} AS primary_disruption_cause",
        f"cancelled, cancellation_code, {', '.join(_DELAYS)}",
    ),
    "clean_rules": f"WITH {TEXT}, {_typed('texts')} SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS broken_{name}"
        for name, rule in _RULES.items()
    )
    + " FROM typed",
    "clean_table": f"WITH {CLEAN_TEXT} SELECT * FROM clean",
    "clean_table_typed": _WHOLE_CLEAN,
    "clean_job_published": f"WITH {CLEAN_TEXT} SELECT * FROM clean",
    "quality_metrics": f"""WITH {CLEAN_TEXT}
        SELECT (SELECT count(*) FROM texts) AS raw_rows, count(*) AS processed_rows,
               (SELECT count(*) FROM texts) - count(*) AS removed_rows,
               count(*) FILTER (WHERE fl_date IS NULL OR month IS NULL OR origin IS NULL
                    OR op_unique_carrier IS NULL OR dest IS NULL) AS null_key_rows,
               (SELECT count(*) FROM typed WHERE {_KEEP} AND diverted = 1) AS diverted_rows
        FROM clean""",
    "route_stats_report": _R1,
    "operating_months": f"WITH {CLEAN} {_MONTHS}",
    "route_stats_wide_months": _R1_WIDE,
    "ctas_route_stats_wide_months": _R1_WIDE,
    "operating_months_padded_wide": f"WITH {CLEAN}, {_WIDE} {_MONTHS.replace('FROM clean', 'FROM wide')}",
    "delay_report_new_cause": f"""WITH {CLEAN}, struck AS (
        SELECT * REPLACE (CASE WHEN month % 2 = 0 AND primary_disruption_cause <> 'none' THEN 'strike'
                               ELSE primary_disruption_cause END AS primary_disruption_cause) FROM clean),
        {_delay_ctes('struck')} SELECT * FROM delay_report""",
    "replica_variants": f"""WITH {CLEAN}, sized AS (SELECT * FROM (VALUES ('1x', 1), ('2x', 2), ('4x', 4)) t(scale, factor))
        SELECT scale, factor * (SELECT count(*) FROM clean) AS expected_rows,
               factor * (SELECT count(*) FROM clean) AS variant_rows FROM sized""",
    "operating_months_padded": f"WITH {CLEAN} {_MONTHS}",
    "route_stats_ordered": _R1_PLACED,
    "preview_top10": f"SELECT * FROM ({_R1_PLACED}) WHERE position <= 10",
    "band_metrics": f"{_DELAY} SELECT * FROM figures",
    "cause_counts": f"{_DELAY} SELECT * FROM tally",
    "ranked_causes": f"""{_DELAY}
        SELECT *, cast(1 + (SELECT count(*) FROM tally o
                   WHERE (o.origin, o.month, o.departure_delay_band)
                       = (t.origin, t.month, t.departure_delay_band)
                     AND (-o.cause_count, o.primary_disruption_cause)
                       < (-t.cause_count, t.primary_disruption_cause)) AS integer) AS cause_rank
        FROM tally t""",
    "top_causes_struct": f"{_DELAY} SELECT * FROM best",
    "top_causes_pivot": f"{_DELAY} SELECT * FROM best",
    "delay_report_counted": _R2,
    "delay_report_onepass": _R2,
    "delay_report_windowed": _R2,
    "delay_report_windowed_pivot": _R2,
    "delay_report_ordered": f"""{_DELAY}
        SELECT *, row_number() OVER (ORDER BY origin, month, {_BAND_RANK}) AS position
        FROM delay_report""",
    "row_fingerprints": f"""WITH {CLEAN}
        SELECT sha256({_PRINT}) AS fingerprint, fl_date, route, count(*) AS copies
        FROM clean GROUP BY ALL""",
    "sample_order": f"WITH {CLEAN}, {_PLACED} SELECT * FROM placed",
    "prefix_sample": f"""WITH {CLEAN}, {_PLACED}
        SELECT {_CLEAN_LIST} FROM placed
        WHERE position <= (SELECT count(*) // 2 FROM clean)""",
    "prefix_variants": f"""WITH {CLEAN}, {_PLACED}, {_TARGETS}
        SELECT sample, target_rows, count(*) AS sample_rows, max(fl_date) AS last_date,
               sum(arr_delay) AS arr_delay_sum
        FROM targets JOIN placed ON position <= target_rows GROUP BY sample, target_rows""",
    "replicate_rows": f"""WITH {CLEAN}, base AS (
            SELECT op_unique_carrier, count(*) AS n FROM clean GROUP BY op_unique_carrier)
        SELECT scale, form, op_unique_carrier, n * factor AS n
        FROM base, (VALUES ('1x', 1), ('2x', 2), ('4x', 4)) AS s(scale, factor),
             (VALUES ('explode'), ('union')) AS f(form)""",
    "route_stats_scaled": f"WITH {CLEAN}, {_FOUR} {_ROUTE_STATS.format(source='four')}",
    "delay_report_scaled": f"WITH {CLEAN}, {_FOUR}, {_delay_ctes('four')} SELECT * FROM delay_report",
    "compare_outputs": f"""{_DELAY}
        SELECT count(*) AS left_rows, count(*) AS right_rows,
               cast(0 AS bigint) AS left_only_rows, cast(0 AS bigint) AS right_only_rows, true AS matching FROM delay_report""",
    "compare_outputs_differing": f"""WITH {CLEAN},
        early AS (SELECT {_KEYS} FROM clean WHERE month <= 8),
        late_part AS (SELECT {_KEYS} FROM clean WHERE month >= 5)
        {_compare('early', 'late_part', _KEYS)}""",
    "multiset_difference": f"""WITH {CLEAN}
        SELECT origin, dest, departure_delay_band FROM clean WHERE month <= 6 EXCEPT ALL
        SELECT origin, dest, departure_delay_band FROM clean WHERE month > 6""",
    "multiset_surplus": f"""WITH {CLEAN}
        SELECT origin, dest, departure_delay_band, count(*) AS surplus FROM (
            SELECT origin, dest, departure_delay_band FROM clean WHERE month <= 6 EXCEPT ALL
            SELECT origin, dest, departure_delay_band FROM clean WHERE month > 6)
        GROUP BY origin, dest, departure_delay_band""",
    "append_run_record": f"WITH {RECORDS} SELECT {_RUN_LIST} FROM records",
    "consolidate_runs": f"""WITH {RECORDS}
        SELECT {', '.join(RUN_SCHEMA_WITH_ENVIRONMENT.names)},
               row_number() OVER (ORDER BY {_RUN_ORDER}) AS position
        FROM (SELECT * REPLACE (printf('%.3f', execution_time_seconds) AS execution_time_seconds)
              FROM records WHERE environment IS NULL OR run_size <> '8x')""",
    "run_matrix": f"""WITH {RECORDS}
        SELECT analysis, run_size,
               arg_max(execution_time_seconds, event_id)
                   FILTER (WHERE technology = 'spark_sql') AS spark_sql,
               arg_max(execution_time_seconds, event_id)
                   FILTER (WHERE technology = 'spark_core') AS spark_core,
               arg_max(execution_time_seconds, event_id)
                   FILTER (WHERE technology = 'hive') AS hive
        FROM records WHERE run_size <> '8x' GROUP BY analysis, run_size""",
    "run_matrix_from_logs": _local_matrix("event_id % 3 * 1000000000000 + event_id"),
    "run_matrix_of_saved": _local_matrix("run_timestamp || lpad(CAST(event_id AS varchar), 12, '0')"),
    "events_stats": f"""
        SELECT user_id, count(*) AS event_count, min(cents) AS min_cents, max(cents) AS max_cents,
               {_round('avg(cents)', 2)} AS avg_cents,
               {_round("avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)", 4)} AS error_rate,
               array_to_string(list_sort(list(DISTINCT day(ts))), ',') AS days
        FROM (SELECT *, round(value * 100) AS cents FROM events) GROUP BY user_id""",
    "events_top_types": """
        SELECT * FROM (
            SELECT *, cast(row_number() OVER (PARTITION BY user_id, event_month
                      ORDER BY item_count DESC, event_type) AS integer) AS item_rank
            FROM (SELECT user_id, cast(month(ts) AS integer) AS event_month, event_type,
                         count(*) AS item_count
                  FROM events GROUP BY ALL))
        WHERE item_rank <= 3""",
}

# other plans of the same result
ORACLE["quality_metrics_parts"] = ORACLE["quality_metrics"]
ORACLE["compare_outputs_digest"] = ORACLE["compare_outputs"]
ORACLE["compare_outputs_digest_differing"] = ORACLE["compare_outputs_differing"]
ORACLE["consolidate_runs_incremental"] = ORACLE["consolidate_runs"]
