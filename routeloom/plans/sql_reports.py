"""The two reports as SQL text, for tables made from a query and for exports.

``{flights}`` is the clean table, ``{report}`` a finished report.
"""

ROUTE_STATS_SQL = """
WITH fine AS (
    SELECT op_unique_carrier, route, month, count(*) AS n,
           min(arr_delay) AS least, max(arr_delay) AS most,
           sum(arr_delay) AS arr_sum, count(arr_delay) AS arr_n,
           sum(is_cancelled) AS flags, count(is_cancelled) AS flagged
    FROM {flights}
    GROUP BY ALL
)
SELECT op_unique_carrier, route,
       sum(n) AS flight_count,
       min(least) AS min_arr_delay, max(most) AS max_arr_delay,
       round(try_divide(sum(arr_sum), sum(arr_n)), 2) AS avg_arr_delay,
       round(try_divide(sum(flags), sum(flagged)), 4) AS cancellation_rate,
       array_join(array_sort(collect_list(month)), ',') AS operating_months
FROM fine
GROUP BY ALL
"""

ROUTE_STATS_EXPORT_SQL = "SELECT * FROM {report} ORDER BY op_unique_carrier, route"

DELAY_REPORT_SQL = """
WITH fine AS (
    SELECT origin, month, departure_delay_band AS band, primary_disruption_cause AS cause,
           count(*) AS n,
           sum(dep_delay) AS dep_sum, count(dep_delay) AS dep_n,
           sum(arr_delay) AS arr_sum, count(arr_delay) AS arr_n
    FROM {flights}
    WHERE departure_delay_band IN ('low', 'medium', 'high')
    GROUP BY ALL
), placed AS (
    SELECT *, if(cause <> 'none', concat(cause, ':', n), NULL) AS label,
           row_number() OVER (PARTITION BY origin, month, band
                              ORDER BY if(cause <> 'none', n, 0) DESC, cause) AS place
    FROM fine
)
SELECT origin, month, band AS departure_delay_band,
       sum(n) AS flight_count,
       round(try_divide(sum(dep_sum), sum(dep_n)), 2) AS avg_dep_delay,
       round(try_divide(sum(arr_sum), sum(arr_n)), 2) AS avg_arr_delay,
       coalesce(nullif(concat_ws(',',
           max(label) FILTER (WHERE place = 1),
           max(label) FILTER (WHERE place = 2),
           max(label) FILTER (WHERE place = 3)), ''), 'none') AS top_3_causes
FROM placed
GROUP BY origin, month, band
"""

DELAY_REPORT_EXPORT_SQL = """
SELECT * FROM {report}
ORDER BY origin, month, array_position(array('low', 'medium', 'high'), departure_delay_band)
"""
