"""Column names, types and the other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    """A schema from DDL of simple types; Spark's own reader of DDL needs a session."""
    schema = T.StructType()
    for column in ddl.split(","):
        name, kind, *not_null = column.split()
        schema.add(name, kind, not not_null)
    return schema


# --- fixed values: names and kinds of the raw columns that are used -----------------
# kind: how the text is read, see functions.text
RAW_COLUMNS = {
    "year": "int",
    "month": "int",
    "day_of_month": "int",
    "day_of_week": "int",
    "fl_date": "date",
    "op_unique_carrier": "code",
    "op_carrier_fl_num": "int_via_double",
    "origin": "code",
    "origin_city_name": "name",
    "origin_state_nm": "name",
    "dest": "code",
    "dest_city_name": "name",
    "dest_state_nm": "name",
    "dep_delay": "double",
    "arr_delay": "double",
    "cancelled": "int_via_double",
    "cancellation_code": "code",
    "diverted": "int_via_double",
    "distance": "double",
    "carrier_delay": "double",
    "weather_delay": "double",
    "nas_delay": "double",
    "security_delay": "double",
    "late_aircraft_delay": "double",
}

# fixed values: the clean table, in its column order
CLEAN_SCHEMA = _schema("""
    year integer, month integer, day_of_month integer, day_of_week integer, fl_date date,
    op_unique_carrier string, op_carrier_fl_num integer,
    origin string, origin_city_name string, origin_state_nm string,
    dest string, dest_city_name string, dest_state_nm string, route string,
    dep_delay double, arr_delay double,
    cancelled integer, is_cancelled integer, cancellation_code string, distance double,
    carrier_delay double, weather_delay double, nas_delay double,
    security_delay double, late_aircraft_delay double,
    primary_disruption_cause string, departure_delay_band string
""")
CLEAN_COLUMNS = CLEAN_SCHEMA.names

# fixed values: delay causes in the order that breaks ties, and cancellation codes
DELAY_CAUSES = {
    "carrier_delay": "carrier",
    "weather_delay": "weather",
    "nas_delay": "nas",
    "security_delay": "security",
    "late_aircraft_delay": "late_aircraft",
}
CANCELLATION_CAUSES = {"A": "carrier", "B": "weather", "C": "nas", "D": "security"}
NO_CAUSE = "none"
UNKNOWN_CANCELLATION = "cancellation_unknown"
CAUSES = (*DELAY_CAUSES.values(), UNKNOWN_CANCELLATION)

# fixed values: delay bands, upper bounds in minutes (bound, bound belongs to the band)
BAND_CUTS = ((15, False), (60, True))
BANDS = ("low", "medium", "high")
UNKNOWN_BAND = "unknown"

# fixed values: result columns of the two reports
ROUTE_STATS_SCHEMA = _schema(
    "op_unique_carrier string NOT NULL, route string NOT NULL, flight_count long NOT NULL, "
    "min_arr_delay double, max_arr_delay double, avg_arr_delay double, "
    "cancellation_rate double, operating_months string NOT NULL"
)
DELAY_REPORT_SCHEMA = _schema(
    "origin string NOT NULL, month integer NOT NULL, departure_delay_band string NOT NULL, "
    "flight_count long NOT NULL, avg_dep_delay double, avg_arr_delay double, "
    "top_3_causes string NOT NULL"
)

# fixed values: the order that defines the prefix samples, and the sample and scale names
SAMPLE_ORDER = (
    "fl_date", "op_unique_carrier", "op_carrier_fl_num", "origin", "dest",
    "dep_delay", "arr_delay", "cancelled", "route",
)
SAMPLE_ROWS = {"100k": 100_000, "500k": 500_000}
SAMPLE_SIZES = ("100k", "500k", "half", "full")
SCALE_FACTORS = {"1x": 1, "2x": 2, "4x": 4}
SCALE_SIZES = tuple(SCALE_FACTORS)

# fixed values: run records (the log of timed runs) and their listing orders
_RUN_COLUMNS = (
    "analysis string, technology string, run_size string, input_path string, "
    "output_path string, execution_time_seconds double, output_rows long, run_timestamp string"
)
RUN_SCHEMA = _schema(_RUN_COLUMNS)
RUN_SCHEMA_WITH_ENVIRONMENT = _schema(_RUN_COLUMNS + ", environment string")
ANALYSES = ("analysis_3_1", "analysis_3_2")
TECHNOLOGIES = ("spark_sql", "spark_core", "hive")
SUMMARY_COLUMNS = (
    "analysis", "technology", "run_size", "execution_time_seconds", "output_rows",
    "input_path", "output_path", "run_timestamp",
)
SUMMARY_COLUMNS_WITH_ENVIRONMENT = (*RUN_SCHEMA.names, "environment")
