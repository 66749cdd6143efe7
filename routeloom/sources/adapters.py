"""The driver's tables seen as the inputs of this library.

``flights`` reads an order line as a flight from its supplier's nation to its customer's
nation; ``faulty_flights`` is the same with faults in it, for writing as raw text;
``run_records`` reads an event as the record of a timed run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from ..sinks.files import packed_text


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with both ends.

    Nations are joined last: before that each side is a table as it is stored, whose size
    Spark knows, so a small one is broadcast and the order lines are not shuffled for it.
    With every side large, they are shuffled twice, by supplier and by order.
    """
    nation = read_table(spark, sf_dir, "nation")
    here = nation.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_name")
    )
    there = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest_name")
    )
    customer = read_table(spark, sf_dir, "customer")
    orders = (
        read_table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
        .join(customer.select("c_custkey", "c_mktsegment", "c_nationkey"), "c_custkey")
    )
    supplier = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    return (
        read_table(spark, sf_dir, "lineitem")
        .join(supplier, "l_suppkey")
        .join(orders, "l_orderkey")
        .join(here, "s_nationkey")
        .join(there, "c_nationkey")
    )


def _flight_columns() -> dict[str, Column]:
    day = F.col("l_shipdate").cast("date")
    called_off = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)
    late = F.col("l_quantity") * 3 - 40
    discount = F.round(F.col("l_discount") * 100)
    tax = F.round(F.col("l_tax") * 100)
    segment = F.col("c_mktsegment")
    carrier = F.when(
        F.col("l_linenumber") == 7, F.concat(F.lit(" "), F.lower(segment), F.lit(" "))
    ).otherwise(segment)
    code = F.element_at(
        F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("D"), F.lit(None).cast("string")),
        (F.col("l_suppkey") % 5 + 1).cast("int"),
    )

    def if_large(value: Column) -> Column:
        return F.when(F.col("l_quantity") >= 19, value)

    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.weekday(day) + 1,
        "fl_date": day,
        "op_unique_carrier": carrier,
        "op_carrier_fl_num": F.col("l_partkey").cast("int"),
        "origin": F.col("origin_name"),
        "origin_city_name": F.col("origin_name"),
        "origin_state_nm": F.col("origin_name"),
        "dest": F.col("dest_name"),
        "dest_city_name": F.col("dest_name"),
        "dest_state_nm": F.col("dest_name"),
        "dep_delay": F.when(~(called_off & (F.col("l_linestatus") == "F")), late),
        "arr_delay": F.when(~called_off, late + discount - 5),
        "cancelled": F.when(called_off, 1).otherwise(0),
        "cancellation_code": F.when(called_off, code),
        "diverted": F.when((F.col("l_linenumber") == 7) & (discount == 0), 1).otherwise(0),
        "distance": F.abs(F.col("s_nationkey") - F.col("c_nationkey")) * 100.0 + 100.0,
        "carrier_delay": if_large((F.col("l_partkey") % 5) * F.lit(10.0)),
        "weather_delay": if_large((F.col("l_suppkey") % 4) * F.lit(10.0)),
        "nas_delay": if_large(discount * 5),
        "security_delay": if_large((F.col("l_linenumber") % 3) * F.lit(5.0)),
        "late_aircraft_delay": if_large(tax * 5),
    }


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw flight columns with natural types."""
    legs = _legs(spark, sf_dir)
    return legs.select(*[column.alias(name) for name, column in _flight_columns().items()])


def faulty_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw flight columns as they are to be written to CSV, with bad text in some rows.

    ``fault(m)`` is the order key modulo m; each kind of fault has a modulus of its own.
    Columns without faults are left for the CSV writer to turn into text.
    """
    columns = _flight_columns()

    def fault(modulus: int) -> Column:
        return F.col("l_orderkey") % modulus

    for name, kind in RAW_COLUMNS.items():
        if kind == "int_via_double":
            columns[name] = columns[name].cast("double")
    day, month = columns["fl_date"].cast("string"), columns["month"].cast("string")
    carrier, origin, dest = (columns[c] for c in ("op_unique_carrier", "origin", "dest"))
    columns["fl_date"] = F.when(fault(53) == 0, "2024-13-40").when(fault(53) != 1, day)
    columns["month"] = (
        F.when(fault(59) == 0, "13")
        .when(fault(59) == 1, "0")
        .when(fault(59) == 2, "x1")
        .when(fault(59) == 3, F.concat(month, F.lit(".0")))
        .otherwise(month)
    )
    columns["op_unique_carrier"] = F.when(fault(61) == 0, "  ").when(fault(61) != 1, carrier)
    columns["origin"] = (
        F.when(fault(79) == 0, F.concat(F.lit("  "), F.lower(origin)))
        .when(fault(79) == 1, " ")
        .otherwise(origin)
    )
    columns["dest"] = F.when(fault(83) == 0, F.concat(F.lower(dest), F.lit(" "))).when(
        fault(83) != 1, dest
    )
    columns["origin_city_name"] = F.concat(F.lit(" "), columns["origin_city_name"], F.lit(", X "))
    columns["dep_delay"] = F.when(fault(67) == 0, "abc").otherwise(
        columns["dep_delay"].cast("string")
    )
    columns["cancelled"] = F.when(fault(71) != 0, columns["cancelled"])
    columns["diverted"] = F.when(fault(73) != 0, columns["diverted"])
    columns["cancellation_code"] = F.lower(F.concat(F.lit(" "), columns["cancellation_code"]))
    return _legs(spark, sf_dir).select(*[c.alias(name) for name, c in columns.items()])


def write_faulty_csv(spark: SparkSession, sf_dir: str, path: str, codec: str = "none") -> None:
    """Write ``faulty_flights`` as a headed CSV, blanks kept."""
    write_raw_csv(faulty_flights(spark, sf_dir), path, codec=codec)


def write_raw_csv(rows: DataFrame, path: str, mode: str = "overwrite", codec: str = "none") -> None:
    """Rows of text as headed CSV, blanks kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.mode(mode).options(header=True, **keep, **packed_text(codec)).csv(path)


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per event, with ``event_id`` as its place in the log."""
    event = F.col("event_id")
    analysis = F.element_at(
        F.array(F.lit("analysis_3_1"), F.lit("analysis_3_2"), F.lit("analysis_9")),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    technology = (
        F.when(F.col("event_type") == "view", "spark_sql")
        .when(F.col("event_type") == "click", "spark_core")
        .when(F.col("event_type") == "purchase", "hive")
        .otherwise(F.col("event_type"))
    )
    size = F.element_at(
        F.array(*[F.lit(s) for s in ("100k", "500k", "half", "full", "1x", "2x", "4x", "8x")]),
        (event % 8 + 1).cast("int"),
    )
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        analysis.alias("analysis"),
        technology.alias("technology"),
        size.alias("run_size"),
        F.concat(F.lit("/data/"), size).alias("input_path"),
        F.concat(F.lit("/out/"), event.cast("string")).alias("output_path"),
        F.col("value").alias("execution_time_seconds"),
        event.alias("output_rows"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_timestamp"),
        F.when(F.col("user_id") % 2 == 1, F.lit("cluster")).alias("environment"),
    )
