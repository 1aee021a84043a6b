"""Manufacturing-shaped views over the shared test tables.

The test tables are generic (orders, lineitem, events).  Each view below is a
pure projection of one table, so Spark keeps predicate pushdown and column
pruning down to the Parquet scan, and the same definitions are written in SQL
for the DuckDB oracle (``moldwise.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _reading_columns(k):
    et = F.col("event_type")
    variable = (F.when(et == "click", "Cushion")
                 .when(et == "view", "Time_on_machine")
                 .when(et == "signup", "Machine_status")
                 .when(et == "purchase", "Shot_counter")
                 .when((et == "error") & (k < 10), "Cyl_tmp_z2")
                 .when(et == "error", "Cycle_time"))
    value = (F.when(et == "click", F.col("value").cast("string"))
              .when(et == "view", F.date_format("ts", "HH:mm:ss"))
              .when(et == "signup", F.concat(F.lit("0"), F.chr(F.lit(65) + k % 3), F.lit("000")))
              .when(et == "purchase", F.col("event_id").cast("string"))
              .when((et == "error") & (k < 10), F.lit("0"))
              .when(et == "error", F.col("value").cast("string")))
    return variable, value


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sensor readings (library layout) from ``events``.

    Columns: machine_def, timestamp, variable_name, value (string),
    variable_attribute (always NULL, as in the profiled files).
    """
    return readings_from_events(table(spark, sf_dir, "events"))


def readings_from_events(ev: DataFrame, *more: Column) -> DataFrame:
    """The readings projection of an ``events`` frame (batch or stream), with ``more`` columns before it."""
    k = _k()
    variable, value = _reading_columns(k)
    return ev.select(
        *more,
        F.concat(F.lit("M"), F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit("-10")).alias("machine_def"),
        F.col("ts").alias("timestamp"),
        variable.alias("variable_name"),
        value.alias("value"),
        F.lit(None).cast("string").alias("variable_attribute"),
    )


def vertical_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings in the 'vertical' layout: month-first ``date`` string and
    ``machine_definition`` such as ``M117-11``."""
    ev = table(spark, sf_dir, "events")
    k = _k()
    variable, value = _reading_columns(k)
    return ev.select(
        F.date_format("ts", "M/d/yyyy").alias("date"),
        F.concat(F.lit("M"), (F.lit(100) + F.col("user_id") % 900).cast("string"), F.lit("-11"))
         .alias("machine_definition"),
        variable.alias("variable_name"),
        value.alias("value"),
    )


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production (order + shift) records from ``orders``.

    ``machine_id`` ``M-000cc`` maps to readings machine ``McCccc-10`` by core
    number; ``machine_nr`` ``M-1cc`` is the vertical-layout id; ``date`` is
    ``dd-MM-yyyy`` text; ``order_start`` a timestamp on that day.
    """
    o = table(spark, sf_dir, "orders")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 40).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("M-"), F.lpad((F.col("o_custkey") % 20).cast("string"), 5, "0")).alias("machine_id"),
        F.concat(F.lit("M-"), (F.lit(100) + F.col("o_custkey") % 20).cast("string")).alias("machine_nr"),
        F.date_format(day, "dd-MM-yyyy").alias("date"),
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), day.cast("timestamp_ntz")).alias("order_start"),
        ((F.col("o_orderkey") % 3) + 1).cast("int").alias("shift"),
        F.col("o_orderpriority").alias("article"),
        F.col("o_orderstatus").alias("order_status"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("actual_scrap_qty"),
    )


def hydra_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw production rows for the daily-scrap chain, from ``lineitem``.

    Several raw rows share (date, machine, tool, part); their daily value is
    the maximum, not the sum.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        F.concat(F.lit("M-"), F.col("l_suppkey").cast("string")).alias("machine_nr"),
        F.col("l_returnflag").alias("tool_number"),
        F.col("l_linestatus").alias("article"),
        F.col("l_quantity").alias("actual_scrap_qty"),
    )


def hydra_january(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw production rows dated in the sensor month (from ``orders``), so
    daily scrap and daily sensor means overlap on (date, machine)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int")).alias("date"),
        F.concat(F.lit("M-"), (F.lit(100) + F.col("o_custkey") % 20).cast("string")).alias("machine_nr"),
        F.concat(F.lit("T"), (F.col("o_custkey") % 7).cast("string")).alias("tool_number"),
        F.col("o_orderpriority").alias("article"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("actual_scrap_qty"),
    )


def customers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with missing values at several rates (none of the source
    tables has NULLs): c_name 1/3 missing, c_nationkey 2/3, c_acctbal 1/7,
    c_mktsegment 1/50."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k,
        F.when(k % 3 != 0, F.col("c_name")).alias("c_name"),
        F.when(k % 3 == 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 50 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


def customers_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with a ``balance`` that is NaN (1/7), NULL (1/11) or far off
    (1/97) for some rows."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    balance = (F.when(k % 7 == 0, F.lit(float("nan"))).when(k % 11 == 0, F.lit(None).cast("double"))
                .when(k % 97 == 0, F.col("c_acctbal") * 50).otherwise(F.col("c_acctbal")))
    return c.select(k, "c_mktsegment", balance.alias("balance"))


def hydra_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hydra_raw`` with NaN for every third line number, and text dates, ISO and month-first in turn."""
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    return li.select(
        F.when(F.col("l_linenumber") % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "M/d/yyyy")).alias("date"),
        F.concat(F.lit("M-"), F.col("l_suppkey").cast("string")).alias("machine_nr"),
        F.col("l_returnflag").alias("tool_number"), F.col("l_linestatus").alias("article"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double")).alias("actual_scrap_qty"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-resolution projection of ``orders``; repeated rows occur naturally."""
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")


def write_machine_files(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Readings as one CSV file for each of 20 groups of machines, in order of events, below ``base``.

    Group 11's file has no ``value``; some rows of group 3 have no time in
    ``timestamp``; group 5 has another order of columns.
    """
    group = (F.col("user_id") % 20).alias("grp")
    r = readings_from_events(table(spark, sf_dir, "events"), group, F.col("event_id"))
    broken = (F.col("grp") == 3) & (F.col("event_id") % 97 == 0)
    r = r.withColumn("timestamp", F.when(broken, "no time").otherwise(F.col("timestamp").cast("string")))
    r = r.repartition(20, "grp").sortWithinPartitions("grp", "event_id").drop("event_id")
    names = ["machine_def", "timestamp", "variable_name", "value", "variable_attribute"]
    for condition, columns in ((~F.col("grp").isin(5, 11), names), (F.col("grp") == 11, [c for c in names if c != "value"]),
                               (F.col("grp") == 5, names[::-1])):
        r.where(condition).select("grp", *columns).write.mode("append").partitionBy("grp").option("header", True).csv(base)
