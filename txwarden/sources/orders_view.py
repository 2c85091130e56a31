"""Transactions, reports and events shaped from the order and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that planning needs no job to look into the files; only the columns in use.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_acctbal double",
    "supplier": "s_suppkey long, s_nationkey int",
    "part": "p_partkey long, p_brand string",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _known(key: str) -> Column:
    """The key, or for a null one of many negative numbers that match nothing, so that orders
    without lines do not all meet in one task."""
    return F.coalesce(F.col(key), -1 - F.pmod(F.col("o_orderkey"), F.lit(4096)))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order; merchant and category come from its order lines."""
    lines = (
        _table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("_order"))
        .agg(F.min("l_suppkey").alias("merchantId"), F.min("l_partkey").alias("_part"))
    )
    return (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(lines, F.col("o_orderkey") == F.col("_order"), "left")
        .join(_table(spark, folder, "supplier"), _known("merchantId") == F.col("s_suppkey"), "left")
        .join(
            F.broadcast(_table(spark, folder, "nation")),  # 25 rows at every scale
            F.col("s_nationkey") == F.col("n_nationkey"),
            "left",
        )
        .join(_table(spark, folder, "part"), _known("_part") == F.col("p_partkey"), "left")
        .select(
            F.col("o_orderkey").alias("eventId"),
            F.col("o_custkey").alias("accountNumber"),
            "merchantId",
            F.col("p_brand").alias("mcc"),
            F.col("n_name").alias("merchantCountry"),
            F.col("s_nationkey").cast("string").alias("merchantZip"),
            F.col("o_orderpriority").alias("posEntryMode"),
            F.col("o_totalprice").alias("transactionAmount"),
            F.col("c_acctbal").alias("availableCash"),
            F.col("o_orderdate").alias("transactionTime"),
        )
    )


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reported events: orders whose first line was returned."""
    return (
        _table(spark, folder, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
        .groupBy(F.col("l_orderkey").alias("eventId"))
        .agg(F.min("l_shipdate").alias("reportedTime"))
    )


def event_transactions(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """The events as transactions with times inside the day, as a table or a stream."""
    if stream:
        reader = spark.readStream.schema(SCHEMAS["events"])
        # a stream reads folders: the filter picks the one table
        events = reader.option("pathGlobFilter", "events.parquet").parquet(folder)
    else:
        events = _table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("eventId"),
        F.col("user_id").alias("accountNumber"),
        F.get_json_object("props", "$.k").alias("merchantId"),
        F.col("event_type").alias("mcc"),
        F.col("event_type").alias("posEntryMode"),
        F.col("value").alias("transactionAmount"),
        F.col("ts").alias("transactionTime"),
    )
