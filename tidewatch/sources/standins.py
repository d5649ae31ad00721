"""Projections of the driver tables onto the transaction schema.

These only rename / retype columns so the pipeline sees rows of its own
schema; they do none of the pipeline's work (keys, windows, labels, ...).

* ``events``  -> transactions: id = event_id, time = epoch seconds of ts,
  amount = value, fraud = (event_type = 'error'), card1 = user_id,
  DeviceInfo = event_type, P_emaildomain = props.
* ``orders`` ⟕ ``customer`` -> tie-heavy transactions (midnight timestamps):
  id = o_orderkey, time = epoch seconds of o_orderdate, amount = o_totalprice,
  card1 = c_nationkey, fraud = (o_orderstatus = 'F'), DeviceInfo = o_orderpriority.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def epoch_seconds(c) -> F.Column:
    """Seconds since 1970-01-01 of a naive (``timestamp_ntz``) value, independent of the
    session time zone (a cast to ``timestamp`` would shift by the zone's offset)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("TransactionID"),
        epoch_seconds("ts").alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        (F.col("event_type") == "error").cast("int").alias("isFraud"),
        F.col("user_id").alias("card1"),
        F.col("event_type").alias("DeviceInfo"),
        F.col("props").alias("P_emaildomain"),
    )


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.select(
        F.col("o_orderkey").alias("TransactionID"),
        epoch_seconds("o_orderdate").alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        (F.col("o_orderstatus") == "F").cast("int").alias("isFraud"),
        F.col("c_nationkey").cast("bigint").alias("card1"),
        F.col("o_orderpriority").alias("DeviceInfo"),
    )


# DuckDB text of the same projections (for oracle SQL).
EVENTS_TX_SQL = """SELECT event_id AS TransactionID,
       CAST(floor(epoch(ts)) AS BIGINT) AS TransactionDT,
       value AS TransactionAmt,
       CAST(event_type = 'error' AS INTEGER) AS isFraud,
       user_id AS card1, event_type AS DeviceInfo, props AS P_emaildomain
FROM events"""

ORDERS_TX_SQL = """SELECT o_orderkey AS TransactionID,
       CAST(floor(epoch(o_orderdate)) AS BIGINT) AS TransactionDT,
       o_totalprice AS TransactionAmt,
       CAST(o_orderstatus = 'F' AS INTEGER) AS isFraud,
       CAST(c_nationkey AS BIGINT) AS card1, o_orderpriority AS DeviceInfo
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
