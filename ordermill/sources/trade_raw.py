"""Raw text records, as a drop would deliver them, over the order-processing tables.

Codes come in mixed case and padding; some dates, codes and amounts are unusable, keys repeat where
the line items repeat, and orders without lines lack a restaurant.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources import trade

RUN_DATE = date(2001, 6, 30)
_LINEAGE = (
    "TIMESTAMP '2001-06-30 06:00:00' AS _ingestion_timestamp",
    "DATE '2001-06-30' AS _ingestion_date",
    "'trade' AS _source_file",
)


def _records(df: DataFrame, position: str, *columns: str) -> DataFrame:
    return df.selectExpr(
        *columns, *_LINEAGE, f"CAST({position} AS BIGINT) AS _source_row_number", "'r1' AS _run_id"
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    joined = trade.read(spark, folder, "customer").join(
        trade.places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    signup = "date_add(DATE '1995-01-01', CAST(c_custkey * 7 % 3000 AS INT))"
    return _records(
        joined,
        "c_custkey + 1",
        "concat(' ', c_custkey, '  ') AS customer_id",
        "c_name AS customer_name",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '  '"
        " ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END AS email",
        "CASE WHEN c_nationkey = 0 THEN '' ELSE n_name END AS city",
        "CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0"
        f" THEN date_format({signup}, 'dd/MM/yyyy') ELSE date_format({signup}, 'yyyy-MM-dd') END"
        " AS signup_date",
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    joined = trade.read(spark, folder, "supplier").join(
        trade.places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return _records(
        joined,
        "s_suppkey + 1",
        "CAST(s_suppkey AS STRING) AS restaurant_id",
        "s_name AS restaurant_name",
        "n_name AS city",
        "r_name AS cuisine",
        "CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 0.001BD AS STRING) AS rating",
    )


def delivery_partners(spark: SparkSession, folder: str) -> DataFrame:
    return _records(
        trade.read(spark, folder, "part"),
        "p_partkey + 1",
        "CAST(p_partkey AS STRING) AS delivery_partner_id",
        "p_name AS partner_name",
        "p_brand AS city",
        "date_format(date_add(DATE '1995-01-01', p_size), 'yyyy-MM-dd') AS joining_date",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    served_by = (
        trade.read(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("served_by"))
    )
    placed = (
        trade.read(spark, folder, "orders")
        .join(served_by, "o_orderkey", "left")
        .withColumn("placed_at", trade.order_time())
    )
    return _records(
        placed,
        "o_orderkey + 1",
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "CAST(served_by AS STRING) AS restaurant_id",
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'"
        " THEN date_format(placed_at, 'yyyy-MM-dd')"
        " ELSE date_format(placed_at, 'yyyy-MM-dd HH:mm:ss') END AS order_date",
        "CAST(CAST(o_totalprice AS DECIMAL(12,2)) - 20000 AS STRING) AS order_amount",
        "CASE WHEN o_orderstatus = 'F' THEN ' delivered' WHEN o_orderstatus = 'O' THEN 'placed'"
        " WHEN o_orderpriority = '1-URGENT' THEN 'lost' ELSE 'Cancelled' END AS order_status",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return _records(
        trade.read(spark, folder, "lineitem"),
        # numbers the records: unique per order, line and copy
        "(l_orderkey * 10 + l_linenumber) * 1000000000"
        " + (l_partkey * 50000 + l_suppkey * 50 + CAST(l_quantity AS BIGINT)) % 1000000000",
        "concat(l_orderkey, '-', l_linenumber) AS payment_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CASE WHEN l_linenumber = 7 THEN 'cheque' WHEN l_linenumber % 4 = 0 THEN 'upi'"
        " WHEN l_linenumber % 4 = 1 THEN 'Card' WHEN l_linenumber % 4 = 2 THEN 'cash '"
        " ELSE 'WALLET' END AS payment_method",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - 5000 AS STRING) AS payment_amount",
        "CASE WHEN l_returnflag = 'N' THEN 'success' WHEN l_returnflag = 'A' THEN 'failed'"
        " WHEN l_linestatus = 'O' THEN 'refunded' ELSE 'pending' END AS payment_status",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS payment_date",
    )


def delivery(spark: SparkSession, folder: str) -> DataFrame:
    pickup = trade.order_time()
    gap = F.datediff("l_shipdate", "o_orderdate")
    joined = (
        trade.first_lines(spark, folder)
        .join(trade.read(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(
            {
                "gap": gap,
                "pickup": pickup,
                "arrival": F.timestamp_seconds(F.unix_seconds(pickup) + gap * F.lit(60)),
            }
        )
    )
    return _records(
        joined,
        "l_orderkey + 1",
        "CAST(l_orderkey AS STRING) AS delivery_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(l_partkey AS STRING) AS delivery_partner_id",
        "date_format(pickup, 'yyyy-MM-dd HH:mm:ss') AS pickup_time",
        "CASE WHEN gap % 50 = 0 THEN 'unknown' WHEN day(l_shipdate) = 1 THEN NULL"
        " ELSE date_format(arrival, 'yyyy-MM-dd HH:mm:ss') END AS delivery_time",
        "CASE WHEN l_linestatus = 'F' THEN 'delivered' WHEN l_returnflag = 'R' THEN 'Failed'"
        " WHEN l_returnflag = 'A' THEN 'returned' ELSE 'picked_up' END AS delivery_status",
    )


RAW = {
    "customers": customers,
    "restaurants": restaurants,
    "delivery_partners": delivery_partners,
    "orders": orders,
    "payments": payments,
    "delivery": delivery,
}


def raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All six raw datasets, lazily."""
    return {dataset: build(spark, folder) for dataset, build in RAW.items()}
