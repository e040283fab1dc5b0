"""Marketplace shapes over order-processing tables (customers, suppliers, orders, order lines).

A supplier plays the restaurant, a line item the payment, the first line of an order its delivery
and a part the delivery partner.  Order times get a time of day from the order number, and one day
between order and shipment counts as one delivery minute, so both fit the marketplace's types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.model import ALLOWED, AUDIT, STAR, WHOLE_RUN
from ordermill.operators.calendar import calendar, date_key
from ordermill.operators.keyed import conform, top_per_key
from ordermill.sources.star import Star

FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
SNAPSHOT_DAY = "2001-12-31"

_LINE_ORDER = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def money(column: str):
    return F.col(column).cast("decimal(10,2)")


def text(column: str):
    return F.col(column).cast("string")


def one_of(column: str, **meaning: str):
    """Translate codes; others become NULL."""
    return F.coalesce(
        *(F.when(F.col(column) == code, F.lit(value)) for code, value in meaning.items())
    )


def order_time():
    """Order day plus a time of day derived from the order number."""
    second = F.pmod(F.col("o_orderkey") * F.lit(37), F.lit(86400))
    return F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + second)


def order_status():
    return one_of("o_orderstatus", F="DELIVERED", O="PLACED", P="CANCELLED")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with their region: 25 rows by definition of the tables."""
    region = read(spark, folder, "region")
    return F.broadcast(
        read(spark, folder, "nation")
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "customer")
        .join(places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_key"),
            text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.lit(None).cast("string").alias("email"),
            F.col("n_name").alias("city"),
            F.lit(FIRST_DAY).cast("date").alias("signup_date"),
        )
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "supplier")
        .join(places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("restaurant_key"),
            text("s_suppkey").alias("restaurant_id"),
            F.col("s_name").alias("restaurant_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("cuisine"),
            F.lit(None).cast("decimal(2,1)").alias("rating"),
        )
    )


def delivery_partners(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("delivery_partner_key"),
        text("p_partkey").alias("delivery_partner_id"),
        F.col("p_name").alias("partner_name"),
        F.col("p_brand").alias("city"),
        F.lit(FIRST_DAY).cast("date").alias("joining_date"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, one row per (order, line number): the first in a fixed order of the copies."""
    return top_per_key(
        read(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        *(F.col(name) for name in _LINE_ORDER),
    )


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of every order."""
    return top_per_key(
        read(spark, folder, "lineitem"),
        "l_orderkey",
        F.col("l_linenumber"),
        *(F.col(name) for name in _LINE_ORDER),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the lowest supplier among their lines; orders without lines have none."""
    served_by = (
        read(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("restaurant_key"))
    )
    return (
        read(spark, folder, "orders")
        .join(served_by, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("order_key"),
            text("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_key"),
            "restaurant_key",
            order_time().alias("order_timestamp"),
            money("o_totalprice").alias("order_amount"),
            order_status().alias("order_status"),
        )
    )


def payments(spark: SparkSession, folder: str, with_copies: bool = False) -> DataFrame:
    methods = F.array(*(F.lit(name) for name in ALLOWED["payment_method"]))
    source = read(spark, folder, "lineitem") if with_copies else lines(spark, folder)
    return source.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_key"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payment_id"),
        text("l_orderkey").alias("order_id"),
        F.get(methods, F.pmod(F.col("l_linenumber"), F.lit(4))).alias("payment_method"),
        money("l_extendedprice").alias("payment_amount"),
        one_of("l_returnflag", N="SUCCESS", A="FAILED", R="REFUNDED").alias("payment_status"),
        F.col("l_shipdate").cast("timestamp").alias("payment_timestamp"),
    )


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        F.when(F.col("l_linestatus") == "F", F.lit("DELIVERED"))
        .when(F.col("l_returnflag") == "R", F.lit("FAILED"))
        .otherwise(F.lit("PICKED_UP"))
    )
    ordered = read(spark, folder, "orders")
    gap = F.datediff("l_shipdate", "o_orderdate")
    pickup = order_time()
    arrival = F.timestamp_seconds(F.unix_seconds(pickup) + gap * F.lit(60))
    return (
        first_lines(spark, folder)
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("delivery_key"),
            text("l_orderkey").alias("delivery_id"),
            text("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("delivery_partner_key"),
            date_key("o_orderdate").alias("order_date_key"),
            pickup.alias("pickup_time"),
            arrival.alias("delivery_time"),
            gap.cast("decimal(8,2)").alias("delivery_duration_minutes"),
            status.alias("delivery_status"),
        )
    )


def days(spark: SparkSession) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(FIRST_DAY).cast("date").alias("start"), F.lit(LAST_DAY).cast("date").alias("end")
    )
    return calendar(bounds)


def star(spark: SparkSession, folder: str) -> Star:
    """The star schema over the order-processing tables; a table is opened when it is asked for."""
    build = {
        "dim_customer": lambda: customers(spark, folder),
        "dim_restaurant": lambda: restaurants(spark, folder),
        "dim_delivery_partner": lambda: delivery_partners(spark, folder),
        "dim_date": lambda: days(spark),
        "fact_order": lambda: orders(spark, folder).withColumn(
            "order_date_key", date_key("order_timestamp")
        ),
        "fact_payment": lambda: payments(spark, folder).withColumn(
            "payment_date_key", date_key("payment_timestamp")
        ),
        "fact_delivery": lambda: deliveries(spark, folder),
    }
    snapshot = F.lit(SNAPSHOT_DAY)
    stamps = {
        "source_ingestion_date": snapshot.cast("date"),
        "created_at": snapshot.cast("timestamp"),
        "updated_at": snapshot.cast("timestamp"),
    }
    return Star(lambda name: conform(build[name]().withColumns(stamps), STAR[name]))


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """Run audit over the event table: a day is a run, an event type a stage, a user a dataset."""
    event = read(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stage = one_of(
        "event_type",
        signup="ingestion",
        view="validation",
        click="transformation",
        purchase="warehouse_load",
        error="pipeline",
    )
    seconds = F.col("value").cast("decimal(10,2)")
    is_run = F.col("event_type") == "error"
    started = F.timestamp_seconds(F.unix_seconds("ts"))
    return conform(
        event.select(
            F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
            F.to_date("ts").alias("run_date"),
            F.when(F.dayofmonth("ts") == 1, "historical").otherwise("incremental").alias(
                "load_type"
            ),
            F.when(is_run, F.lit(WHOLE_RUN))
            .otherwise(F.concat(F.lit("user "), text("user_id")))
            .alias("dataset"),
            stage.alias("stage"),
            F.when(seconds > 150, "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("event_id").alias("records_in"),
            (F.col("event_id") - F.col("user_id")).alias("records_out"),
            F.col("user_id").alias("records_rejected"),
            F.when(F.col("event_type") == "view", F.least(seconds, F.lit(100))).alias(
                "quality_score"
            ),
            started.alias("started_at"),
            F.timestamp_seconds(F.unix_seconds("ts") + F.floor(seconds)).alias("finished_at"),
            seconds.alias("duration_seconds"),
            F.when(seconds > 150, F.col("props")).alias("error_message"),
        ),
        AUDIT,
    )
