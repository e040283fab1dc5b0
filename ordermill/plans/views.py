"""Reporting views over the star schema.

Facts are reduced to one row per order, then to one row per reporting key, and only then joined to
dimensions.  Every shuffle therefore carries combined rows: an order with millions of payments, or
a restaurant with a third of all orders, is a handful of rows by the time it is moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.values import count_if, percent, ratio, sum_if
from ordermill.model import LATE_AFTER_MINUTES
from ordermill.sources.star import Star

MONEY = "decimal(20,2)"


def _dates(star: Star, key: str, name: str) -> DataFrame:
    """Calendar lookup; a calendar has one row per day, so it is always small enough to send."""
    return F.broadcast(
        star.dim_date.select(F.col("date_key").alias(key), F.col("full_date").alias(name))
    )


def paid_orders(star: Star) -> DataFrame:
    """Revenue per order that has at least one successful payment."""
    return (
        star.fact_payment.where(F.col("payment_status") == "SUCCESS")
        .groupBy("order_id")
        .agg(F.sum("payment_amount").alias("revenue"), F.count(F.lit(1)).alias("_paid"))
    )


def _with_revenue(star: Star, *columns: str) -> DataFrame:
    return star.fact_order.select("order_id", *columns).join(paid_orders(star), "order_id", "left")


def _is_completed():
    return (
        (F.col("delivery_status") == "DELIVERED")
        & F.col("pickup_time").isNotNull()
        & F.col("delivery_time").isNotNull()
    )


def daily_orders(star: Star) -> DataFrame:
    per_day = star.fact_order.groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_if(F.col("order_status") == "DELIVERED").alias("delivered_orders"),
        count_if(F.col("order_status") == "CANCELLED").alias("cancelled_orders"),
    )
    return per_day.join(_dates(star, "order_date_key", "order_date"), "order_date_key").select(
        "order_date",
        "total_orders",
        "delivered_orders",
        "cancelled_orders",
        percent(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate_pct"),
    )


def daily_revenue(star: Star) -> DataFrame:
    per_day = (
        _with_revenue(star, "order_date_key")
        .groupBy("order_date_key")
        .agg(F.count("_paid").alias("paid_orders"), F.sum("revenue").alias("_revenue"))
    )
    return per_day.join(_dates(star, "order_date_key", "order_date"), "order_date_key").select(
        "order_date",
        "paid_orders",
        F.coalesce("_revenue", F.lit(0)).cast(MONEY).alias("total_revenue"),
        ratio(F.col("_revenue"), F.col("paid_orders"), 14).alias("average_order_value"),
    )


def restaurant_performance(star: Star) -> DataFrame:
    delivered = (
        star.fact_delivery.where(_is_completed())
        .groupBy("order_id")
        .agg(
            F.sum("delivery_duration_minutes").alias("_minutes"),
            F.count("delivery_duration_minutes").alias("_timed"),
        )
    )
    per_restaurant = (
        _with_revenue(star, "restaurant_key", "order_status")
        .join(delivered, "order_id", "left")
        .groupBy("restaurant_key")
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.count("_paid").alias("_paid_orders"),
            F.sum("revenue").alias("_revenue"),
            count_if(F.col("order_status") == "CANCELLED").alias("_cancelled"),
            F.sum("_minutes").alias("_minutes"),
            F.sum("_timed").alias("_timed"),
        )
    )
    return star.dim_restaurant.join(per_restaurant, "restaurant_key", "left").select(
        "restaurant_id",
        "restaurant_name",
        "city",
        "cuisine",
        "rating",
        F.coalesce("_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("_revenue", F.lit(0)).cast(MONEY).alias("total_revenue"),
        ratio(F.col("_revenue"), F.col("_paid_orders"), 14).alias("average_order_value"),
        percent(F.col("_cancelled"), F.col("_orders")).alias("cancellation_rate_pct"),
        ratio(F.col("_minutes"), F.col("_timed")).alias("avg_delivery_minutes"),
    )


def _deliveries_per_restaurant(star: Star, *keys: str) -> DataFrame:
    """Additive delivery figures per restaurant and ``keys`` (columns of the delivery fact)."""
    completed = _is_completed()
    minutes = F.col("delivery_duration_minutes")
    per_order = star.fact_delivery.groupBy("order_id", *keys).agg(
        F.count(F.lit(1)).alias("_all"),
        count_if(completed).alias("_completed"),
        count_if(F.col("delivery_status") == "FAILED").alias("_failed"),
        sum_if(completed, minutes).alias("_minutes"),
        count_if(completed & minutes.isNotNull()).alias("_timed"),
        count_if(completed & (minutes > LATE_AFTER_MINUTES)).alias("_late"),
    )
    figures = ("_all", "_completed", "_failed", "_minutes", "_timed", "_late")
    return (
        per_order.join(star.fact_order.select("order_id", "restaurant_key"), "order_id")
        .groupBy("restaurant_key", *keys)
        .agg(*(F.sum(name).alias(name) for name in figures))
        .join(star.dim_restaurant.select("restaurant_key", "city"), "restaurant_key")
    )


def delivery_performance(star: Star) -> DataFrame:
    figures = ("_all", "_completed", "_failed", "_minutes", "_timed", "_late")
    per_city_day = (
        _deliveries_per_restaurant(star, "order_date_key")
        .groupBy("order_date_key", "city")
        .agg(*(F.sum(name).alias(name) for name in figures))
    )
    return per_city_day.join(_dates(star, "order_date_key", "order_date"), "order_date_key").select(
        "order_date",
        "city",
        F.col("_all").alias("total_deliveries"),
        F.col("_completed").alias("completed_deliveries"),
        F.col("_failed").alias("failed_deliveries"),
        ratio(F.col("_minutes"), F.col("_timed")).alias("avg_delivery_minutes"),
        F.col("_late").alias("late_deliveries"),
        percent(F.col("_late"), F.col("_completed")).alias("late_delivery_rate_pct"),
    )


def completed_per_city(star: Star) -> DataFrame:
    """Completed deliveries per restaurant city with their summed minutes (additive)."""
    return (
        _deliveries_per_restaurant(star)
        .where("_completed > 0")
        .groupBy("city")
        .agg(
            F.sum("_completed").alias("completed_deliveries"),
            F.sum("_minutes").alias("minutes"),
            F.sum("_timed").alias("timed_deliveries"),
        )
    )


def customer_summary(star: Star) -> DataFrame:
    per_customer = (
        _with_revenue(star, "customer_key", "order_date_key")
        .join(_dates(star, "order_date_key", "order_date"), "order_date_key")
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.sum("revenue").alias("_spend"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    return star.dim_customer.join(per_customer, "customer_key", "left").select(
        "customer_id",
        "customer_name",
        "city",
        "signup_date",
        F.coalesce("_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("_spend", F.lit(0)).cast(MONEY).alias("total_spend"),
        "first_order_date",
        "last_order_date",
        F.coalesce(F.col("_orders") >= 2, F.lit(False)).alias("is_repeat_customer"),
    )


def payment_summary(star: Star) -> DataFrame:
    grouped = star.fact_payment.groupBy(
        "payment_date_key", "payment_method", "payment_status"
    ).agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_amount").cast(MONEY).alias("total_amount"),
    )
    return grouped.join(
        _dates(star, "payment_date_key", "payment_date"), "payment_date_key"
    ).select("payment_date", "payment_method", "payment_status", "payment_count", "total_amount")


VIEWS = {
    "vw_daily_orders": daily_orders,
    "vw_daily_revenue": daily_revenue,
    "vw_restaurant_performance": restaurant_performance,
    "vw_delivery_performance": delivery_performance,
    "vw_customer_summary": customer_summary,
    "vw_payment_summary": payment_summary,
}


def register_views(star: Star) -> list[str]:
    """Create or replace the star tables and the views as temporary views for ``spark.sql``."""
    for name, table in star.tables().items():
        table.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
    return list(VIEWS)
