"""The fifteen business reports, run by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.values import percent, ratio, sum_if
from ordermill.plans import views
from ordermill.sources.star import Star

MONEY = views.MONEY
TOP_RESTAURANTS = 10


def _summed(*names: str):
    return [F.sum(name).alias(name) for name in names]


def _overall_and_detail(
    overall: DataFrame, detail: DataFrame, label: str, detail_name: str, by: str
) -> DataFrame:
    """One total row (present even without data) followed by the detail rows."""
    total = overall.withColumns(
        {label: F.lit("overall"), by: F.lit(None).cast(detail.schema[by].dataType)}
    )
    rows = detail.withColumn(label, F.lit(detail_name))
    columns = [label, by, *(name for name in detail.columns if name != by)]
    return (
        total.select(columns).unionByName(rows.select(columns)).orderBy(F.col(by).asc_nulls_first())
    )


def daily_orders(star: Star) -> DataFrame:
    return (
        views.daily_orders(star)
        .select("order_date", "total_orders", "delivered_orders", "cancelled_orders")
        .orderBy(F.col("order_date").asc_nulls_last())
    )


def daily_revenue(star: Star) -> DataFrame:
    return (
        views.daily_revenue(star)
        .select("order_date", "paid_orders", "total_revenue")
        .orderBy(F.col("order_date").asc_nulls_last())
    )


def average_order_value(star: Star) -> DataFrame:
    daily = views.daily_revenue(star)
    overall = daily.agg(
        F.sum("paid_orders").alias("paid_orders"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
    ).withColumn(
        "average_order_value", ratio(F.col("total_revenue"), F.col("paid_orders"), 14)
    )
    return _overall_and_detail(overall, daily, "period", "daily", "order_date")


def cancellation_rate(star: Star) -> DataFrame:
    daily = views.daily_orders(star).drop("delivered_orders")
    overall = daily.agg(*_summed("total_orders", "cancelled_orders")).withColumn(
        "cancellation_rate_pct", percent(F.col("cancelled_orders"), F.col("total_orders"))
    )
    return _overall_and_detail(overall, daily, "period", "daily", "order_date")


def payment_success_rate(star: Star) -> DataFrame:
    return (
        views.payment_summary(star)
        .groupBy("payment_method")
        .agg(
            F.sum("payment_count").alias("total_payments"),
            F.coalesce(
                sum_if(F.col("payment_status") == "SUCCESS", F.col("payment_count")), F.lit(0)
            ).alias("successful_payments"),
        )
        .withColumn(
            "success_rate_pct", percent(F.col("successful_payments"), F.col("total_payments"))
        )
        .orderBy(F.col("success_rate_pct").asc_nulls_last(), F.col("payment_method"))
    )


def _revenue_by(star: Star, column: str) -> DataFrame:
    return (
        views.restaurant_performance(star)
        .groupBy(column)
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        )
    )


def revenue_by_city(star: Star) -> DataFrame:
    return _revenue_by(star, "city").orderBy(F.col("total_revenue").desc(), F.col("city"))


def orders_by_restaurant(star: Star) -> DataFrame:
    return (
        views.restaurant_performance(star)
        .select(
            "restaurant_id",
            "restaurant_name",
            "city",
            "cuisine",
            "total_orders",
            "cancellation_rate_pct",
        )
        .orderBy(F.col("total_orders").desc(), F.col("restaurant_id"))
    )


def top_restaurants(star: Star) -> DataFrame:
    return (
        views.restaurant_performance(star)
        .drop("cancellation_rate_pct")
        .orderBy(F.col("total_revenue").desc(), F.col("restaurant_id"))
        .limit(TOP_RESTAURANTS)
    )


def orders_by_cuisine(star: Star) -> DataFrame:
    everything = F.sum("total_orders").over(Window.partitionBy())  # one row per cuisine by now
    return (
        _revenue_by(star, "cuisine")
        .withColumn("share_of_orders_pct", percent(F.col("total_orders"), everything))
        .orderBy(F.col("total_orders").desc(), F.col("cuisine"))
    )


def average_delivery_time(star: Star) -> DataFrame:
    cities = views.completed_per_city(star)
    average = ratio(F.col("minutes"), F.col("timed_deliveries")).alias("avg_delivery_minutes")
    overall = cities.agg(
        F.coalesce(F.sum("completed_deliveries"), F.lit(0)).alias("completed_deliveries"),
        *_summed("minutes", "timed_deliveries"),
    ).select("completed_deliveries", average)
    return _overall_and_detail(
        overall, cities.select("city", "completed_deliveries", average), "level", "city", "city"
    )


def late_deliveries(star: Star) -> DataFrame:
    per_day = views.delivery_performance(star)
    figures = _summed("completed_deliveries", "late_deliveries")
    rate = percent(F.col("late_deliveries"), F.col("completed_deliveries"))
    cities = per_day.groupBy("city").agg(*figures)
    overall = cities.agg(*figures)
    return _overall_and_detail(
        overall.withColumn("late_delivery_rate_pct", rate),
        cities.withColumn("late_delivery_rate_pct", rate),
        "level",
        "city",
        "city",
    )


def customer_order_frequency(star: Star) -> DataFrame:
    everyone = F.sum("customers").over(Window.partitionBy())  # one row per order count by now
    return (
        views.customer_summary(star)
        .where("total_orders >= 1")
        .groupBy(F.col("total_orders").alias("orders_per_customer"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("share_of_customers_pct", percent(F.col("customers"), everyone))
        .orderBy("orders_per_customer")
    )


def repeat_customers(star: Star) -> DataFrame:
    return (
        views.customer_summary(star)
        .where("total_orders >= 1")
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.count_if("is_repeat_customer").alias("repeat_customers"),
        )
        .withColumn(
            "repeat_customer_rate_pct",
            percent(F.col("repeat_customers"), F.col("active_customers")),
        )
    )


def monthly_revenue(star: Star) -> DataFrame:
    return (
        views.daily_revenue(star)
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month"))
        .agg(
            F.sum("paid_orders").alias("paid_orders"),
            F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        )
        .withColumn(
            "average_order_value", ratio(F.col("total_revenue"), F.col("paid_orders"), 14)
        )
        .orderBy("order_month")
    )


def peak_ordering_hours(star: Star) -> DataFrame:
    """At most 24 x 7 groups remain before the ranking window."""
    weekdays = F.broadcast(
        star.dim_date.select(
            F.col("date_key").alias("order_date_key"), "day_of_week", "day_name"
        )
    )
    return (
        star.fact_order.select("order_date_key", F.hour("order_timestamp").alias("order_hour"))
        .groupBy("order_date_key", "order_hour")
        .agg(F.count(F.lit(1)).alias("_orders"))
        .join(weekdays, "order_date_key")
        .groupBy("order_hour", "day_of_week", "day_name")
        .agg(F.sum("_orders").alias("total_orders"))
        .withColumn("order_rank", F.rank().over(Window.orderBy(F.col("total_orders").desc())))
        .orderBy(F.col("total_orders").desc(), "day_of_week", "order_hour")
        .select("order_hour", "day_name", "total_orders", "order_rank")
    )


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "01_daily_orders": daily_orders,
    "02_daily_revenue": daily_revenue,
    "03_average_order_value": average_order_value,
    "04_cancellation_rate": cancellation_rate,
    "05_payment_success_rate": payment_success_rate,
    "06_revenue_by_city": revenue_by_city,
    "07_orders_by_restaurant": orders_by_restaurant,
    "08_top_restaurants": top_restaurants,
    "09_orders_by_cuisine": orders_by_cuisine,
    "10_average_delivery_time": average_delivery_time,
    "11_late_deliveries": late_deliveries,
    "12_customer_order_frequency": customer_order_frequency,
    "13_repeat_customers": repeat_customers,
    "14_monthly_revenue": monthly_revenue,
    "15_peak_ordering_hours": peak_ordering_hours,
}


def run_report(name: str, star: Star) -> DataFrame:
    """A report by its registered name; other names are refused before any table is touched."""
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; known: {', '.join(REPORTS)}")
    return REPORTS[name](star)
