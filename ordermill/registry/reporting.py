"""Views and business reports over the order-processing tables."""

from __future__ import annotations

from ordermill.plans.reports import REPORTS
from ordermill.plans.views import VIEWS
from ordermill.registry.sqltext import amount, mean, number, share, sql
from ordermill.sources import trade


def _over_star(build):
    return lambda spark, folder: build(trade.star(spark, folder))


QUERIES = {name: _over_star(view) for name, view in VIEWS.items()} | {
    f"q{name}": _over_star(report) for name, report in REPORTS.items()
}

_DAY_ORDERS = """
    SELECT order_date, COUNT(*) AS total_orders,
           COUNT(*) FILTER (WHERE order_status = 'DELIVERED') AS delivered_orders,
           COUNT(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_orders
    FROM ord GROUP BY order_date"""
DAY_REVENUE = f"""
    SELECT order_date, COUNT(revenue) AS paid_orders,
           {amount("COALESCE(SUM(revenue), 0)")} AS total_revenue
    FROM ord LEFT JOIN paid USING (order_id) GROUP BY order_date"""
_PERFORMANCE = f"""
    SELECT restaurant_id, restaurant_name, city, cuisine, CAST(NULL AS DECIMAL(2,1)) AS rating,
           COALESCE(orders_here, 0) AS total_orders,
           {amount("COALESCE(revenue_here, 0)")} AS total_revenue,
           {mean("revenue_here", "paid_here", 14)} AS average_order_value,
           {share("cancelled_here", "orders_here")} AS cancellation_rate_pct,
           {mean("minutes_here", "completed_here")} AS avg_delivery_minutes
    FROM rest
    LEFT JOIN (
        SELECT restaurant_key, COUNT(*) AS orders_here, COUNT(revenue) AS paid_here,
               SUM(revenue) AS revenue_here,
               COUNT(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_here
        FROM ord LEFT JOIN paid USING (order_id) GROUP BY restaurant_key) AS sold
        USING (restaurant_key)
    LEFT JOIN (
        SELECT restaurant_key, COUNT(*) AS completed_here, SUM(minutes) AS minutes_here
        FROM dlv JOIN ord USING (order_id) WHERE delivery_status = 'DELIVERED'
        GROUP BY restaurant_key) AS brought USING (restaurant_key)"""
_DELIVERED = f"""
    SELECT dlv.order_date, city, COUNT(*) AS total_deliveries,
           COUNT(*) FILTER (WHERE delivery_status = 'DELIVERED') AS completed_deliveries,
           COUNT(*) FILTER (WHERE delivery_status = 'FAILED') AS failed_deliveries,
           SUM(minutes) FILTER (WHERE delivery_status = 'DELIVERED') AS minutes,
           COUNT(*) FILTER (WHERE delivery_status = 'DELIVERED' AND minutes > 45)
               AS late_deliveries
    FROM dlv JOIN ord USING (order_id) JOIN rest USING (restaurant_key)
    GROUP BY dlv.order_date, city"""
_CUSTOMERS = f"""
    SELECT customer_id, customer_name, city, DATE '1995-01-01' AS signup_date,
           COALESCE(orders_made, 0) AS total_orders,
           {amount("COALESCE(spent, 0)")} AS total_spend, first_order_date, last_order_date,
           COALESCE(orders_made, 0) > 1 AS is_repeat_customer
    FROM cust LEFT JOIN (
        SELECT customer_key, COUNT(*) AS orders_made, SUM(revenue) AS spent,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
        FROM ord LEFT JOIN paid USING (order_id) GROUP BY customer_key) AS made
        USING (customer_key)"""
_PAYMENTS = f"""
    SELECT payment_date, payment_method, payment_status, COUNT(*) AS payment_count,
           {amount("SUM(payment_amount)")} AS total_amount
    FROM pay GROUP BY ALL"""

_AOV = mean("total_revenue", "paid_orders", 14)
_CANCEL = share("cancelled_orders", "total_orders")
_LATE = share("late_deliveries", "completed_deliveries")
_MINUTES = mean("minutes", "completed_deliveries")
_ORDER_TABLES = ("ord", "paid")


def _grouped(source: str, key: str) -> str:
    return f"""SELECT {key}, {number("SUM(total_orders)")} AS total_orders,
               {amount("SUM(total_revenue)")} AS total_revenue FROM ({source}) GROUP BY {key}"""


SQL = {
    "vw_daily_orders": sql(
        f"SELECT *, {_CANCEL} AS cancellation_rate_pct FROM ({_DAY_ORDERS})", "ord"
    ),
    "vw_daily_revenue": sql(
        f"SELECT *, {_AOV} AS average_order_value FROM ({DAY_REVENUE})", *_ORDER_TABLES
    ),
    "vw_restaurant_performance": sql(_PERFORMANCE, "rest", *_ORDER_TABLES, "dlv"),
    "vw_delivery_performance": sql(
        f"""SELECT * EXCLUDE (minutes), {_MINUTES} AS avg_delivery_minutes,
            {_LATE} AS late_delivery_rate_pct FROM ({_DELIVERED})""",
        "rest", "ord", "dlv",
    ),
    "vw_customer_summary": sql(_CUSTOMERS, "cust", *_ORDER_TABLES),
    "vw_payment_summary": sql(_PAYMENTS, "pay"),
    "q01_daily_orders": sql(_DAY_ORDERS, "ord"),
    "q02_daily_revenue": sql(DAY_REVENUE, *_ORDER_TABLES),
    "q03_average_order_value": sql(
        f"""SELECT *, {_AOV} AS average_order_value FROM (
            SELECT 'daily' AS period, * FROM ({DAY_REVENUE})
            UNION ALL
            SELECT 'overall', NULL, {number("SUM(paid_orders)")}, {amount("SUM(total_revenue)")}
            FROM ({DAY_REVENUE}))""",
        *_ORDER_TABLES,
    ),
    "q04_cancellation_rate": sql(
        f"""SELECT *, {_CANCEL} AS cancellation_rate_pct FROM (
            SELECT 'daily' AS period, * EXCLUDE (delivered_orders) FROM ({_DAY_ORDERS})
            UNION ALL
            SELECT 'overall', NULL, {number("SUM(total_orders)")},
                   {number("SUM(cancelled_orders)")} FROM ({_DAY_ORDERS}))""",
        "ord",
    ),
    "q05_payment_success_rate": sql(
        f"""SELECT *, {share("successful_payments", "total_payments")} AS success_rate_pct FROM (
            SELECT payment_method, COUNT(*) AS total_payments,
                   COUNT(*) FILTER (WHERE payment_status = 'SUCCESS') AS successful_payments
            FROM pay GROUP BY payment_method)""",
        "pay",
    ),
    "q06_revenue_by_city": sql(
        _grouped(_PERFORMANCE, "city"), "rest", *_ORDER_TABLES, "dlv"
    ),
    "q07_orders_by_restaurant": sql(
        f"""SELECT restaurant_id, restaurant_name, city, cuisine, total_orders,
            cancellation_rate_pct FROM ({_PERFORMANCE})""",
        "rest", *_ORDER_TABLES, "dlv",
    ),
    "q08_top_restaurants": sql(
        f"""SELECT * EXCLUDE (cancellation_rate_pct) FROM ({_PERFORMANCE})
            ORDER BY total_revenue DESC, restaurant_id LIMIT 10""",
        "rest", *_ORDER_TABLES, "dlv",
    ),
    "q09_orders_by_cuisine": sql(
        f"""SELECT *, {share("total_orders", "SUM(total_orders) OVER ()")} AS share_of_orders_pct
            FROM ({_grouped(_PERFORMANCE, "cuisine")})""",
        "rest", *_ORDER_TABLES, "dlv",
    ),
    "q10_average_delivery_time": sql(
        f"""SELECT * EXCLUDE (minutes), {_MINUTES} AS avg_delivery_minutes FROM (
            SELECT 'city' AS level, city, {number("SUM(completed_deliveries)")}
                       AS completed_deliveries, SUM(minutes) AS minutes
            FROM ({_DELIVERED}) WHERE completed_deliveries > 0 GROUP BY city
            UNION ALL
            SELECT 'overall', NULL, {number("SUM(completed_deliveries)")}, SUM(minutes)
            FROM ({_DELIVERED}))""",
        "rest", "ord", "dlv",
    ),
    "q11_late_deliveries": sql(
        f"""SELECT *, {_LATE} AS late_delivery_rate_pct FROM (
            SELECT 'city' AS level, city, {number("SUM(completed_deliveries)")}
                       AS completed_deliveries, {number("SUM(late_deliveries)")} AS late_deliveries
            FROM ({_DELIVERED}) GROUP BY city
            UNION ALL
            SELECT 'overall', NULL, {number("SUM(completed_deliveries)")},
                   {number("SUM(late_deliveries)")} FROM ({_DELIVERED}))""",
        "rest", "ord", "dlv",
    ),
    "q12_customer_order_frequency": sql(
        f"""SELECT *, {share("customers", "SUM(customers) OVER ()")} AS share_of_customers_pct
            FROM (SELECT total_orders AS orders_per_customer, COUNT(*) AS customers
                  FROM ({_CUSTOMERS}) WHERE total_orders > 0 GROUP BY total_orders)""",
        "cust", *_ORDER_TABLES,
    ),
    "q13_repeat_customers": sql(
        f"""SELECT *, {share("repeat_customers", "active_customers")} AS repeat_customer_rate_pct
            FROM (SELECT COUNT(*) AS active_customers,
                         COUNT(*) FILTER (WHERE is_repeat_customer) AS repeat_customers
                  FROM ({_CUSTOMERS}) WHERE total_orders > 0)""",
        "cust", *_ORDER_TABLES,
    ),
    "q14_monthly_revenue": sql(
        f"""SELECT *, {_AOV} AS average_order_value FROM (
            SELECT strftime(order_date, '%Y-%m') AS order_month,
                   {number("SUM(paid_orders)")} AS paid_orders,
                   {amount("SUM(total_revenue)")} AS total_revenue
            FROM ({DAY_REVENUE}) GROUP BY 1)""",
        *_ORDER_TABLES,
    ),
    "q15_peak_ordering_hours": sql(
        """SELECT *, RANK() OVER (ORDER BY total_orders DESC) AS order_rank FROM (
            SELECT CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
                   dayname(order_date) AS day_name, COUNT(*) AS total_orders
            FROM ord GROUP BY 1, 2)""",
        "ord",
    ),
}
