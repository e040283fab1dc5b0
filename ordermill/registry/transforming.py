"""Cleaning operators, conformed datasets and metrics over the order-processing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordermill.functions.values import (
    blank_to_null,
    half_up,
    minutes_between,
    parse_as,
    upper_code,
)
from ordermill.model import SOURCE, struct
from ordermill.operators.keyed import conform, current_state, deduplicate, top_per_key
from ordermill.operators.lookup import orphans
from ordermill.plans import conform as conforming
from ordermill.plans import metrics
from ordermill.quality.evaluate import LINEAGE_COLUMNS, normalise
from ordermill.registry.checking import over_raw
from ordermill.registry.sqltext import hundredths, mean, share, sql
from ordermill.sources import trade, trade_raw

RUN_ID = "r1"
_SECOND = "yyyy-MM-dd HH:mm:ss"


def typed(spark, folder: str, dataset: str):
    """Raw records in their types, unchecked."""
    clean = normalise(trade_raw.RAW[dataset](spark, folder), dataset)
    return clean.select(
        *(parse_as(F.col(f.name), f.dataType).alias(f.name) for f in SOURCE[dataset]),
        *LINEAGE_COLUMNS,
    )


def _shown(df):
    """Without the batch columns; times as text, so both engines print them alike."""
    return df.select(
        *(
            F.date_format(f.name, _SECOND).alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
            if f.name not in ("source_ingestion_date", "_run_id")
        )
    )


def _conformed(spark, folder: str, dataset: str):
    records = typed(spark, folder, dataset)
    dates = _conformed(spark, folder, "orders") if dataset == "delivery" else None
    return conforming.conformed(dataset, records, RUN_ID, dates)


def _conform_query(dataset: str):
    return lambda spark, folder: _shown(_conformed(spark, folder, dataset))


def _batch(spark, folder):
    return {dataset: typed(spark, folder, dataset) for dataset in SOURCE}


def _analytics(spark, folder):
    return conforming.process(_batch(spark, folder), {}, RUN_ID)["order_analytics"]


def _daily(spark, folder):
    made = conforming.process(_batch(spark, folder), {}, RUN_ID)
    return _shown(made["daily_order_metrics"])


def _processed_counts(spark, folder):
    rows = None
    for name, df in conforming.process(_batch(spark, folder), {}, RUN_ID).items():
        row = df.agg(F.count(F.lit(1)).alias("records")).withColumn("dataset", F.lit(name))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _payments_per_order(spark, folder):
    return metrics.payment_outcome(_conformed(spark, folder, "payments"))


def _latest_delivery(spark, folder):
    """Latest late-flagged delivery per delivery partner's order."""
    return metrics.delivery_outcome(_conformed(spark, folder, "delivery"))


def _orphans(spark, folder):
    """Customers of orders, which are not among the suppliers, with their numbers of orders."""
    known = trade.read(spark, folder, "supplier").select("s_suppkey")
    return orphans(trade.read(spark, folder, "orders"), "o_custkey", known)


def _null_orphans(spark, folder):
    """Orders without a known restaurant; a missing reference is an orphan too."""
    placed = _conformed(spark, folder, "orders")
    return orphans(placed, "restaurant_id", _conformed(spark, folder, "restaurants").select(
        "restaurant_id"
    ))


def _trim(spark, folder):
    padded = blank_to_null(F.concat(F.lit("  "), F.col("text"), F.lit(" ")))
    return trade.read(spark, folder, "documents").select(
        "doc_id",
        F.md5(padded.cast("binary")).alias("digest"),
        F.length(padded).alias("characters"),
        blank_to_null(F.lpad(F.lit(""), 3, " ")).alias("blank"),
    )


def _upper(spark, folder):
    return (
        trade.read(spark, folder, "events")
        .groupBy(upper_code(F.concat(F.lit(" "), "event_type")).alias("event_code"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def _dedupe(spark, folder):
    return (
        deduplicate(
            trade.read(spark, folder, "lineitem").withColumn("l_ship", F.to_date("l_shipdate")),
            ["l_orderkey", "l_linenumber"],
            ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_ship"],
        ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    )


def _latest(spark, folder):
    """Each user's last event."""
    return top_per_key(
        trade.read(spark, folder, "events"), "user_id", F.col("ts").desc(), F.col("event_id").desc()
    ).select("user_id", "event_id", "event_type", "value")


def _current(spark, folder):
    """Users' last event: the second half of the month is the batch, earlier days the history."""
    event = trade.read(spark, folder, "events").select(
        "user_id",
        "event_id",
        "event_type",
        F.to_date("ts").alias("source_ingestion_date"),
        "ts",
    )
    newest = F.col("ts").desc(), F.col("event_id").desc()
    batch = event.where("ts >= TIMESTAMP '2024-01-16'")
    earlier = event.where("ts < TIMESTAMP '2024-01-16'")
    return current_state(
        top_per_key(batch, "user_id", *newest),
        top_per_key(earlier, ["user_id", "source_ingestion_date"], *newest),
        "user_id",
    ).drop("ts")


def _rounded(spark, folder):
    """Discounted line prices rounded half up."""
    cents = F.col("l_extendedprice").cast("decimal(12,2)") * (
        F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    )
    return (
        trade.read(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linenumber")
        .agg(F.sum(half_up(cents, 12, 2)).alias("price_after_discount"))
    )


def _minutes(spark, folder):
    """Minutes from an order's day to each of its payments, in seconds' precision."""
    placed = trade.read(spark, folder, "orders").select("o_orderkey", trade.order_time().alias("t"))
    line = trade.read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("timestamp").alias("s")
    )
    return (
        line.join(placed, "o_orderkey")
        .select("o_orderkey", minutes_between(F.col("t"), F.col("s")).alias("minutes"))
        .groupBy("o_orderkey")
        .agg(F.min("minutes").alias("fewest"), F.max("minutes").alias("most"))
    )


def _parse(spark, folder):
    """How many order dates, written in three ways, each parser accepts."""
    written = trade.read(spark, folder, "orders").select(
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", _SECOND))
        .alias("written"),
        F.format_string("%.2f", "o_totalprice").alias("price"),
    )
    shape = struct("d date, t timestamp, p decimal(7,2)")
    return written.groupBy("o_orderstatus").agg(
        *(
            F.count(parse_as(F.col(source), shape[name].dataType)).alias(alias)
            for name, source, alias in (
                ("d", "written", "as_date"),
                ("t", "written", "as_timestamp"),
                ("p", "price", "as_price"),
            )
        )
    )


def _conform(spark, folder):
    return conform(
        trade.read(spark, folder, "customer"),
        struct("c_name string, c_custkey int, c_acctbal decimal(10,2)"),
    )


QUERIES = {
    "cln_trim_nullify": _trim,
    "cln_upper_codes": _upper,
    "cln_normalise_typed": lambda spark, folder: _shown(
        typed(spark, folder, "customers").drop(*LINEAGE_COLUMNS)
    ),
    "cln_dedupe": _dedupe,
    "cln_latest_by_key": _latest,
    "cln_current_state": _current,
    "cln_round_decimal": _rounded,
    "cln_minutes_between": _minutes,
    "cln_parse": _parse,
    "cln_conform": _conform,
    **{f"trf_{dataset}": _conform_query(dataset) for dataset in SOURCE},
    "trf_orphans": _orphans,
    "trf_orphans_without_reference": _null_orphans,
    "trf_payments_per_order": _payments_per_order,
    "trf_late_flag": _latest_delivery,
    "trf_order_analytics": lambda spark, folder: _shown(_analytics(spark, folder)),
    "trf_daily_metrics": _daily,
    "trf_processed_counts": _processed_counts,
}

_CUSTOMERS = """SELECT key AS customer_id, customer_name, email, city,
    CAST(try_strptime(signup_date, '%Y-%m-%d') AS DATE) AS signup_date FROM raw_customers"""
_ORDERS = """SELECT key AS order_id, customer_id, restaurant_id,
    try_strptime(order_date, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
    CAST(order_amount AS DECIMAL(10,2)) AS order_amount, order_status FROM raw_orders"""
_PAYMENTS = """SELECT key AS payment_id, order_id, payment_method,
    CAST(payment_amount AS DECIMAL(10,2)) AS payment_amount, payment_status, payment_timestamp
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY position) AS copy
          FROM raw_payments) AS numbered WHERE copy = 1"""
_DELIVERY = """SELECT d.key AS delivery_id, d.key AS order_id, delivery_partner_id, pickup_time,
    CASE WHEN delivery_time = 'readable' THEN pickup_time + to_minutes(gap) END AS delivery_time,
    CASE WHEN delivery_time = 'readable' THEN CAST(gap AS DECIMAL(8,2)) END
        AS delivery_duration_minutes, delivery_status, CAST(order_timestamp AS DATE) AS order_date
    FROM raw_delivery AS d LEFT JOIN t_orders AS o ON o.order_id = d.key"""
_RESTAURANTS = """SELECT CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
    n_name AS city, r_name AS cuisine,
    TRY_CAST(CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 0.001 AS VARCHAR) AS DECIMAL(2,1)) AS rating
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""
_PER_ORDER = """SELECT order_id,
    CAST(COALESCE(SUM(payment_amount) FILTER (WHERE payment_status = 'SUCCESS'), 0)
         AS DECIMAL(20,2)) AS paid_amount,
    CASE WHEN bool_or(payment_status = 'SUCCESS') THEN 'SUCCESS'
         ELSE arg_max(payment_status, (payment_timestamp, payment_id)) END AS payment_status
    FROM t_payments GROUP BY order_id"""
_LATE = """CASE WHEN delivery_status = 'DELIVERED' AND delivery_duration_minutes IS NOT NULL
    THEN delivery_duration_minutes > 45 END"""
_ANALYTICS = f"""SELECT o.order_id, CAST(order_timestamp AS DATE) AS order_date,
    CAST(hour(order_timestamp) AS INTEGER) AS order_hour, o.customer_id, c.city AS customer_city,
    o.restaurant_id, r.city AS restaurant_city, cuisine, order_amount, order_status,
    p.payment_status, CAST(COALESCE(paid_amount, 0) AS DECIMAL(10,2)) AS paid_amount,
    delivery_status, delivery_duration_minutes, {_LATE} AS is_late
    FROM t_orders AS o LEFT JOIN t_paid AS p ON p.order_id = o.order_id
    LEFT JOIN t_delivery AS d ON d.order_id = o.order_id
    LEFT JOIN t_customers AS c ON c.customer_id = o.customer_id
    LEFT JOIN t_restaurants AS r ON r.restaurant_id = o.restaurant_id"""
_TYPED = (
    f"t_customers AS ({_CUSTOMERS}), t_restaurants AS ({_RESTAURANTS}), t_orders AS ({_ORDERS}),"
    f" t_payments AS ({_PAYMENTS}), t_delivery AS ({_DELIVERY}), t_paid AS ({_PER_ORDER}),"
    f" t_analytics AS ({_ANALYTICS})"
)
_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def over_typed(body: str) -> str:
    return over_raw("@").replace("\n@", f",\n{_TYPED}\n{body}")


_DAILY = f"""SELECT *, {mean("total_revenue", "paid_orders")} AS average_order_value,
    {share("cancelled_orders", "total_orders")} AS cancellation_rate_pct FROM (
    SELECT order_date, COUNT(*) AS total_orders,
           COUNT(*) FILTER (WHERE payment_status = 'SUCCESS') AS paid_orders,
           CAST(COALESCE(SUM(paid_amount) FILTER (WHERE payment_status = 'SUCCESS'), 0)
                AS DECIMAL(14,2)) AS total_revenue,
           COUNT(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_orders
    FROM t_analytics GROUP BY order_date)"""

SQL = {
    "cln_trim_nullify": """SELECT doc_id, md5(NULLIF(TRIM(text), '')) AS digest,
        CAST(length(NULLIF(TRIM(text), '')) AS INTEGER) AS characters,
        CAST(NULL AS VARCHAR) AS blank FROM documents""",
    "cln_upper_codes": """SELECT upper(TRIM(' ' || event_type)) AS event_code,
        COUNT(*) AS events FROM events GROUP BY 1""",
    "cln_normalise_typed": over_raw(_CUSTOMERS),
    "cln_dedupe": sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM line", "line"
    ),
    "cln_latest_by_key": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "cln_current_state": """SELECT user_id, event_id, event_type,
        CAST(ts AS DATE) AS source_ingestion_date
        FROM events
        QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "cln_round_decimal": """SELECT l_returnflag, l_linenumber, CAST(SUM(CAST(
        (CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
        AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS price_after_discount
        FROM lineitem GROUP BY l_returnflag, l_linenumber""",
    "cln_minutes_between": f"""SELECT o_orderkey, MIN(minutes) AS fewest, MAX(minutes) AS most
        FROM (SELECT o_orderkey, {hundredths('''100 * date_diff('second',
              o_orderdate + to_seconds((o_orderkey * 37) % 86400), l_shipdate)''', "60", 12)}
              AS minutes FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
        GROUP BY o_orderkey""",
    "cln_parse": """SELECT o_orderstatus,
        COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS as_date,
        COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS as_timestamp,
        COUNT(*) FILTER (WHERE o_totalprice < 100000) AS as_price
        FROM orders GROUP BY o_orderstatus""",
    "cln_conform": """SELECT c_name, CAST(c_custkey AS INTEGER) AS c_custkey,
        CAST(c_acctbal AS DECIMAL(10,2)) AS c_acctbal FROM customer""",
    "trf_customers": over_typed("SELECT * FROM t_customers"),
    "trf_restaurants": over_typed("SELECT * FROM t_restaurants"),
    "trf_delivery_partners": """SELECT CAST(p_partkey AS VARCHAR) AS delivery_partner_id,
        p_name AS partner_name, p_brand AS city,
        CAST(DATE '1995-01-01' + p_size AS DATE) AS joining_date FROM part""",
    "trf_orders": over_typed(
        f"""SELECT * EXCLUDE (order_timestamp), {_TEXT.format("order_timestamp")},
            CAST(order_timestamp AS DATE) AS order_date FROM t_orders"""
    ),
    "trf_payments": over_typed(
        f"""SELECT * EXCLUDE (payment_timestamp), {_TEXT.format("payment_timestamp")},
            CAST(payment_timestamp AS DATE) AS payment_date FROM t_payments"""
    ),
    "trf_delivery": over_typed(
        f"""SELECT * EXCLUDE (pickup_time, delivery_time), {_TEXT.format("pickup_time")},
            {_TEXT.format("delivery_time")} FROM t_delivery"""
    ),
    "trf_orphans": """SELECT o_custkey AS key, COUNT(*) AS records FROM orders
        WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY o_custkey""",
    "trf_orphans_without_reference": over_typed(
        """SELECT restaurant_id AS key, COUNT(*) AS records FROM t_orders AS o
           WHERE NOT EXISTS (SELECT 1 FROM t_restaurants AS r
                             WHERE r.restaurant_id = o.restaurant_id) GROUP BY restaurant_id"""
    ),
    "trf_payments_per_order": over_typed("SELECT * FROM t_paid"),
    "trf_late_flag": over_typed(
        f"""SELECT order_id, delivery_status, delivery_duration_minutes, {_LATE} AS is_late
            FROM t_delivery"""
    ),
    "trf_order_analytics": over_typed("SELECT * FROM t_analytics"),
    "trf_daily_metrics": over_typed(_DAILY),
    "trf_processed_counts": over_typed(
        """SELECT 'customers' AS dataset, COUNT(*) AS records FROM customer
           UNION ALL SELECT 'restaurants', COUNT(*) FROM supplier
           UNION ALL SELECT 'delivery_partners', COUNT(*) FROM part
           UNION ALL SELECT 'orders', COUNT(*) FROM t_orders
           UNION ALL SELECT 'payments', COUNT(*) FROM t_payments
           UNION ALL SELECT 'delivery', COUNT(*) FROM t_delivery
           UNION ALL SELECT 'order_analytics', COUNT(*) FROM t_analytics
           UNION ALL SELECT 'daily_order_metrics', COUNT(DISTINCT order_date)
                            + MAX(CASE WHEN order_date IS NULL THEN 1 ELSE 0 END)
           FROM t_analytics"""
    ),
}
