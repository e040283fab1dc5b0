"""SQL fragments for the comparison queries: the marketplace tables and exact rounding."""

from __future__ import annotations

# Each fragment is one common table expression; a query names the ones it needs.
TABLES = {
    "cust": """
        SELECT c_custkey AS customer_key, CAST(c_custkey AS VARCHAR) AS customer_id,
               c_name AS customer_name, n_name AS city
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "rest": """
        SELECT s_suppkey AS restaurant_key, CAST(s_suppkey AS VARCHAR) AS restaurant_id,
               s_name AS restaurant_name, n_name AS city, r_name AS cuisine
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
    "line": """
        SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
                         l_discount, l_tax, l_returnflag, l_linestatus) AS copy
            FROM lineitem) AS numbered
        WHERE copy = 1""",
    "ord": """
        SELECT o_orderkey AS order_key, CAST(o_orderkey AS VARCHAR) AS order_id,
               o_custkey AS customer_key, served.restaurant_key,
               o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS order_timestamp,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_totalprice AS DECIMAL(10,2)) AS order_amount,
               CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PLACED'
                                  WHEN 'P' THEN 'CANCELLED' END AS order_status
        FROM orders LEFT JOIN (
            SELECT l_orderkey, MIN(l_suppkey) AS restaurant_key FROM lineitem GROUP BY l_orderkey
        ) AS served ON served.l_orderkey = o_orderkey""",
    "pay": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE l_linenumber % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'CASH'
                                     ELSE 'WALLET' END AS payment_method,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS payment_amount,
               CASE l_returnflag WHEN 'N' THEN 'SUCCESS' WHEN 'A' THEN 'FAILED'
                                 WHEN 'R' THEN 'REFUNDED' END AS payment_status,
               l_shipdate AS payment_timestamp, CAST(l_shipdate AS DATE) AS payment_date
        FROM line""",
    "paid": """
        SELECT order_id, SUM(payment_amount) AS revenue FROM pay
        WHERE payment_status = 'SUCCESS' GROUP BY order_id""",
    "dlv": """
        SELECT CAST(o_orderkey AS VARCHAR) AS delivery_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               l_partkey AS delivery_partner_key, CAST(o_orderdate AS DATE) AS order_date,
               o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS pickup_time,
               o_orderdate + to_seconds((o_orderkey * 37) % 86400
                   + 60 * date_diff('day', o_orderdate, l_shipdate)) AS delivery_time,
               CAST(date_diff('day', o_orderdate, l_shipdate) AS DECIMAL(8,2)) AS minutes,
               CASE WHEN l_linestatus = 'F' THEN 'DELIVERED' WHEN l_returnflag = 'R' THEN 'FAILED'
                    ELSE 'PICKED_UP' END AS delivery_status
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
              FROM line) AS placed
        JOIN orders ON o_orderkey = l_orderkey WHERE place = 1""",
    "attempt": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS run_id, CAST(ts AS DATE) AS run_date,
               CASE WHEN day(ts) = 1 THEN 'historical' ELSE 'incremental' END AS load_type,
               CASE WHEN event_type = 'error' THEN '_pipeline'
                    ELSE 'user ' || CAST(user_id AS VARCHAR) END AS dataset,
               CASE event_type WHEN 'signup' THEN 'ingestion' WHEN 'view' THEN 'validation'
                    WHEN 'click' THEN 'transformation' WHEN 'purchase' THEN 'warehouse_load'
                    WHEN 'error' THEN 'pipeline' END AS stage,
               CASE WHEN CAST(value AS DECIMAL(10,2)) > 150 THEN 'FAILED' ELSE 'SUCCESS' END
                   AS status,
               event_id AS records_in, event_id - user_id AS records_out,
               user_id AS records_rejected,
               CASE WHEN event_type = 'view'
                    THEN CAST(LEAST(CAST(value AS DECIMAL(10,2)), 100) AS DECIMAL(5,2)) END
                   AS quality_score,
               date_trunc('second', ts) AS started_at,
               date_trunc('second', ts) + to_seconds(CAST(FLOOR(value) AS BIGINT)) AS finished_at,
               CAST(value AS DECIMAL(10,2)) AS duration_seconds,
               CASE WHEN CAST(value AS DECIMAL(10,2)) > 150 THEN props END AS error_message
        FROM events""",
}
NEEDS = {"pay": ("line",), "paid": ("line", "pay"), "dlv": ("line",)}


def sql(body: str, *tables: str, **extra: str) -> str:
    """``body`` after a WITH clause holding ``tables`` (with what they need) and ``extra``."""
    wanted = [need for table in tables for need in (*NEEDS.get(table, ()), table)]
    parts = {name: TABLES[name] for name in dict.fromkeys(wanted)} | extra
    clause = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {clause}\n{body}" if parts else body


def hundredths(units: str, whole: str, precision: int = 10) -> str:
    """``units / whole`` in hundredths, rounded half away from zero with whole numbers only."""
    n, d = f"CAST({units} AS HUGEINT)", f"NULLIF(CAST({whole} AS HUGEINT), 0)"
    size = f"((2 * abs({n}) + {d}) // (2 * {d}))"
    signed = f"CASE WHEN {n} < 0 THEN -{size} ELSE {size} END"
    return f"CAST(CAST({signed} AS DECIMAL(18,0)) * 0.01 AS DECIMAL({precision},2))"


def share(part: str, whole: str) -> str:
    """Percentage with two decimals."""
    return hundredths(f"10000 * ({part})", whole, 5)


def mean(total: str, count: str, precision: int = 10) -> str:
    """Mean of a two-decimal sum."""
    return hundredths(f"100 * ({total})", count, precision)


def amount(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(20,2))"


def number(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
