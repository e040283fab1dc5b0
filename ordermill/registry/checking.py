"""Record checks over the order-processing tables written as raw text records."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.values import blank_to_null
from ordermill.model import KEY
from ordermill.operators.lookup import known_keys
from ordermill.quality import evaluate, report
from ordermill.quality.catalog import CATALOG, parents_of
from ordermill.registry.sqltext import share, sql
from ordermill.session import CODEC, shared_folder, side_by_side
from ordermill.sources import trade_raw

VALIDATED_AT = "2001-06-30 08:00:00"


def kept_in_folder(spark, purpose: str = "tagged"):
    """Write each frame once into the shared folder and go on with the written copy."""
    folder = shared_folder(spark, purpose)

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", CODEC).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return keep


def _tagged(spark, folder: str, *datasets: str) -> dict[str, DataFrame]:
    """Lazily tagged ``datasets`` with the parents their rules need."""
    needed = set(datasets)
    while True:
        more = needed | {parent for name in needed for parent in parents_of(name)}
        if more == needed:
            break
        needed = more
    raw = {name: trade_raw.RAW[name](spark, folder) for name in CATALOG if name in needed}
    tagged, valid = {}, {}
    for name in raw:
        scope = evaluate.scope_for(name, raw[name], trade_raw.RUN_DATE, valid, {})
        tagged[name] = evaluate.tag(raw[name], name, scope)
        valid[name] = evaluate.valid_keys(tagged[name], name)
    return tagged


def _broken_by(dataset: str, rule_id: str):
    """Keys and positions of the records that break one rule."""
    rule = next(r for r in CATALOG[dataset] if r.rule_id == rule_id)

    def query(spark, folder):
        raw = trade_raw.RAW[dataset](spark, folder)
        valid = {}
        if hasattr(rule, "parent"):
            valid = {
                name: evaluate.valid_keys(frame, name)
                for name, frame in _tagged(spark, folder, rule.parent).items()
            }
        scope = evaluate.scope_for(dataset, raw, trade_raw.RUN_DATE, valid, {})
        tagged = evaluate.tag(raw, dataset, scope, (rule,))
        return tagged.where(evaluate.breaks(dataset, rule)).select(
            F.col(KEY[dataset]).alias("key"), F.col("_source_row_number").alias("position")
        )

    return query


def _normalised(spark, folder):
    raw = trade_raw.RAW["payments"](spark, folder)
    return (
        evaluate.normalise(raw, "payments")
        .groupBy("payment_method", "payment_status")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _parent_keys(spark, folder):
    """Order keys known to the deliveries, out of this batch's valid orders."""
    tagged = _tagged(spark, folder, "orders")["orders"]
    valid = evaluate.valid_keys(tagged, "orders")
    wanted = trade_raw.RAW["delivery"](spark, folder).select(blank_to_null(F.col("order_id")))
    return known_keys(wanted.toDF("order_id"), valid)


def all_tagged(spark, folder, keep=None):
    """All datasets, from written raw records as in a daily run."""
    keep = keep or kept_in_folder(spark)
    raw = trade_raw.raw(spark, folder)
    written = side_by_side([partial(keep, f"{name}_raw", df) for name, df in raw.items()])
    return evaluate.tag_all(dict(zip(raw, written, strict=True)), trade_raw.RUN_DATE, keep=keep)


def _rule_counts(spark, folder):
    rows = None
    for dataset, tagged in all_tagged(spark, folder).items():
        counts = evaluate.rule_counts(evaluate.summary(tagged, dataset), dataset)
        rows = counts if rows is None else rows.unionByName(counts)
    return rows


def _scores(spark, folder):
    tagged = all_tagged(spark, folder)
    return report.scores({name: evaluate.summary(frame, name) for name, frame in tagged.items()})


def _gate(spark, folder):
    """Datasets that would stop the run."""
    return _scores(spark, folder).where("NOT passed").select("dataset", "quality_score")


def _valid_orders(spark, folder):
    tagged = _tagged(spark, folder, "orders")["orders"]
    return evaluate.valid_records(tagged, "orders").select(
        "order_id",
        "customer_id",
        "restaurant_id",
        F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        "order_amount",
        "order_status",
    )


def _quarantined_orders(spark, folder):
    tagged = _tagged(spark, folder, "orders")["orders"]
    return evaluate.quarantined_records(tagged, "orders", VALIDATED_AT).select(
        "order_id", "order_date", "order_amount", "order_status", "_dq_failed_rules"
    )


def _cascade(spark, folder):
    """Payments held back only because their order was held back."""
    tagged = _tagged(spark, folder, "payments")["payments"]
    rule = next(r for r in CATALOG["payments"] if r.rule_id == "DQ-PAY-003")
    return tagged.where(evaluate.breaks_only("payments", rule)).select(
        "payment_id", "order_id", F.col("_source_row_number").alias("position")
    )


def _reconcile(spark, folder):
    """Defects counted in the raw text against what the rules detect."""
    raw = trade_raw.RAW["orders"](spark, folder)
    expected = raw.agg(
        F.count_if(F.col("order_amount").startswith("-")).alias("negative"),
        F.count_if(F.col("order_status") == "lost").alias("lost"),
        F.count_if(F.length("order_date") == 10).alias("short"),
    ).selectExpr(
        "stack(3, 'DQ-ORD-006', negative, 'DQ-ORD-007', lost, 'DQ-ORD-008', short)"
        " AS (rule_id, expected_records)"
    )
    tagged = _tagged(spark, folder, "orders")["orders"]
    detected = evaluate.rule_counts(evaluate.summary(tagged, "orders"), "orders")
    return report.reconcile(expected, detected)


QUERIES = {
    "dq_normalise": _normalised,
    "dq_not_null": _broken_by("customers", "DQ-CUS-003"),
    "dq_not_null_warning": _broken_by("customers", "DQ-CUS-005"),
    "dq_unique": _broken_by("payments", "DQ-PAY-002"),
    "dq_in_set": _broken_by("payments", "DQ-PAY-005"),
    "dq_numeric_range": _broken_by("payments", "DQ-PAY-004"),
    "dq_numeric_range_optional": _broken_by("restaurants", "DQ-RES-003"),
    "dq_valid_date": _broken_by("customers", "DQ-CUS-004"),
    "dq_valid_timestamp": _broken_by("orders", "DQ-ORD-008"),
    "dq_valid_timestamp_pair": _broken_by("delivery", "DQ-DEL-007"),
    "dq_column_lte": _broken_by("delivery", "DQ-DEL-005"),
    "dq_exists_in": _broken_by("orders", "DQ-ORD-005"),
    "dq_required_when": _broken_by("delivery", "DQ-DEL-008"),
    "dq_parent_keys": _parent_keys,
    "dq_valid_split": _valid_orders,
    "dq_quarantine_split": _quarantined_orders,
    "dq_cascade": _cascade,
    "dq_rule_counts": _rule_counts,
    "dq_quality_score": _scores,
    "dq_gate": _gate,
    "dq_reconcile": _reconcile,
}

_RUN_DATE = "DATE '2001-06-30'"
_STAMP = "'%Y-%m-%d %H:%M:%S'"
_SIGNUP = "CAST(DATE '1995-01-01' + CAST(c_custkey * 7 % 3000 AS INTEGER) AS DATE)"


def _time(text: str) -> str:
    return f"try_strptime({text}, {_STAMP})"


RAW_SQL = {
    "raw_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey + 1 AS position,
               NULLIF(CASE WHEN c_nationkey = 0 THEN '' ELSE n_name END, '') AS city,
               c_name AS customer_name,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD'
                    THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
               CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0
                    THEN strftime({_SIGNUP}, '%d/%m/%Y') ELSE strftime({_SIGNUP}, '%Y-%m-%d') END
                   AS signup_date
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "flag_customers": f"""
        SELECT key, position, FALSE AS "DQ-CUS-001", FALSE AS "DQ-CUS-002",
               city IS NULL AS "DQ-CUS-003",
               COALESCE(try_strptime(signup_date, '%Y-%m-%d') > {_RUN_DATE}, TRUE) AS "DQ-CUS-004",
               email IS NULL AS "DQ-CUS-005"
        FROM raw_customers""",
    "flag_restaurants": """
        SELECT CAST(s_suppkey AS VARCHAR) AS key, s_suppkey + 1 AS position,
               FALSE AS "DQ-RES-001", FALSE AS "DQ-RES-002",
               CAST(s_acctbal AS DECIMAL(12,2)) >= 5050 OR CAST(s_acctbal AS DECIMAL(12,2)) <= -50
                   AS "DQ-RES-003"
        FROM supplier""",
    "flag_delivery_partners": """
        SELECT CAST(p_partkey AS VARCHAR) AS key, p_partkey + 1 AS position,
               FALSE AS "DQ-DPT-001", FALSE AS "DQ-DPT-002", FALSE AS "DQ-DPT-003"
        FROM part""",
    "ok_customers": """SELECT key AS customer_id FROM flag_customers
        WHERE NOT ("DQ-CUS-003" OR "DQ-CUS-004")""",
    "ok_restaurants": """SELECT key AS restaurant_id FROM flag_restaurants
        WHERE NOT "DQ-RES-003" """,
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey + 1 AS position,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(served_by AS VARCHAR) AS restaurant_id,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
                    THEN strftime(o_orderdate, '%Y-%m-%d')
                    ELSE strftime(o_orderdate + to_seconds((o_orderkey * 37) % 86400),
                                  '%Y-%m-%d %H:%M:%S') END AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) - 20000 AS VARCHAR) AS order_amount,
               CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'PLACED'
                    WHEN o_orderpriority = '1-URGENT' THEN 'LOST' ELSE 'CANCELLED' END
                   AS order_status
        FROM orders LEFT JOIN (
            SELECT l_orderkey, MIN(l_suppkey) AS served_by FROM lineitem GROUP BY l_orderkey
        ) AS served ON l_orderkey = o_orderkey""",
    "flag_orders": f"""
        SELECT key, position, FALSE AS "DQ-ORD-001", FALSE AS "DQ-ORD-002", FALSE AS "DQ-ORD-003",
               customer_id NOT IN (SELECT customer_id FROM ok_customers) AS "DQ-ORD-004",
               COALESCE(restaurant_id NOT IN (SELECT restaurant_id FROM ok_restaurants), TRUE)
                   AS "DQ-ORD-005",
               CAST(order_amount AS DECIMAL(10,2)) < 0 AS "DQ-ORD-006",
               order_status = 'LOST' AS "DQ-ORD-007",
               COALESCE(CAST({_time("order_date")} AS DATE) > {_RUN_DATE}, TRUE) AS "DQ-ORD-008"
        FROM raw_orders""",
    "ok_orders": """SELECT key AS order_id FROM flag_orders
        WHERE NOT ("DQ-ORD-004" OR "DQ-ORD-005" OR "DQ-ORD-006" OR "DQ-ORD-007" OR "DQ-ORD-008")""",
    "raw_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key,
               (l_orderkey * 10 + l_linenumber) * 1000000000
                   + (l_partkey * 50000 + l_suppkey * 50 + CAST(l_quantity AS BIGINT)) % 1000000000
                   AS position,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) - 5000 AS payment_amount,
               l_shipdate AS payment_timestamp,
               CASE WHEN l_returnflag = 'N' THEN 'SUCCESS' WHEN l_returnflag = 'A' THEN 'FAILED'
                    WHEN l_linestatus = 'O' THEN 'REFUNDED' ELSE 'PENDING' END AS payment_status,
               CASE WHEN l_linenumber = 7 THEN 'CHEQUE' WHEN l_linenumber % 4 = 0 THEN 'UPI'
                    WHEN l_linenumber % 4 = 1 THEN 'CARD' WHEN l_linenumber % 4 = 2 THEN 'CASH'
                    ELSE 'WALLET' END AS payment_method
        FROM lineitem""",
    "flag_payments": """
        SELECT key, position, order_id, FALSE AS "DQ-PAY-001",
               position > MIN(position) OVER (PARTITION BY key) AS "DQ-PAY-002",
               order_id NOT IN (SELECT order_id FROM ok_orders) AS "DQ-PAY-003",
               payment_amount < 0 AS "DQ-PAY-004", payment_status = 'PENDING' AS "DQ-PAY-005",
               payment_method = 'CHEQUE' AS "DQ-PAY-006", FALSE AS "DQ-PAY-007"
        FROM raw_payments""",
    "raw_delivery": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey + 1 AS position,
               date_diff('day', o_orderdate, l_shipdate) AS gap, CAST(l_partkey AS VARCHAR)
                   AS delivery_partner_id,
               o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS pickup_time,
               CASE WHEN date_diff('day', o_orderdate, l_shipdate) % 50 = 0 THEN 'unknown'
                    WHEN day(l_shipdate) <> 1 THEN 'readable' END AS delivery_time,
               CASE WHEN l_linestatus = 'F' THEN 'DELIVERED' WHEN l_returnflag = 'R' THEN 'FAILED'
                    WHEN l_returnflag = 'A' THEN 'RETURNED' ELSE 'PICKED_UP' END AS delivery_status
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
              FROM line) AS placed
        JOIN orders ON o_orderkey = l_orderkey WHERE place = 1""",
    "flag_delivery": """
        SELECT key, position, FALSE AS "DQ-DEL-001", FALSE AS "DQ-DEL-002",
               key NOT IN (SELECT order_id FROM ok_orders) AS "DQ-DEL-003",
               FALSE AS "DQ-DEL-004",
               COALESCE(delivery_time = 'readable' AND gap < 0, FALSE) AS "DQ-DEL-005",
               delivery_status = 'RETURNED' AS "DQ-DEL-006",
               COALESCE(delivery_time = 'unknown', FALSE) AS "DQ-DEL-007",
               delivery_time IS NULL AND delivery_status = 'DELIVERED' AS "DQ-DEL-008"
        FROM raw_delivery""",
}


def over_raw(body: str, line: bool = True) -> str:
    """``body`` over the raw and flagged records."""
    return sql(body, *(("line",) if line else ()), **RAW_SQL)


def errors(dataset: str) -> str:
    ids = [f'"{r.rule_id}"' for r in CATALOG[dataset] if r.severity == "ERROR"]
    return "(" + " OR ".join(ids) + ")"


def _broken_sql(dataset: str, rule_id: str) -> str:
    return over_raw(f'SELECT key, position FROM flag_{dataset} WHERE "{rule_id}"')


def _counts_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{r.rule_id}' AS rule_id, '{r.severity}' AS severity,
            COUNT(*) FILTER (WHERE "{r.rule_id}") AS failed_records FROM flag_{dataset}"""
        for dataset, rules in CATALOG.items()
        for r in rules
    )


SCORES = " UNION ALL ".join(
    f"""SELECT '{dataset}' AS dataset, COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE NOT {errors(dataset)}) AS valid_records FROM flag_{dataset}"""
    for dataset in CATALOG
)
_SCORED = f"""SELECT *, total_records - valid_records AS invalid_records,
    {share("valid_records", "total_records")} AS quality_score FROM ({SCORES})"""
_ORDER_RULES = ", ".join(
    f"""CASE WHEN "{r.rule_id}" THEN '{r.rule_id}' END""" for r in CATALOG["orders"]
)

SQL = {
    "dq_normalise": over_raw(
        """SELECT payment_method, payment_status, COUNT(*) AS records
           FROM raw_payments GROUP BY payment_method, payment_status"""
    ),
    "dq_not_null": _broken_sql("customers", "DQ-CUS-003"),
    "dq_not_null_warning": _broken_sql("customers", "DQ-CUS-005"),
    "dq_unique": _broken_sql("payments", "DQ-PAY-002"),
    "dq_in_set": _broken_sql("payments", "DQ-PAY-005"),
    "dq_numeric_range": _broken_sql("payments", "DQ-PAY-004"),
    "dq_numeric_range_optional": _broken_sql("restaurants", "DQ-RES-003"),
    "dq_valid_date": _broken_sql("customers", "DQ-CUS-004"),
    "dq_valid_timestamp": _broken_sql("orders", "DQ-ORD-008"),
    "dq_valid_timestamp_pair": _broken_sql("delivery", "DQ-DEL-007"),
    "dq_column_lte": _broken_sql("delivery", "DQ-DEL-005"),
    "dq_exists_in": _broken_sql("orders", "DQ-ORD-005"),
    "dq_required_when": _broken_sql("delivery", "DQ-DEL-008"),
    "dq_parent_keys": over_raw(
        "SELECT order_id FROM ok_orders WHERE order_id IN (SELECT key FROM raw_delivery)"
    ),
    "dq_valid_split": over_raw(
        """SELECT key AS order_id, customer_id, restaurant_id, order_date,
                  CAST(order_amount AS DECIMAL(10,2)) AS order_amount, order_status
           FROM raw_orders WHERE key IN (SELECT order_id FROM ok_orders)"""
    ),
    "dq_quarantine_split": over_raw(
        f"""SELECT key AS order_id, order_date, order_amount, order_status,
                   concat_ws(';', {_ORDER_RULES}) AS _dq_failed_rules
            FROM raw_orders JOIN flag_orders USING (key) WHERE {errors("orders")}"""
    ),
    "dq_cascade": over_raw(
        """SELECT key AS payment_id, order_id, position FROM flag_payments
           WHERE "DQ-PAY-003" AND NOT ("DQ-PAY-001" OR "DQ-PAY-002" OR "DQ-PAY-004"
                                       OR "DQ-PAY-005" OR "DQ-PAY-006" OR "DQ-PAY-007")"""
    ),
    "dq_rule_counts": over_raw(_counts_sql()),
    "dq_quality_score": over_raw(
        f"""SELECT *, quality_score >= 95 AS passed,
                   CASE WHEN quality_score >= 95 THEN 'PASSED' ELSE 'FAILED' END AS status
            FROM ({_SCORED})"""
    ),
    "dq_gate": over_raw(f"SELECT dataset, quality_score FROM ({_SCORED}) WHERE quality_score < 95"),
    "dq_reconcile": over_raw(
        """SELECT rule_id, expected_records, detected_records,
                  detected_records >= expected_records AS found
           FROM (SELECT 'DQ-ORD-006' AS rule_id,
                        COUNT(*) FILTER (WHERE order_amount LIKE '-%') AS expected_records,
                        COUNT(*) FILTER (WHERE "DQ-ORD-006") AS detected_records
                 FROM raw_orders JOIN flag_orders USING (key)
                 UNION ALL
                 SELECT 'DQ-ORD-007', COUNT(*) FILTER (WHERE order_status = 'LOST'),
                        COUNT(*) FILTER (WHERE "DQ-ORD-007")
                 FROM raw_orders JOIN flag_orders USING (key)
                 UNION ALL
                 SELECT 'DQ-ORD-008', COUNT(*) FILTER (WHERE length(order_date) = 10),
                        COUNT(*) FILTER (WHERE "DQ-ORD-008")
                 FROM raw_orders JOIN flag_orders USING (key))"""
    ),
}
