"""Lake protocol, star schema loads, post-load checks, audit and monitoring over the
order-processing tables."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from ordermill.functions.values import ratio
from ordermill.model import SOURCE, STAR, struct
from ordermill.operators.calendar import calendar, missing_days
from ordermill.operators.keyed import conform, top_per_key
from ordermill.operators.merge import CHANGE, merge, with_new_keys
from ordermill.operators.numbering import dense_index
from ordermill.plans import audit, checks, daily_run, load
from ordermill.plans import conform as conforming
from ordermill.quality import evaluate
from ordermill.registry.checking import SCORES, all_tagged, errors, kept_in_folder, over_raw
from ordermill.registry.reporting import DAY_REVENUE
from ordermill.registry.sqltext import mean, number, share, sql
from ordermill.registry.transforming import over_typed, typed
from ordermill.session import let_go, shared_folder, side_by_side
from ordermill.sources import ingest, layout, publish, trade, trade_raw
from ordermill.sources.lake import Lake
from ordermill.sources.star import Star
from ordermill.sources.warehouse import Warehouse

BATCH_DAY = date(2001, 6, 30)
SPLIT = "TIMESTAMP '1998-01-01'"


# --- calendar -----------------------------------------------------------------------------------


def _order_days(spark, folder):
    return trade.read(spark, folder, "orders").select(F.to_date("o_orderdate").alias("full_date"))


def _dim_date(spark, folder):
    bounds = _order_days(spark, folder).agg(
        F.min("full_date").alias("start"), F.max("full_date").alias("end")
    )
    return calendar(bounds)


def _missing_days(spark, folder):
    """Days between the first and last order on which nothing was ordered."""
    return missing_days(_dim_date(spark, folder), _order_days(spark, folder).distinct())


# --- merge --------------------------------------------------------------------------------------

_STORED = struct(
    "customer_key long, customer_id string, city string, source_ingestion_date date,"
    " created_at timestamp, updated_at timestamp"
)


def _customer_states(spark, folder):
    """Customers as of their last order before and since 1998, as two batches."""
    placed = trade.read(spark, folder, "orders")

    def batch(condition: str):
        last = top_per_key(
            placed.where(condition),
            "o_custkey",
            F.col("o_orderdate").desc(),
            F.col("o_orderkey").desc(),
        )
        return last.select(
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderpriority").alias("city"),
            F.to_date("o_orderdate").alias("source_ingestion_date"),
        )

    return batch(f"o_orderdate < {SPLIT}"), batch(f"o_orderdate >= {SPLIT}")


def _merged(stored_batch, new_batch):
    """Merge ``new_batch`` into a table made of ``stored_batch``."""
    stamp = F.lit("1998-01-01").cast("timestamp")
    stored = conform(
        dense_index(stored_batch, "customer_id", "customer_key").withColumns(
            {"created_at": stamp, "updated_at": stamp}
        ),
        _STORED,
    )
    highest = stored_batch.count()
    staged = with_new_keys(new_batch, stored, "customer_id", "customer_key", highest)
    merged = merge(stored, staged, "customer_id", "customer_key", "2001-12-31 00:00:00")
    return merged.select(
        "customer_id",
        "city",
        "source_ingestion_date",
        F.col(CHANGE).alias("change"),
        (F.col("customer_key") > highest).alias("new_key"),
        (F.col("created_at") == stamp).alias("created_before"),
        (F.col("updated_at") == stamp).alias("untouched"),
    )


def _merge_scd1(spark, folder):
    older, newer = _customer_states(spark, folder)
    return _merged(older, newer)


def _stale_guard(spark, folder):
    older, newer = _customer_states(spark, folder)
    return _merged(newer, older)


def _surrogate_keys(spark, folder):
    keyed = dense_index(
        trade.read(spark, folder, "orders").select("o_orderkey"), "o_orderkey", "key", after=100
    )
    return keyed.agg(
        F.count("key").alias("rows"),
        F.min("key").alias("lowest"),
        F.max("key").alias("highest"),
        F.count_distinct("key").alias("keys"),
    )


def _resolved(table: str, *shown: str):
    target = next(t for t in load.TARGETS if t.table == table)

    def query(spark, folder):
        records = typed(spark, folder, target.dataset)
        if target.dataset == "delivery":
            current = conforming.conformed("orders", typed(spark, folder, "orders"), "r1")
            staged = conforming.conformed("delivery", records, "r1", current)
        else:
            staged = conforming.conformed(target.dataset, records, "r1")
        return load.resolve(staged, target, trade.star(spark, folder)).select(target.key, *shown)

    return query


def _completeness(spark, folder):
    """Staged customers a table of older customers lacks."""
    older, newer = _customer_states(spark, folder)
    return newer.join(older.select("customer_id"), "customer_id", "left_anti").select("customer_id")


# --- a published and loaded batch ---------------------------------------------------------------

def published(spark, folder):
    """The raw records validated, quarantined where they break a rule, transformed and published."""
    root = shared_folder(spark, "batch")
    lake = Lake(spark, f"{root}/lake")
    tagged = all_tagged(spark, folder, kept_in_folder(spark, "batch-tagged"))
    validated_at = f"{BATCH_DAY} 08:00:00"

    def split(name: str) -> None:
        held = evaluate.quarantined_records(tagged[name], name, validated_at)
        lake.write_partition(evaluate.valid_records(tagged[name], name), "validated", name, BATCH_DAY, "r1")
        lake.write_partition(held, "quarantine", name, BATCH_DAY, "r1")

    let_go(spark)
    side_by_side([partial(split, name) for name in tagged])
    conforming.process(
        {
            name: lake.read_partition("validated", name, BATCH_DAY, daily_run.validated_schema(name))
            for name in tagged
        },
        {},
        "r1",
        keep=lambda name, df: publish.stage(lake, name, df, BATCH_DAY, "r1"),
        check=True,
    )
    let_go(spark)
    return lake, publish.publish(lake, BATCH_DAY, "r1")


def _loaded(spark, folder):
    """The published batch loaded into a star."""
    lake, _ = published(spark, folder)
    warehouse = Warehouse(spark, shared_folder(spark, "star"), key_buckets=8)
    results = load.load_warehouse(warehouse, lake, BATCH_DAY, trade.FIRST_DAY, trade.LAST_DAY)
    return warehouse, results


def _manifests(spark, folder):
    """Rows per dataset according to the manifests, and according to their lists of files."""
    lake, manifests = published(spark, folder)
    rows = None
    for manifest in manifests:
        files = publish.file_counts(lake, manifest["dataset"], BATCH_DAY)
        row = files.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_in_files")).select(
            F.lit(manifest["dataset"]).alias("dataset"),
            F.lit(manifest["row_count"]).cast("long").alias("row_count"),
            "rows_in_files",
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _load_results(spark, folder):
    _, results = _loaded(spark, folder)
    return spark.createDataFrame(
        [(r["table"], r["records_staged"], r["rows_updated"], r["rows_inserted"]) for r in results],
        "table_name string, records_staged long, rows_updated long, rows_inserted long",
    )


def _staged_rows(spark, folder):
    return checks.staged_rows(published(spark, folder)[0], BATCH_DAY)


def _loaded_star_checks(spark, folder):
    star = _loaded(spark, folder)[0].star()
    rows = None
    for check in checks.STAR_CHECKS:
        rows = check(star) if rows is None else rows.unionByName(check(star))
    return rows


def _loaded_revenue(spark, folder):
    """Daily revenue out of the loaded star schema."""
    from ordermill.plans import views

    return views.daily_revenue(_loaded(spark, folder)[0].star())


def _history(spark, folder):
    """Raw orders cleaned and stored by year, and what is read of them strictly before 1999.

    Orders without a readable date lie in the first year's partition.
    """
    lake = Lake(spark, shared_folder(spark, "history"))
    placed = conforming.conformed("orders", typed(spark, folder, "orders"), "r1")
    filed = F.coalesce(F.year("order_date"), F.lit(date.fromisoformat(trade.FIRST_DAY).year))
    placed.withColumns({"year": filed, "month": F.lit(1), "day": F.lit(1)}).write.partitionBy(
        "year", "month", "day"
    ).parquet(lake.uri("processed/orders"))
    return (
        lake.history("orders", date(1999, 1, 1))
        .groupBy(F.year("order_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").alias("amount"))
    )


def _ingested(spark, folder):
    """Orders written as a drop of several CSV files and ingested."""
    root = shared_folder(spark, "drop")
    drop = layout.drop("orders", "historical", BATCH_DAY)
    columns = SOURCE["orders"].fieldNames()
    raw = trade_raw.RAW["orders"](spark, folder).select(*columns)
    raw.write.csv(f"{root}/drops/{drop}", header=True, escape='"', emptyValue="")
    lake = Lake(spark, f"{root}/lake")
    ingest.ingest(lake, f"{root}/drops", "orders", "historical", BATCH_DAY, "r1")
    stored = lake.read_partition("raw", "orders", BATCH_DAY, ingest.raw_schema("orders"))
    return stored.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("_source_row_number").alias("first_row"),
        F.max("_source_row_number").alias("last_row"),
        F.count_distinct("_source_row_number").alias("row_numbers"),
        F.count("restaurant_id").alias("with_restaurant"),
        F.sum(F.col("order_amount").cast("decimal(12,2)")).alias("amount"),
        F.count_distinct("_source_file").alias("sources"),
    )


def _replaced(spark, folder):
    """Customers' partition written, replaced by its second version; another day untouched."""
    lake = Lake(spark, shared_folder(spark, "replace"))
    people = typed(spark, folder, "customers")
    other = date(2001, 6, 29)
    lake.write_partition(people, "validated", "customers", other, "r0")
    lake.write_partition(people, "validated", "customers", BATCH_DAY, "r0")
    lake.write_partition(people.where("city IS NOT NULL"), "validated", "customers", BATCH_DAY, "r1")
    schema = people.schema
    rows = None
    for day in (other, BATCH_DAY):
        stored = lake.read_partition("validated", "customers", day, schema)
        row = stored.agg(F.count(F.lit(1)).alias("records")).withColumn("day", F.lit(day))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _run_through(spark, folder):
    """A whole historical run: drops in CSV to checked star schema; all its audit records.

    A third of these records is broken on purpose, so the gate stands at 0; runs that pass it at 95 and
    that are stopped by it are ``run_gate_passed`` and ``run_gate_stopped``.
    """
    root = shared_folder(spark, "run")

    def write_drop(dataset: str) -> None:
        raw = trade_raw.RAW[dataset](spark, folder)
        # Files follow each other by record number, so file order is the records' order.
        ordered = raw.repartitionByRange("_source_row_number").sortWithinPartitions(
            "_source_row_number"
        )
        drop = layout.drop(dataset, "historical", trade_raw.RUN_DATE)
        ordered.select(*SOURCE[dataset].fieldNames()).write.csv(
            f"{root}/drops/{drop}", header=True, escape='"'
        )

    side_by_side([partial(write_drop, dataset) for dataset in SOURCE])
    run = daily_run.Run(
        Lake(spark, f"{root}/lake"),
        Warehouse(spark, f"{root}/star"),
        f"{root}/drops",
        trade_raw.RUN_DATE,
        "historical",
        "r1",
        min_score=0.0,
        calendar=(trade.FIRST_DAY, trade.LAST_DAY),
    )
    daily_run.run_all(run)
    return run.warehouse.read("pipeline_run_audit").select(
        "stage", "dataset", "status", "records_in", "records_out", "records_rejected", "quality_score"
    )


# --- checks over the mapped star ----------------------------------------------------------------


def _check(function, **damage):
    """A check over the mapped star with some tables damaged by ``damage[table](star, ...)``."""

    def query(spark, folder):
        whole = trade.star(spark, folder)

        def table(name):
            intact = getattr(whole, name)
            return damage[name](intact, spark, folder) if name in damage else intact

        return function(Star(table))

    return query


def _with_copies(payments, spark, folder):
    """Payments as delivered, line items repeating."""
    copies = trade.payments(spark, folder, with_copies=True).withColumns(
        {name: F.lit(None) for name in payments.columns if name.endswith("_at")}
        | {"payment_date_key": F.lit(None), "source_ingestion_date": F.lit(None)}
    )
    return conform(copies, STAR["fact_payment"])


def _until_2001(orders, spark, folder):
    return orders.where("order_timestamp < TIMESTAMP '2001-01-01'")


def _aov(spark, folder):
    """Mean order amount per day against the average order value of the payments."""
    star = trade.star(spark, folder)
    metrics = (
        star.fact_order.groupBy(F.to_date("order_timestamp").alias("order_date"))
        .agg(F.sum("order_amount").alias("_amount"), F.count(F.lit(1)).alias("_orders"))
        .select("order_date", ratio(F.col("_amount"), F.col("_orders"), 10).alias(
            "average_order_value"
        ))
    )
    return checks.aov_reconciliation(star, metrics)


# --- audit --------------------------------------------------------------------------------------


def _on_audit(function):
    def query(spark, folder):
        shown = function(trade.audit(spark, folder))
        return shown.select(
            *(
                F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
                if f.dataType.typeName() == "timestamp"
                else F.col(f.name)
                for f in shown.schema
            )
        )

    return query


def _audit_upsert(rows):
    """First half of the month as the table, the rest merged in; one record per key."""
    key = ["run_id", "dataset", "stage"]
    newest = F.col("started_at").desc(), F.col("records_in").desc()
    table = top_per_key(rows.where("hour(started_at) < 12"), key, *newest)
    new = top_per_key(rows.where("hour(started_at) >= 12"), key, *newest)
    return audit.upsert(table, new).select(*key, "status", "records_in", "duration_seconds")


QUERIES = {
    "src_ingest": _ingested,
    "src_history_before": _history,
    "snk_replace_partition": _replaced,
    "snk_publish_manifests": _manifests,
    "wh_dim_date": _dim_date,
    "wh_dim_date_missing_days": _missing_days,
    "wh_merge_scd1": _merge_scd1,
    "wh_stale_guard": _stale_guard,
    "wh_surrogate_keys": _surrogate_keys,
    "wh_resolve_fact_order": _resolved(
        "fact_order", "customer_key", "restaurant_key", "order_date_key", "order_status"
    ),
    "wh_resolve_fact_payment": _resolved(
        "fact_payment", "order_id", "payment_date_key", "payment_amount", "payment_status"
    ),
    "wh_resolve_fact_delivery": _resolved(
        "fact_delivery", "delivery_partner_key", "order_date_key", "delivery_duration_minutes"
    ),
    "wh_completeness": _completeness,
    "wh_load_batch": _load_results,
    "run_historical": _run_through,
    "wh_loaded_revenue": _loaded_revenue,
    "chk_staged_rows": _staged_rows,
    "chk_loaded_star": _loaded_star_checks,
    "chk_key_uniqueness": _check(checks.key_uniqueness, fact_payment=_with_copies),
    "chk_fact_keys": _check(checks.fact_keys),
    "chk_orphan_facts": _check(checks.facts_without_order, fact_order=_until_2001),
    "chk_aov_reconcile": _aov,
    "chk_negative_amounts": _check(checks.negative_amounts),
    "mon_recent_runs": _on_audit(audit.recent_runs),
    "mon_quality_trend": _on_audit(audit.quality_trend),
    "mon_slowest_stages": _on_audit(audit.slowest_stages),
    "aud_upsert": _on_audit(_audit_upsert),
    "aud_rollup": _on_audit(audit.run_rollup),
    "aud_failed_stages": _on_audit(audit.failed_stages),
    "aud_metrics": _on_audit(audit.stage_metrics),
}

# --- comparison SQL -----------------------------------------------------------------------------

_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
_DAYS = """SELECT CAST(day AS DATE) AS full_date FROM (
    SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS day
    FROM orders)"""
_CALENDAR = f"""SELECT {_KEY.format("full_date")} AS date_key, full_date,
    CAST(day(full_date) AS INTEGER) AS day_of_month,
    CAST(isodow(full_date) AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
    CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
    CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
    CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
    isodow(full_date) > 5 AS is_weekend FROM days"""


def _state(condition: str) -> str:
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS city,
        CAST(o_orderdate AS DATE) AS source_ingestion_date
        FROM orders WHERE {condition}
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


_STATES = {
    "older": _state(f"o_orderdate < {SPLIT}"),
    "newer": _state(f"o_orderdate >= {SPLIT}"),
}
_MERGED = """
    SELECT customer_id, city, source_ingestion_date, 'inserted' AS change, TRUE AS new_key,
           FALSE AS created_before, FALSE AS untouched
    FROM {staged} WHERE customer_id NOT IN (SELECT customer_id FROM {stored})
    UNION ALL
    SELECT s.customer_id, s.city, s.source_ingestion_date, 'updated', FALSE, TRUE, FALSE
    FROM {staged} AS s JOIN {stored} AS t USING (customer_id)
    WHERE s.source_ingestion_date >= t.source_ingestion_date
    UNION ALL
    SELECT t.customer_id, t.city, t.source_ingestion_date, 'kept', FALSE, TRUE, TRUE
    FROM {stored} AS t LEFT JOIN {staged} AS s USING (customer_id)
    WHERE s.customer_id IS NULL OR s.source_ingestion_date < t.source_ingestion_date"""

USABLE = f"""
    WITH placed AS (SELECT * FROM t_orders WHERE order_id IN (SELECT order_id FROM ok_orders)),
         settled AS (SELECT * FROM t_payments WHERE payment_id IN (
             SELECT key FROM flag_payments WHERE NOT {errors("payments")})),
         brought AS (SELECT * FROM t_delivery WHERE delivery_id IN (
             SELECT key FROM flag_delivery WHERE NOT {errors("delivery")}))"""
_LOADED_COUNTS = {
    "customers": ("dim_customer", "ok_customers"),
    "restaurants": ("dim_restaurant", "ok_restaurants"),
    "delivery_partners": ("dim_delivery_partner", "part"),
    "orders": ("fact_order", "placed"),
    "payments": ("fact_payment", "settled"),
    "delivery": ("fact_delivery", "brought"),
}


def _published_sql(template: str) -> str:
    """One row per published dataset."""
    rows = [
        template.format(dataset=dataset, table=table, source=source, counted="COUNT(*)", new="COUNT(*)")
        for dataset, (table, source) in _LOADED_COUNTS.items()
    ]
    rows.append(
        template.format(
            dataset="daily_order_metrics",
            table="stg_daily_order_metrics",
            source="placed",
            counted="COUNT(DISTINCT CAST(order_timestamp AS DATE))",
            new="CAST(0 AS BIGINT)",
        )
    )
    return " UNION ALL ".join(rows)


def _counted(check_id: str, counts: dict[str, str]) -> str:
    """One row per object from SELECTs that count its failures."""
    return " UNION ALL ".join(
        f"""SELECT '{check_id}' AS check_id, '{name}' AS object_name,
            CAST(({count}) AS BIGINT) AS failed_count"""
        for name, count in counts.items()
    )


def _repeats(key: str, source: str) -> str:
    return f"SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM {source}"


def _missing(condition: str, source: str) -> str:
    return f"SELECT COUNT(*) FROM {source} WHERE {condition}"


def _unique_counts(orders: str, payments: str, deliveries: str) -> dict[str, str]:
    return {
        "dim_customer": _repeats("c_custkey", "customer"),
        "dim_restaurant": _repeats("s_suppkey", "supplier"),
        "dim_delivery_partner": _repeats("p_partkey", "part"),
        "dim_date": "SELECT 0",
        "fact_order": _repeats("order_id", orders),
        "fact_payment": _repeats("payment_id", payments),
        "fact_delivery": _repeats("delivery_id", deliveries),
    }


def _key_counts(orders: str, payments: str, deliveries: str, customer: str, restaurant: str,
                partner: str) -> dict[str, str]:
    known = "NOT COALESCE({0} IN (SELECT CAST({1} AS {3}) FROM {2}), FALSE)"
    kind = "VARCHAR" if customer.endswith("_id") else "BIGINT"
    return {
        "fact_order.customer_key": _missing(
            known.format(customer, "c_custkey", "customer", kind), orders
        ),
        "fact_order.restaurant_key": _missing(
            known.format(restaurant, "s_suppkey", "supplier", kind), orders
        ),
        "fact_order.order_date_key": _missing("order_timestamp IS NULL", orders),
        "fact_payment.payment_date_key": _missing("payment_timestamp IS NULL", payments),
        "fact_delivery.delivery_partner_key": _missing(
            known.format(partner, "p_partkey", "part", kind), deliveries
        ),
        "fact_delivery.order_date_key": _missing("order_date IS NULL", deliveries),
    }


def _orphan_counts(orders: str, payments: str, deliveries: str) -> dict[str, str]:
    absent = f"order_id NOT IN (SELECT order_id FROM {orders})"
    return {
        "fact_payment.order_id": _missing(absent, payments),
        "fact_delivery.order_id": _missing(absent, deliveries),
    }


def _negative_counts(orders: str, payments: str) -> dict[str, str]:
    return {
        "fact_order.order_amount": _missing("order_amount < 0", orders),
        "fact_payment.payment_amount": _missing("payment_amount < 0", payments),
    }


def _run_sql() -> str:
    """Audit records of a run in which every valid record arrives."""
    none = "CAST(NULL AS BIGINT)"
    scored = f"""SELECT dataset, total_records AS total, valid_records AS valid,
        total_records - valid_records AS rejected, {share("valid_records", "total_records")} AS score
        FROM ({SCORES})"""
    days = "SELECT COUNT(DISTINCT CAST(order_timestamp AS DATE)) FROM placed"
    staged = f"""(SELECT dataset, valid FROM scored
        UNION ALL SELECT 'order_analytics', COUNT(*) FROM placed
        UNION ALL SELECT 'daily_order_metrics', ({days}))"""
    loaded = f"(SELECT * FROM {staged} WHERE dataset <> 'order_analytics')"

    def row(stage: str, dataset: str, read: str, written: str, rejected: str, score: str, source: str) -> str:
        return f"""SELECT '{stage}' AS stage, {dataset} AS dataset, 'SUCCESS' AS status,
            CAST({read} AS BIGINT) AS records_in, CAST({written} AS BIGINT) AS records_out,
            CAST({rejected} AS BIGINT) AS records_rejected, CAST({score} AS DECIMAL(5,2)) AS quality_score
            FROM {source}"""

    whole = "'_pipeline'"
    rows = (
        row("ingestion", "dataset", "total", "total", none, "NULL", "scored"),
        row("validation", "dataset", "total", "valid", "rejected", "score", "scored"),
        row("transformation", "dataset", none, "valid", none, "NULL", staged),
        row("publish", "dataset", none, "valid", none, "NULL", staged),
        row("warehouse_load", "dataset", "valid", "valid", none, "NULL", loaded),
        row("post_load_checks", whole, "6", none, "0", "NULL", "(SELECT 1)"),
        row("pipeline", whole, "SUM(total)", f"(SELECT SUM(valid) FROM {loaded})", "SUM(rejected)", "NULL",
            "scored"),
    )
    return f"SELECT * FROM ({USABLE}, scored AS ({scored}) {' UNION ALL '.join(rows)})"


_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"

SQL = {
    "src_ingest": over_typed(
        """SELECT COUNT(*) AS records, CAST(1 AS BIGINT) AS first_row, COUNT(*) AS last_row,
                  COUNT(*) AS row_numbers, COUNT(restaurant_id) AS with_restaurant,
                  CAST(SUM(order_amount) AS DECIMAL(22,2)) AS amount, CAST(1 AS BIGINT) AS sources
           FROM t_orders"""
    ),
    "src_history_before": over_typed(
        """SELECT CAST(year(order_timestamp) AS INTEGER) AS year, COUNT(*) AS orders,
                  CAST(SUM(order_amount) AS DECIMAL(20,2)) AS amount
           FROM t_orders WHERE year(order_timestamp) < 1999 OR order_timestamp IS NULL
           GROUP BY 1"""
    ),
    "snk_replace_partition": """
        SELECT DATE '2001-06-29' AS day, COUNT(*) AS records FROM customer
        UNION ALL SELECT DATE '2001-06-30', COUNT(*) FROM customer WHERE c_nationkey <> 0""",
    "snk_publish_manifests": over_typed(
        f"""SELECT * FROM ({USABLE}
            {_published_sql('''SELECT '{dataset}' AS dataset, {counted} AS row_count,
                                      {counted} AS rows_in_files FROM {source}''')}
            UNION ALL SELECT 'order_analytics', COUNT(*), COUNT(*) FROM placed)"""
    ),
    "wh_dim_date": sql(_CALENDAR, days=_DAYS),
    "wh_dim_date_missing_days": sql(
        f"{_CALENDAR} WHERE full_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
        days=_DAYS,
    ),
    "wh_merge_scd1": sql(_MERGED.format(stored="older", staged="newer"), **_STATES),
    "wh_stale_guard": sql(_MERGED.format(stored="newer", staged="older"), **_STATES),
    "wh_surrogate_keys": """SELECT COUNT(*) AS rows, CAST(101 AS BIGINT) AS lowest,
        100 + COUNT(*) AS highest, COUNT(DISTINCT o_orderkey) AS keys FROM orders""",
    "wh_resolve_fact_order": over_typed(
        f"""SELECT order_id, CAST(customer_id AS BIGINT) AS customer_key,
                   CAST(restaurant_id AS BIGINT) AS restaurant_key,
                   {_KEY.format("order_timestamp")} AS order_date_key, order_status
            FROM t_orders"""
    ),
    "wh_resolve_fact_payment": over_typed(
        f"""SELECT payment_id, order_id, {_KEY.format("payment_timestamp")} AS payment_date_key,
                   payment_amount, payment_status FROM t_payments"""
    ),
    "wh_resolve_fact_delivery": over_typed(
        f"""SELECT delivery_id, CAST(delivery_partner_id AS BIGINT) AS delivery_partner_key,
                   {_KEY.format("order_date")} AS order_date_key, delivery_duration_minutes
            FROM t_delivery"""
    ),
    "wh_completeness": sql(
        """SELECT customer_id FROM newer
           WHERE customer_id NOT IN (SELECT customer_id FROM older)""",
        **_STATES,
    ),
    "wh_load_batch": over_typed(
        f"""SELECT * FROM ({USABLE}
            {_published_sql('''SELECT '{table}' AS table_name, {counted} AS records_staged,
                                      CAST(0 AS BIGINT) AS rows_updated, {new} AS rows_inserted
                               FROM {source}''')})"""
    ),
    "run_historical": over_typed(_run_sql()),
    "wh_loaded_revenue": over_typed(
        f"""SELECT *, {mean("total_revenue", "paid_orders", 14)} AS average_order_value FROM (
            {USABLE} SELECT CAST(order_timestamp AS DATE) AS order_date,
                COUNT(revenue) AS paid_orders,
                CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(20,2)) AS total_revenue
            FROM placed LEFT JOIN (
                SELECT order_id, SUM(payment_amount) AS revenue FROM settled
                WHERE payment_status = 'SUCCESS' GROUP BY order_id) AS paid USING (order_id)
            GROUP BY 1)"""
    ),
    "chk_staged_rows": _counted(
        "WQ-001",
        {f"stg_{t.dataset}": "SELECT 0" for t in load.TARGETS}
        | {f"stg_{load.STAGED_ONLY}": "SELECT 0"},
    ),
    "chk_key_uniqueness": sql(
        _counted("WQ-002", _unique_counts("ord", "copies", "dlv")),
        "ord",
        "dlv",
        copies="SELECT l_orderkey * 10 + l_linenumber AS payment_id FROM lineitem",
    ),
    "chk_fact_keys": sql(
        _counted(
            "WQ-003",
            _key_counts(
                "ord", "pay", "dlv", "customer_key", "restaurant_key", "delivery_partner_key"
            ),
        ),
        "ord",
        "pay",
        "dlv",
    ),
    "chk_orphan_facts": sql(
        _counted("WQ-004", _orphan_counts("placed", "pay", "dlv")),
        "ord",
        "pay",
        "dlv",
        placed="SELECT * FROM ord WHERE order_timestamp < TIMESTAMP '2001-01-01'",
    ),
    "chk_aov_reconcile": sql(
        f"""SELECT 'WQ-005' AS check_id, 'daily_order_metrics.average_order_value' AS object_name,
                COUNT(*) FILTER (WHERE abs(COALESCE(stored, 0) - batch) > 0.01) AS failed_count
            FROM (SELECT order_date, {mean("SUM(order_amount)", "COUNT(*)")} AS batch
                  FROM ord GROUP BY order_date) AS metrics
            LEFT JOIN (SELECT order_date, {mean("total_revenue", "paid_orders", 14)} AS stored
                       FROM ({DAY_REVENUE})) AS warehouse USING (order_date)""",
        "ord",
        "paid",
    ),
    "chk_negative_amounts": sql(_counted("WQ-006", _negative_counts("ord", "pay")), "ord", "pay"),
    "mon_recent_runs": sql(
        f"""SELECT run_id, run_date, load_type, status, records_in, records_out, records_rejected,
                   duration_seconds, {_TIME.format("finished_at")}, error_message
            FROM (SELECT * FROM attempt WHERE stage = 'pipeline'
                  ORDER BY finished_at DESC, run_id LIMIT 7)""",
        "attempt",
    ),
    "mon_quality_trend": sql(
        """SELECT dataset, run_date, run_id, records_in, records_rejected, quality_score
           FROM attempt WHERE quality_score IS NOT NULL AND stage = 'validation'
           QUALIFY ROW_NUMBER() OVER (PARTITION BY run_date, dataset
                                      ORDER BY finished_at DESC, run_id DESC) = 1""",
        "attempt",
    ),
    "mon_slowest_stages": sql(
        f"""SELECT stage, COUNT(*) AS runs, {mean("SUM(seconds)", "COUNT(*)")} AS avg_seconds,
                   CAST(MAX(seconds) AS DECIMAL(20,2)) AS max_seconds
            FROM (SELECT run_id, stage, CASE stage WHEN 'ingestion' THEN SUM(duration_seconds)
                                                   ELSE MAX(duration_seconds) END AS seconds
                  FROM attempt WHERE stage <> 'pipeline' GROUP BY run_id, stage)
            GROUP BY stage""",
        "attempt",
    ),
    "aud_upsert": sql(
        """SELECT run_id, dataset, stage, status, records_in, duration_seconds FROM attempt
           QUALIFY ROW_NUMBER() OVER (PARTITION BY run_id, dataset, stage
               ORDER BY hour(started_at) >= 12 DESC, started_at DESC, records_in DESC) = 1""",
        "attempt",
    ),
    "aud_rollup": sql(
        f"""SELECT *, CAST(date_diff('second', CAST(started_at AS TIMESTAMP),
                                     CAST(finished_at AS TIMESTAMP)) AS DECIMAL(10,2))
                       AS duration_seconds
            FROM (SELECT run_id, run_date, MAX(load_type) AS load_type, '_pipeline' AS dataset,
                         'pipeline' AS stage, 'SUCCESS' AS status,
                         {number("SUM(records_in) FILTER (WHERE stage = 'ingestion')")}
                             AS records_in,
                         {number("SUM(records_out) FILTER (WHERE stage = 'warehouse_load')")}
                             AS records_out,
                         {number("SUM(records_rejected) FILTER (WHERE stage = 'validation')")}
                             AS records_rejected,
                         CAST(NULL AS DECIMAL(5,2)) AS quality_score,
                         strftime(MIN(started_at), '%Y-%m-%d %H:%M:%S') AS started_at,
                         strftime(MAX(finished_at), '%Y-%m-%d %H:%M:%S') AS finished_at,
                         CAST(NULL AS VARCHAR) AS error_message
                  FROM attempt WHERE stage <> 'pipeline' GROUP BY run_id, run_date)""",
        "attempt",
    ),
    "aud_failed_stages": sql(
        """SELECT run_id, stage || '/' || dataset AS failed FROM attempt
           WHERE status = 'FAILED' AND stage <> 'pipeline'""",
        "attempt",
    ),
    "aud_metrics": sql(
        """SELECT run_id, metric, NULLIF(dataset, '_pipeline') AS dataset, unit,
                  CAST(value AS DECIMAL(20,2)) AS value
           FROM (
               SELECT run_id, dataset, 'RecordsIngested' AS metric, 'Count' AS unit,
                      CAST(records_out AS DECIMAL(20,2)) AS value
               FROM attempt WHERE stage = 'ingestion' AND status = 'SUCCESS'
               UNION ALL
               SELECT run_id, dataset, 'RecordsRejected', 'Count', records_rejected
               FROM attempt WHERE stage = 'validation'
               UNION ALL
               SELECT run_id, dataset, 'DataQualityScore', 'Percent', quality_score
               FROM attempt WHERE stage = 'validation' AND records_in > 0
               UNION ALL
               SELECT run_id, dataset, 'PipelineSuccess', 'Count', 1
               FROM attempt WHERE stage = 'pipeline' AND status = 'SUCCESS'
               UNION ALL
               SELECT run_id, dataset, 'PipelineDurationSeconds', 'Seconds', duration_seconds
               FROM attempt WHERE stage = 'pipeline' AND status = 'SUCCESS'
               UNION ALL
               SELECT run_id, dataset, 'PipelineFailure', 'Count', 1
               FROM attempt WHERE stage = 'pipeline' AND status = 'FAILED')""",
        "attempt",
    ),
}
_LOADED_TABLES = ("placed", "settled", "brought")
SQL["chk_loaded_star"] = over_typed(
    f"SELECT * FROM ({USABLE} "
    + " UNION ALL ".join(
        (
            _counted("WQ-002", _unique_counts(*_LOADED_TABLES)),
            _counted(
                "WQ-003",
                _key_counts(*_LOADED_TABLES, "customer_id", "restaurant_id", "delivery_partner_id"),
            ),
            _counted("WQ-004", _orphan_counts(*_LOADED_TABLES)),
            _counted("WQ-006", _negative_counts(*_LOADED_TABLES[:2])),
        )
    )
    + ")"
)
