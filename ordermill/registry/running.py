"""Whole runs over the order-processing tables: with and without damage, gated, incremental, late."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from ordermill.errors import QualityGateFailed, SourceMalformed
from ordermill.model import CONFORMED, SOURCE, WHOLE_RUN
from ordermill.plans import audit, checks, daily_run, load, views
from ordermill.plans.conform import conformed
from ordermill.plans.reports import run_report
from ordermill.quality import evaluate
from ordermill.quality.catalog import CATALOG
from ordermill.quality.rules import ERROR
from ordermill.registry.checking import kept_in_folder
from ordermill.registry.loading import BATCH_DAY, USABLE, published
from ordermill.registry.sqltext import share, sql
from ordermill.registry.transforming import over_typed, typed
from ordermill.session import CODEC, shared_folder, side_by_side
from ordermill.sources import ingest, layout, trade, trade_drops
from ordermill.sources.lake import Lake
from ordermill.sources.trade_drops import BASE, SOUND
from ordermill.sources.warehouse import Warehouse

FIRST, SECOND = date(2001, 12, 30), date(2001, 12, 31)
#: Orders from this day on come with the second drop.
SPLIT = "1998-07-01"
LIGHT, HEAVY = 1000, 10
#: Records of a drop's file where a drop has more than three files.
FILE_RECORDS = 500_000
#: The given table whose rows are a dataset's records, or more.
_FROM = {
    "customers": "customer",
    "restaurants": "supplier",
    "delivery_partners": "part",
    "orders": "orders",
    "payments": "lineitem",
    "delivery": "orders",
}


def _run(spark, root: str, day: date, load_type: str) -> daily_run.Run:
    return daily_run.Run(
        Lake(spark, f"{root}/lake"),
        Warehouse(spark, f"{root}/star", key_buckets=8),
        f"{root}/drops",
        day,
        load_type,
        f"run-{day}",
        calendar=(trade.FIRST_DAY, trade.LAST_DAY),
    )


# --- every rule ---------------------------------------------------------------------------------


def _every_rule(spark, folder):
    """Failed records of each of the 34 rules over records that were damaged for each."""
    keep = kept_in_folder(spark, "every-rule")
    made = {
        name: trade_drops.as_raw(trade_drops.damaged(build(spark, folder), name, HEAVY), name)
        for name, build in SOUND.items()
    }
    written = side_by_side([partial(keep, f"{name}_raw", df) for name, df in made.items()])
    tagged = evaluate.tag_all(dict(zip(made, written, strict=True)), SECOND, keep=keep)
    rows = None
    for name, frame in tagged.items():
        counts = evaluate.rule_counts(evaluate.summary(frame, name), name)
        rows = counts if rows is None else rows.unionByName(counts)
    return rows


# --- gated runs ---------------------------------------------------------------------------------


def _gated(damage: dict[str, int]):
    """A run over drops damaged as given, with the gate on: audit records and metrics it leaves."""

    def query(spark, folder):
        root = shared_folder(spark, "gated")

        def drop(name: str) -> None:
            records = SOUND[name](spark, folder)
            if name in damage:
                records = trade_drops.damaged(records, name, damage[name])
            trade_drops.write_drop(records, f"{root}/drops", name, "historical", FIRST)

        side_by_side([partial(drop, name) for name in SOUND])
        run = _run(spark, root, FIRST, "historical")
        try:
            daily_run.run_all(run)
        except QualityGateFailed:
            pass  # what it left is the result
        left = run.warehouse.read("pipeline_run_audit")
        nothing = F.lit(None).cast("long")
        stages = left.select(
            F.lit("audit").alias("kind"),
            F.col("stage").alias("name"),
            "dataset",
            "status",
            "records_in",
            "records_out",
            "records_rejected",
            F.col("quality_score").cast("decimal(20,2)").alias("value"),
            F.col("error_message").isNotNull().alias("has_error"),
        )
        seconds = F.col("metric") == "PipelineDurationSeconds"
        metrics = audit.stage_metrics(left).select(
            F.lit("metric").alias("kind"),
            F.col("metric").alias("name"),
            "dataset",
            F.lit(None).cast("string").alias("status"),
            *(nothing.alias(name) for name in ("records_in", "records_out", "records_rejected")),
            F.when(~seconds, F.col("value")).alias("value"),  # how long a run takes is not compared
            F.lit(False).alias("has_error"),
        )
        return stages.unionByName(metrics)

    return query


# --- incremental run ----------------------------------------------------------------------------


def _two_drops(spark, folder) -> dict[str, tuple]:
    """Records of both drops with the condition that they come with the historical one, not the next day's: that has
    new orders, changed old ones, late payments and deliveries of old orders, customers who moved."""
    sound = {name: build(spark, folder) for name, build in SOUND.items()}
    old = F.col("order_date") < SPLIT
    everybody = F.lit(True)

    def with_changed(name: str, which, column: str, value: str):
        """The records as they are, and those of ``which`` once more with another value."""
        own = F.struct(F.lit(False).alias("_again"), F.col(column).alias("_value"))
        changed = F.struct(F.lit(True).alias("_again"), F.lit(value).alias("_value"))
        both = F.array_compact(F.array(own, F.when(which, changed)))
        made = sound[name].withColumn("_version", F.explode(both))
        return made.withColumns({column: F.col("_version._value"), "_again": F.col("_version._again")})

    placed = with_changed("orders", old & (F.col(BASE) % 10 == 0), "order_status", "CANCELLED")
    people = with_changed("customers", F.col(BASE) % 5 == 0, "city", "Moved")
    days = sound["orders"].select("order_id", "order_date")
    paid_early = old & (F.col("payment_date") < SPLIT)
    brought_early = old & (F.col(BASE) % 4 != 0)
    return {
        "customers": (people, ~F.col("_again")),
        "restaurants": (sound["restaurants"], everybody),
        "delivery_partners": (sound["delivery_partners"], everybody),
        "orders": (placed, old & ~F.col("_again")),
        "payments": (sound["payments"].join(days, "order_id"), paid_early),
        "delivery": (sound["delivery"].join(days, "order_id"), brought_early),
    }


def _incremental(spark, folder):
    """A historical run, the next day's run, and the historical load once more, which comes too late
    for what the second run has changed: what each load did, and the star at the end."""
    root = shared_folder(spark, "incremental")
    drops = _two_drops(spark, folder)
    kinds = ((FIRST, "historical"), (SECOND, "incremental"))
    side_by_side(
        [
            partial(trade_drops.write_two_drops, *records, f"{root}/drops", name, kinds)
            for name, records in drops.items()
        ]
    )
    steps = []
    for day, kind in kinds:
        run = _run(spark, root, day, kind)
        daily_run.run_all(run)
        steps.append((kind, run.results["warehouse_load"]))
    late = load.load_warehouse(run.warehouse, run.lake, FIRST, trade.FIRST_DAY, trade.LAST_DAY)
    steps.append(("late", late))
    loads = spark.createDataFrame(
        [
            (step, r["table"], r["records_staged"], r["rows_updated"], r["rows_inserted"])
            for step, results in steps
            for r in results
        ],
        "step string, object string, rows long, updated long, inserted long",
    )
    star, left = run.warehouse.star(), None
    changed = F.count_if(F.col("updated_at") > F.col("created_at"))
    for target in load.TARGETS:
        row = getattr(star, target.table).agg(
            F.lit("star").alias("step"),
            F.lit(target.table).alias("object"),
            F.count(F.lit(1)).alias("rows"),
            changed.alias("updated"),
            F.count_distinct(target.key).alias("inserted"),
        )
        left = row if left is None else left.unionByName(row)
    nothing = F.lit(None).cast("long")
    for name, df in (
        ("moved customers", star.dim_customer.where("city = 'Moved'")),
        ("cancelled orders", star.fact_order.where("order_status = 'CANCELLED'")),
        ("dated deliveries", star.fact_delivery.where("order_date_key IS NOT NULL")),
    ):
        left = left.unionByName(
            df.agg(
                F.lit("star").alias("step"),
                F.lit(name).alias("object"),
                F.count(F.lit(1)).alias("rows"),
                nothing.alias("updated"),
                nothing.alias("inserted"),
            )
        )
    return loads.unionByName(left)


# --- drops --------------------------------------------------------------------------------------


def _headers(spark, folder):
    """Customers dropped in five ways, by nation: as agreed, with names in other case or order, without
    header, and with names that span lines.  What is found of each kind of file."""
    lake = Lake(spark, shared_folder(spark, "headers"))
    nation = trade.read(spark, folder, "customer").select(
        F.col("c_custkey").alias(BASE), (F.col("c_nationkey") % 5).alias("way")
    )
    people = trade_drops.customers(spark, folder).join(nation, BASE)
    agreed = SOURCE["customers"].fieldNames()
    spanning = F.concat("customer_name", F.lit('\n"second" line'))
    ways = (
        (people.select(*agreed, "way"), True),
        (people.select(*(F.col(name).alias(name.upper()) for name in agreed), "way"), True),
        (people.select(*reversed(agreed), "way"), True),
        (people.select(*agreed, "way"), False),
        (people.withColumn("customer_name", spanning).select(*agreed, "way"), True),
    )
    name = layout.drop("customers", "historical", FIRST)
    for way, (records, header) in enumerate(ways):
        chosen = records.where(F.col("way") == way).drop("way")
        chosen.write.mode("append").csv(lake.uri(name), header=header, escape='"')
    found = F.lower("header")
    kind = (
        F.when(F.col("agreed") & (F.col("open") > 0), "spanning lines")
        .when(F.col("agreed"), "agreed")
        .when(found == ",".join(agreed), "other case")
        .when(found == ",".join(reversed(agreed)), "other order")
        .otherwise("no header")
    )
    titles = F.when(F.col("kind") == "no header", 0).otherwise(1)
    return (
        ingest.file_facts(spark, lake.uri(name), "customers")
        .withColumn("kind", kind)
        .groupBy("kind")
        .agg(
            F.sum(F.col("lines") - titles).alias("lines"),
            F.sum("open").alias("open_lines"),
            F.sum("invalid").alias("invalid_lines"),
        )
    )


def _counts(spark, folder):
    """All six datasets as drops of several files, some of them with values that span lines: what was
    read, what was written, and the row numbers given.

    A larger table gives more files, not larger ones, as a file with values that span lines is read whole.
    """
    root = shared_folder(spark, "counts")
    lake = Lake(spark, f"{root}/lake")
    text = {"customers": "customer_name", "restaurants": "restaurant_name"}

    def one(name: str) -> dict:
        records = SOUND[name](spark, folder)
        if name in text:
            two_lines = F.concat(text[name], F.lit('\n, "known" too'))
            value = F.when(F.col(BASE) % 3 == 0, two_lines).otherwise(F.col(text[name]))
            records = records.withColumn(text[name], value)
        files = max(3, trade.read(spark, folder, _FROM[name]).count() // FILE_RECORDS)
        trade_drops.write_drop(records.repartition(files), f"{root}/drops", name, "historical", FIRST)
        return ingest.ingest(lake, f"{root}/drops", name, "historical", FIRST, "r1")

    results = side_by_side([partial(one, name) for name in SOUND])
    counted = spark.createDataFrame(
        [(r["dataset"], r["records_read"], r["records_written"]) for r in results],
        "dataset string, records_read long, records_written long",
    )
    rows = None
    for name in SOUND:
        stored = lake.read_partition("raw", name, FIRST, ingest.raw_schema(name))
        spans = F.count_if(F.col(text.get(name, SOURCE[name].fieldNames()[0])).contains("\n"))
        row = stored.agg(
            F.lit(name).alias("dataset"),
            F.count_distinct("_source_row_number").alias("row_numbers"),
            F.max("_source_row_number").alias("last_row"),
            spans.alias("spanning"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return counted.join(rows, "dataset")


def _raw_csv(spark, folder):
    """Raw records kept as CSV, read back by the contract."""
    path = f"{shared_folder(spark, 'raw-csv')}/orders"
    stamped = trade_drops.as_raw(
        trade_drops.damaged(SOUND["orders"](spark, folder), "orders", LIGHT), "orders"
    )
    stamp = F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    stamped.withColumn("_ingestion_timestamp", stamp).write.csv(path, header=True, escape='"')
    return (
        ingest.read_raw_csv(spark, path, "orders")
        .groupBy("order_status", "_ingestion_date", F.col("order_id").isNull().alias("without_id"))
        .agg(F.count(F.lit(1)).alias("records"), F.max("_source_row_number").alias("last_row"))
    )


# --- staged rows, keys and views ----------------------------------------------------------------


def _damaged_partitions(spark, folder):
    """WQ-001 over published partitions into which some rows were written again afterwards."""
    lake, _ = published(spark, folder)
    again = {
        "customers": "customer_id LIKE '%7'",
        "orders": "order_status = 'PLACED'",
        "payments": "payment_method = 'UPI'",
    }
    for name, which in again.items():
        stored = lake.read_partition("processed", name, BATCH_DAY, CONFORMED[name])
        copy = f"_tmp/damage/{name}"
        stored.where(which).write.option("compression", CODEC).parquet(lake.uri(copy))
        target = lake.uri(layout.partition("processed", name, BATCH_DAY))
        copied = lake.read(copy, CONFORMED[name])
        copied.write.mode("append").option("compression", CODEC).parquet(target)
    return checks.staged_rows(lake, BATCH_DAY)


def _history_keys(spark, folder):
    """Distinct orders in history before a run date; the second day repeats a tenth of the first's."""
    lake = Lake(spark, shared_folder(spark, "history-keys"))
    placed = conformed("orders", typed(spark, folder, "orders"), "r1")
    tenth = placed.where("CAST(order_id AS BIGINT) % 10 = 0")
    for day, rows in ((date(2001, 12, 28), placed), (FIRST, tenth), (SECOND, placed)):
        lake.write_partition(rows, "processed", "orders", day, "r1")
    both = lake.history("orders", SECOND)
    return lake.history_keys("orders", SECOND).agg(F.count(F.lit(1)).alias("keys")).crossJoin(
        both.agg(F.count(F.lit(1)).alias("rows"))
    )


def _refused(spark, folder):
    """Staged orders whose keys do not all resolve, per key that a load would be refused for."""
    target = next(t for t in load.TARGETS if t.table == "fact_order")
    staged = conformed("orders", typed(spark, folder, "orders"), "r1")
    resolved = load.resolve(staged, target, trade.star(spark, folder))
    return load.unresolved_keys(resolved, target)


def _by_name(spark, folder):
    """A view through ``spark.sql`` by its registered name, beside the report of that name."""
    star = trade.star(spark, folder)
    views.register_views(star)
    listed = spark.sql("SELECT order_date, total_orders FROM vw_daily_orders")
    named = run_report("01_daily_orders", star)
    return listed.join(
        named.select("order_date", F.col("total_orders").alias("reported")), "order_date", "full_outer"
    )


def _failure_record(spark, folder):
    """What a run leaves whose orders drop has a wrong header: the failed stage and the failed run."""
    root = shared_folder(spark, "failed-run")
    for name, build in SOUND.items():
        records = build(spark, folder).select(*SOURCE[name].fieldNames())
        if name == "orders":
            records = records.withColumnRenamed("order_status", "state")
        records.write.csv(
            f"{root}/drops/{layout.drop(name, 'historical', FIRST)}", header=True, escape='"'
        )
    run = _run(spark, root, FIRST, "historical")
    try:
        daily_run.run_all(run)
    except SourceMalformed:
        pass  # what it left is the result
    return run.warehouse.read("pipeline_run_audit").select(
        "stage",
        "dataset",
        "status",
        "records_in",
        "records_out",
        F.regexp_extract("error_message", r"^(\w+: [a-z ]+|\w+: \w+: [a-z ]+)", 1).alias("error"),
    )


QUERIES = {
    "src_headers": _headers,
    "src_counts": _counts,
    "src_raw_csv": _raw_csv,
    "src_history_keys": _history_keys,
    "dq_every_rule": _every_rule,
    "wh_unresolved_keys": _refused,
    "chk_damaged_partitions": _damaged_partitions,
    "vw_by_name": _by_name,
    "run_gate_passed": _gated({name: LIGHT for name in ("customers", "orders", "payments", "delivery")}),
    "run_gate_stopped": _gated({"payments": HEAVY}),
    "run_failed_header": _failure_record,
    "run_incremental": _incremental,
}

# --- comparison SQL -----------------------------------------------------------------------------

# Numbers of the sound records of each dataset.
_BASES = {
    "customers": "SELECT c_custkey AS k FROM customer",
    "restaurants": "SELECT s_suppkey AS k FROM supplier",
    "delivery_partners": "SELECT p_partkey AS k FROM part",
    "orders": "SELECT o_orderkey AS k FROM orders",
    "payments": "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS k FROM lineitem",
    "delivery": "SELECT DISTINCT l_orderkey AS k FROM lineitem",
}


def _every_rule_sql() -> str:
    """A rule fails for its own extra records; a missing customer is an unknown one too."""
    also = {"DQ-ORD-004": (3,)}
    rows = []
    for dataset, rules in CATALOG.items():
        for n, rule in enumerate(rules, 1):
            numbers = ", ".join(map(str, (n, *also.get(rule.rule_id, ()))))
            rows.append(
                f"""SELECT '{dataset}' AS dataset, '{rule.rule_id}' AS rule_id,
                    '{rule.severity}' AS severity, COUNT(*) AS failed_records
                    FROM ({_BASES[dataset]}) WHERE k % {HEAVY} IN ({numbers})"""
            )
    return " UNION ALL ".join(rows)


def _sizes_sql(damage: dict[str, int]) -> str:
    """Records, valid and rejected ones of each dataset as dropped."""
    rows = []
    for dataset, base in _BASES.items():
        every = damage.get(dataset)
        errors = [n for n, rule in enumerate(CATALOG[dataset], 1) if rule.severity == ERROR]
        warned = [n for n, rule in enumerate(CATALOG[dataset], 1) if rule.severity != ERROR]

        def extra(numbers: list[int], every=every) -> str:
            if not every or not numbers:
                return "0"
            return f"COUNT(*) FILTER (WHERE k % {every} IN ({', '.join(map(str, numbers))}))"

        rows.append(
            f"""SELECT '{dataset}' AS dataset, COUNT(*) + {extra(warned)} AS valid,
                {extra(errors)} AS rejected FROM ({base})"""
        )
    return " UNION ALL ".join(rows)


_SIZED = f"""SELECT dataset, CAST(valid AS BIGINT) AS valid, CAST(rejected AS BIGINT) AS rejected,
    CAST(valid + rejected AS BIGINT) AS total, {share("valid", "valid + rejected")} AS score FROM sizes"""
_NO = "CAST(NULL AS BIGINT)"


def _row(kind, name, dataset, status, read, written, rejected, value="NULL", error="FALSE", source="sized") -> str:
    return f"""SELECT '{kind}' AS kind, '{name}' AS name, {dataset} AS dataset, {status} AS status,
        {read} AS records_in, {written} AS records_out, {rejected} AS records_rejected,
        CAST({value} AS DECIMAL(20,2)) AS value, {error} AS has_error FROM {source}"""


def _gated_sql(damage: dict[str, int], stopped: bool) -> str:
    ok, none = "'SUCCESS'", "CAST(NULL AS VARCHAR)"
    whole = f"'{WHOLE_RUN}'"
    staged = """(SELECT dataset, valid FROM sized
        UNION ALL SELECT 'order_analytics', valid FROM sized WHERE dataset = 'orders'
        UNION ALL SELECT 'daily_order_metrics', COUNT(DISTINCT CAST(o_orderdate AS DATE)) FROM orders)"""
    loaded = f"(SELECT * FROM {staged} WHERE dataset <> 'order_analytics')"
    judged = "CASE WHEN score >= 95 THEN 'SUCCESS' ELSE 'FAILED' END"
    totals = "(SELECT CAST(SUM(total) AS BIGINT) AS total, CAST(SUM(rejected) AS BIGINT) AS rejected FROM sized)"
    rows = [
        _row("audit", "ingestion", "dataset", ok, "total", "total", _NO),
        _row("audit", "validation", "dataset", judged, "total", "valid", "rejected", "score"),
        _row("metric", "RecordsIngested", "dataset", none, _NO, _NO, _NO, "total"),
        _row("metric", "RecordsRejected", "dataset", none, _NO, _NO, _NO, "rejected"),
        _row("metric", "DataQualityScore", "dataset", none, _NO, _NO, _NO, "score"),
    ]
    one = "(SELECT 1)"
    if stopped:
        rows += [
            _row("audit", "validation", whole, "'FAILED'", _NO, _NO, _NO, error="TRUE", source=one),
            _row("audit", "pipeline", whole, "'FAILED'", "total", _NO, "rejected", error="TRUE", source=totals),
            _row("metric", "PipelineFailure", none, none, _NO, _NO, _NO, "1", source=one),
        ]
    else:
        written = f"(SELECT CAST(SUM(valid) AS BIGINT) FROM {loaded})"
        six, zero = "CAST(6 AS BIGINT)", "CAST(0 AS BIGINT)"
        rows += [
            _row("audit", "transformation", "dataset", ok, _NO, "valid", _NO, source=staged),
            _row("audit", "publish", "dataset", ok, _NO, "valid", _NO, source=staged),
            _row("audit", "warehouse_load", "dataset", ok, "valid", "valid", _NO, source=loaded),
            _row("audit", "post_load_checks", whole, ok, six, _NO, zero, source=one),
            _row("audit", "pipeline", whole, ok, "total", written, "rejected", source=totals),
            _row("metric", "RecordsProcessed", "dataset", none, _NO, _NO, _NO, "valid", source=staged),
            _row("metric", "PipelineSuccess", none, none, _NO, _NO, _NO, "1", source=one),
            _row("metric", "PipelineDurationSeconds", none, none, _NO, _NO, _NO, source=one),
        ]
    return sql(" UNION ALL ".join(rows), sizes=_sizes_sql(damage), sized=_SIZED)


_SENT = f"""
    SELECT 'orders' AS d, order_key AS k, order_date < DATE '{SPLIT}' AS early, order_key % 10 = 0 AS again,
           order_date, order_status FROM ord
    UNION ALL
    SELECT 'payments', 0, ord.order_date < DATE '{SPLIT}' AND payment_date < DATE '{SPLIT}', FALSE, NULL, NULL
    FROM pay JOIN ord USING (order_id)
    UNION ALL
    SELECT 'delivery', 0, ord.order_date < DATE '{SPLIT}' AND ord.order_key % 4 <> 0, FALSE, NULL, NULL
    FROM dlv JOIN ord USING (order_id)
    UNION ALL SELECT 'customers', c_custkey, TRUE, c_custkey % 5 = 0, NULL, NULL FROM customer
    UNION ALL SELECT 'restaurants', s_suppkey, TRUE, FALSE, NULL, NULL FROM supplier
    UNION ALL SELECT 'delivery_partners', p_partkey, TRUE, FALSE, NULL, NULL FROM part"""


def _incremental_sql() -> str:
    tables = {t.dataset: t.table for t in load.TARGETS}
    name = " ".join(f"WHEN '{d}' THEN '{t}'" for d, t in tables.items())
    steps = {
        "historical": ("COUNT(*) FILTER (WHERE early)", "0", "COUNT(*) FILTER (WHERE early)"),
        "incremental": (
            "COUNT(*) FILTER (WHERE NOT early OR again)",
            "COUNT(*) FILTER (WHERE early AND again)",
            "COUNT(*) FILTER (WHERE NOT early)",
        ),
        "late": (
            "COUNT(*) FILTER (WHERE early)",
            "COUNT(*) FILTER (WHERE early AND NOT again)",
            "0",
        ),
        "star": ("COUNT(*)", "COUNT(*) FILTER (WHERE early)", "COUNT(*)"),
    }
    rows = [
        f"""SELECT '{step}' AS step, CASE d {name} END AS object, CAST({read} AS BIGINT) AS rows,
            CAST({updated} AS BIGINT) AS updated, CAST({inserted} AS BIGINT) AS inserted
            FROM sent GROUP BY d"""
        for step, (read, updated, inserted) in steps.items()
    ]
    zero = "CAST(0 AS BIGINT)"
    for step, which in (("historical", "early"), ("incremental", "NOT early OR again"), ("late", "early")):
        rows.append(
            f"""SELECT '{step}', 'stg_daily_order_metrics', COUNT(DISTINCT order_date), {zero}, {zero}
                FROM sent WHERE d = 'orders' AND ({which})"""
        )
    for what, which in (
        ("moved customers", "d = 'customers' AND again"),
        ("cancelled orders", "d = 'orders' AND (order_status = 'CANCELLED' OR (early AND again))"),
        ("dated deliveries", "d = 'delivery'"),
    ):
        rows.append(f"SELECT 'star', '{what}', COUNT(*), {_NO}, {_NO} FROM sent WHERE {which}")
    return sql(" UNION ALL ".join(rows), "ord", "pay", "dlv", sent=_SENT)


def _headers_sql() -> str:
    kinds = {"agreed": 0, "other case": 1, "other order": 2, "no header": 3, "spanning lines": 4}
    zero = "CAST(0 AS BIGINT)"
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, CAST({2 if way == 4 else 1} * COUNT(*) AS BIGINT) AS lines,
            {"CAST(2 * COUNT(*) AS BIGINT)" if way == 4 else zero} AS open_lines, {zero} AS invalid_lines
            FROM customer WHERE c_nationkey % 5 = {way} HAVING COUNT(*) > 0"""
        for kind, way in kinds.items()
    )


def _counts_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, COUNT(*) AS records_read, COUNT(*) AS records_written,
            COUNT(*) AS row_numbers, COUNT(*) AS last_row,
            COUNT(*) FILTER (WHERE {"k % 3 = 0" if dataset in ("customers", "restaurants") else "FALSE"})
                AS spanning FROM ({base})"""
        for dataset, base in _BASES.items()
    )


def _damaged_sql() -> str:
    again = {
        "customers": "SELECT customer_id FROM ok_customers WHERE customer_id LIKE '%7'",
        "orders": "SELECT order_id FROM placed WHERE order_status = 'PLACED'",
        "payments": "SELECT payment_id FROM settled WHERE payment_method = 'UPI'",
    }
    rows = " UNION ALL ".join(
        f"""SELECT 'WQ-001' AS check_id, 'stg_{dataset}' AS object_name, COUNT(*) AS failed_count
            FROM ({again.get(dataset, "SELECT 1 WHERE FALSE")})"""
        for dataset in (*(t.dataset for t in load.TARGETS), load.STAGED_ONLY)
    )
    return over_typed(f"SELECT * FROM ({USABLE} {rows})")


def _failure_sql() -> str:
    """Every drop is read side by side, so only orders fail."""
    sizes = " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, COUNT(*) AS n FROM ({base})"
        for dataset, base in _BASES.items()
        if dataset != "orders"
    )
    wrong = "header is not the agreed one "
    return f"""WITH sizes AS ({sizes})
        SELECT 'ingestion' AS stage, dataset, 'SUCCESS' AS status, n AS records_in, n AS records_out,
               CAST(NULL AS VARCHAR) AS error FROM sizes
        UNION ALL SELECT 'ingestion', 'orders', 'FAILED', {_NO}, {_NO}, 'SourceMalformed: {wrong}'
        UNION ALL SELECT 'pipeline', '{WHOLE_RUN}', 'FAILED', CAST(SUM(n) AS BIGINT), {_NO},
                         'ingestion: {wrong}' FROM sizes"""


SQL = {
    "src_headers": _headers_sql(),
    "src_counts": _counts_sql(),
    "src_raw_csv": sql(
        f"""SELECT order_status, DATE '2001-12-31' AS _ingestion_date, without_id, COUNT(*) AS records,
                   MAX(k * 10 + n + 1) AS last_row
            FROM (SELECT k, 0 AS n, FALSE AS without_id, s AS order_status FROM base
                  UNION ALL SELECT k, n, n = 1, CASE WHEN n = 7 THEN 'lost' ELSE s END
                  FROM base, range(1, 9) AS numbers(n) WHERE k % {LIGHT} = n)
            GROUP BY order_status, without_id""",
        "ord",
        base="SELECT order_key AS k, order_status AS s FROM ord",
    ),
    "src_history_keys": """SELECT COUNT(*) AS keys,
        COUNT(*) + COUNT(*) FILTER (WHERE o_orderkey % 10 = 0) AS rows FROM orders""",
    "dq_every_rule": _every_rule_sql(),
    "chk_damaged_partitions": _damaged_sql(),
    "wh_unresolved_keys": over_typed(
        """SELECT 'fact_order' AS table_name, key_column, rows FROM (
               SELECT 'customer_key' AS key_column, COUNT(*) FILTER (WHERE NOT COALESCE(
                   customer_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer), FALSE)) AS rows
               FROM t_orders
               UNION ALL SELECT 'restaurant_key', COUNT(*) FILTER (WHERE NOT COALESCE(
                   restaurant_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier), FALSE))
               FROM t_orders
               UNION ALL SELECT 'order_date_key', COUNT(*) FILTER (WHERE order_timestamp IS NULL) FROM t_orders)
           WHERE rows > 0"""
    ),
    "vw_by_name": sql(
        "SELECT order_date, COUNT(*) AS total_orders, COUNT(*) AS reported FROM ord GROUP BY order_date",
        "ord",
    ),
    "run_gate_passed": _gated_sql(
        {name: LIGHT for name in ("customers", "orders", "payments", "delivery")}, stopped=False
    ),
    "run_gate_stopped": _gated_sql({"payments": HEAVY}, stopped=True),
    "run_failed_header": _failure_sql(),
    "run_incremental": _incremental_sql(),
}
