"""Whole runs: historical, daily, late rerun, and runs that must fail."""

import re
import time
from datetime import date, timedelta

import drops
import pytest
from pyspark.sql import functions as F

from ordermill.errors import LoadRefused, QualityGateFailed, RunError, SourceMalformed
from ordermill.model import CONFORMED, DATASETS, SOURCE, STAR
from ordermill.plans import audit, checks, daily_run, load, reports, views
from ordermill.plans.daily_run import Run
from ordermill.session import let_go
from ordermill.sources import layout, trade_drops
from ordermill.sources.lake import Lake
from ordermill.sources.star import Star
from ordermill.sources.warehouse import Warehouse
from ordermill.sources import warehouse as warehouses

HISTORICAL, DAY1, DAY2 = drops.HISTORICAL, drops.DAY1, drops.DAY2


def make(spark, root, day, load_type="incremental", run_id=None):
    return Run(
        Lake(spark, f"{root}/lake"),
        Warehouse(spark, f"{root}/star"),
        f"{root}/drops",
        day,
        load_type,
        run_id or f"run-{day}",
        min_score=60.0,
    )


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Historical and first daily run."""
    root = tmp_path_factory.mktemp("runs")
    drops.write_all(root / "drops")
    first = make(spark, root, HISTORICAL, "historical")
    daily_run.run_all(first)
    business = {t: business_rows(first.warehouse, t) for t in STAR}
    second = make(spark, root, DAY1)
    daily_run.run_all(second)
    return root, first, second, business


def business_rows(warehouse, table):
    df = warehouse.read(table)
    return sorted(map(repr, df.drop("updated_at", "created_at").collect()))


def test_counts_of_the_historical_run(ran):
    _, first, _, _ = ran
    assert {r["dataset"]: r["records_written"] for r in first.results["ingestion"]} == {
        "customers": 3, "restaurants": 2, "delivery_partners": 1,
        "orders": 33, "payments": 32, "delivery": 30,
    }
    failed = {
        r["dataset"]: {x["rule_id"]: x["failed_records"] for x in r["rule_results"] + r["warnings"]}
        for r in first.results["validation"]
    }
    assert failed == {
        "customers": {"DQ-CUS-003": 1, "DQ-CUS-005": 1},
        "restaurants": {},
        "delivery_partners": {},
        "orders": {"DQ-ORD-002": 1, "DQ-ORD-004": 1, "DQ-ORD-006": 1},
        "payments": {"DQ-PAY-003": 2},
        "delivery": {},
    }
    assert first.results["transformation"] == {
        "customers": 2, "restaurants": 2, "delivery_partners": 1, "orders": 30, "payments": 30,
        "delivery": 30, "order_analytics": 30, "daily_order_metrics": 3,
    }
    loaded = {r["table"]: (r["rows_updated"], r["rows_inserted"]) for r in first.results["warehouse_load"]}
    assert loaded["fact_order"] == (0, 30) and loaded["dim_customer"] == (0, 2)
    assert all(r["passed"] for r in first.results["post_load_checks"])


def test_valid_and_quarantined_add_up(ran):
    _, first, _, _ = ran
    for report in first.results["validation"]:
        name = report["dataset"]
        valid = first.lake.read(
            layout.partition("validated", name, HISTORICAL), daily_run.validated_schema(name)
        ).count()
        held = first.lake.spark.read.parquet(
            first.lake.uri(layout.partition("quarantine", name, HISTORICAL))
        )
        assert valid == report["valid_records"]
        assert held.count() == report["invalid_records"]
        assert first.lake.read_json(layout.quality_report(name, HISTORICAL)) == report
    orders = first.lake.spark.read.parquet(
        first.lake.uri(layout.partition("quarantine", "orders", HISTORICAL))
    )
    rows = {r["_source_row_number"]: r for r in orders.collect()}
    assert (rows[33]["order_amount"], rows[33]["_dq_failed_rules"]) == ("-5", "DQ-ORD-006")
    assert rows[32]["_dq_failed_rules"] == "DQ-ORD-002"


def test_daily_run_updates_in_place(ran):
    _, first, second, before = ran
    loaded = {
        r["table"]: (r["status"], r["rows_updated"], r["rows_inserted"])
        for r in second.results["warehouse_load"]
    }
    assert loaded["dim_customer"] == ("SUCCESS", 1, 1)
    assert loaded["dim_restaurant"] == ("NO_DATA", 0, 0)
    assert loaded["fact_order"] == ("SUCCESS", 1, 5)
    customers = {r["customer_id"]: r for r in second.warehouse.read("dim_customer").collect()}
    assert customers["C1"]["city"] == "Mumbai"
    assert customers["C1"]["created_at"] < customers["C1"]["updated_at"]
    assert sorted(r["customer_key"] for r in customers.values()) == [1, 2, 3]
    orders = {r["order_id"]: r for r in second.warehouse.read("fact_order").collect()}
    assert orders["O2"]["order_status"] == "CANCELLED" and len(orders) == 35
    assert sorted(r["order_key"] for r in orders.values()) == list(range(1, 36))


def test_only_touched_months_are_rewritten(ran):
    _, _, second, _ = ran
    parts = second.warehouse.record("fact_order")["parts"]
    assert set(parts) == {"202607", "202608", "202609"}
    # order 2 was placed in July; August keeps its first version
    assert parts["202607"].startswith("v00000003") and parts["202609"].startswith("v00000003")
    assert parts["202608"].startswith("v00000002")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_looks_up_its_keys_in_their_buckets(spark, ran):
    _, _, second, _ = ran
    warehouse = second.warehouse
    keys = spark.createDataFrame([("O2",), ("O99",)], "order_id string")
    index = warehouse.key_index("fact_order", keys)
    found = {(r["key"], r["part"]) for r in index.join(keys.toDF("key"), "key", "left_semi").collect()}
    assert found == {("O2", "202607")}
    target = next(t for t in load.TARGETS if t.table == "fact_order")
    rows = warehouse.read("fact_order").limit(0)
    assert load.touched_parts(warehouse, target, keys, rows) == ["202607"]
    plan = plan_of(index)
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan)
    assert all("/_keys/bucket=" in file for file in index.inputFiles())  # nothing of the stored facts
    # every stored key is in the index, under the part that holds it
    everything = warehouse.read("fact_order").selectExpr("order_id AS key", "CAST(order_date_key div 100 AS STRING) AS part")
    listed = warehouse.key_index("fact_order", everything.select("key"))
    assert everything.join(listed, ["key", "part"], "left_anti").count() == 0


def test_key_index_is_rewritten_when_it_has_many_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouses, "KEY_FOLDERS", 2)
    house = Warehouse(spark, str(tmp_path / "star"), key_buckets=4)
    for n in range(4):
        entries = spark.createDataFrame([(f"O{n}", f"part{n}"), ("O0", f"part{n}")], "key string, part string")
        folders = house.add_keys("fact_order", entries, f"v{n}")
        house.commit("fact_order", {}, 0, after=n, keys=folders)
        assert len(folders) <= 2
    keys = spark.createDataFrame([("O0",)], "k string")
    listed = house.key_index("fact_order", keys).where("key = 'O0'")
    assert sorted(r["part"] for r in listed.distinct().collect()) == [f"part{n}" for n in range(4)]


def test_reconciliation_opens_the_batch_days_only(spark, ran):
    _, _, second, _ = ran
    days = spark.createDataFrame([(DAY1,)], "order_date date")
    star = second.warehouse.star(days)
    assert {r["order_date_key"] for r in star.fact_order.collect()} == {20260901}
    assert star.fact_order.inputFiles() and all("/_part=202609/" in f for f in star.fact_order.inputFiles())
    plan = plan_of(views.daily_revenue(checks.of_days(star, days)))
    assert plan.count("LeftSemi") >= 2
    assert views.daily_revenue(checks.of_days(second.warehouse.star(), days)).count() == 1


def test_audit_write_touches_one_part(spark, ran):
    root, _, second, _ = ran
    house = second.warehouse
    before = house.record("pipeline_run_audit")
    assert set(before["parts"]) == {str(HISTORICAL), str(DAY1)}
    rows = house.read("pipeline_run_audit", [str(DAY1)])
    audit.write_audit(house, rows)
    after = house.record("pipeline_run_audit")
    assert after["parts"][str(HISTORICAL)] == before["parts"][str(HISTORICAL)]
    assert after["parts"][str(DAY1)] != before["parts"][str(DAY1)]
    assert house.read("pipeline_run_audit", [str(DAY1)]).count() == rows.count()


def test_parts_can_be_days(spark, ran):
    root, first, _, before = ran
    daily = Warehouse(spark, f"{root}/star-by-day", period="day")
    results = load.load_warehouse(daily, first.lake, HISTORICAL)
    assert {r["table"]: r["rows_inserted"] for r in results}["fact_order"] == 30
    assert set(daily.record("fact_order")["parts"]) == {"20260715", "20260801", "20260802"}
    assert business_rows(daily, "fact_order") == before["fact_order"]
    again = load.load_warehouse(daily, first.lake, HISTORICAL)
    assert {r["table"]: r["rows_updated"] for r in again}["fact_order"] == 30
    assert business_rows(daily, "fact_order") == before["fact_order"]


def test_views_over_the_loaded_star(ran):
    _, _, second, _ = ran
    star = second.warehouse.star()
    total = views.daily_orders(star).agg(F.sum("total_orders")).first()[0]
    assert total == 35
    for name in reports.REPORTS:
        assert reports.run_report(name, star).count() > 0, name


def test_audit(ran):
    _, first, second, _ = ran
    table = second.warehouse.read("pipeline_run_audit")
    per_stage = {
        (r["run_id"], r["stage"]): r["n"]
        for r in table.groupBy("run_id", "stage").agg(F.count("*").alias("n")).collect()
    }
    for run in (first, second):
        assert {s: per_stage[run.run_id, s] for s in
                ("ingestion", "validation", "transformation", "publish", "warehouse_load",
                 "post_load_checks", "pipeline")} == {
            "ingestion": 6, "validation": 6, "transformation": 8, "publish": 8,
            "warehouse_load": 7, "post_load_checks": 1, "pipeline": 1,
        }
    total = table.where("stage = 'pipeline' AND run_id = 'run-2026-08-31'").first()
    assert (total["records_in"], total["records_out"], total["records_rejected"]) == (101, 98, 6)
    assert [r["run_id"] for r in audit.recent_runs(table).collect()] == ["run-2026-09-01", "run-2026-08-31"]
    assert audit.quality_trend(table).count() == 12
    assert audit.slowest_stages(table).count() == 6
    metrics = {(r["metric"], r["dataset"]): r["value"] for r in
               audit.stage_metrics(table.where("run_id = 'run-2026-09-01'")).collect()}
    assert metrics["RecordsIngested", "orders"] == 6
    assert ("DataQualityScore", "restaurants") not in metrics  # nothing was read
    assert metrics["PipelineSuccess", None] == 1


def test_rerun_and_late_rerun(spark, ran):
    root, _, second, _ = ran
    before = {t: business_rows(second.warehouse, t) for t in STAR}
    daily_run.run_all(make(spark, root, DAY1))
    again = {t: business_rows(second.warehouse, t) for t in STAR}
    assert again == before
    # an older batch changes nothing that a newer one has written
    older = make(spark, root, HISTORICAL, "historical", "run-late")
    daily_run.run_all(older)
    loaded = {r["table"]: (r["rows_updated"], r["rows_inserted"]) for r in older.results["warehouse_load"]}
    assert loaded["dim_customer"] == (1, 0)  # C2 only; C1 is newer
    assert loaded["fact_order"] == (29, 0)
    assert business_rows(second.warehouse, "fact_order") == before["fact_order"]


def test_failed_load_leaves_the_table(spark, ran):
    root, _, second, _ = ran
    warehouse, lake = second.warehouse, second.lake
    before = warehouse.record("fact_payment")
    target = next(t for t in load.TARGETS if t.table == "fact_order")
    broken = Star(lambda name: warehouse.read(name).limit(0) if name == "dim_customer" else warehouse.read(name))
    original = Warehouse.star
    Warehouse.star = lambda self: broken
    try:
        version = warehouse.version("fact_order")
        with pytest.raises(LoadRefused, match="customer_key"):
            load.load_table(warehouse, lake, target, DAY1, audit.now() + timedelta(days=1))
    finally:
        Warehouse.star = original
    assert warehouse.version("fact_order") == version
    assert warehouse.record("fact_payment") == before
    with pytest.raises(LoadRefused, match="not published"):
        load.load_table(warehouse, lake, target, date(2030, 1, 1), audit.now())


def corrupted(star, table, df):
    return Star(lambda name: df if name == table else getattr(star, name))


def failed_objects(df):
    return {r["object_name"] for r in df.where("failed_count > 0").collect()}


def test_checks_notice_corruption(spark, ran):
    _, _, second, _ = ran
    star = second.warehouse.star()
    for check in checks.STAR_CHECKS:
        assert failed_objects(check(star)) == set()
    orders, payments = star.fact_order, star.fact_payment
    twice = orders.unionByName(orders.where("order_id = 'O1'"))
    assert failed_objects(checks.key_uniqueness(corrupted(star, "fact_order", twice))) == {"fact_order"}
    lost = orders.withColumn("customer_key", F.expr("nullif(customer_key, 1)"))
    assert failed_objects(checks.fact_keys(corrupted(star, "fact_order", lost))) == {"fact_order.customer_key"}
    fewer = orders.where("order_id <> 'O41'")
    assert failed_objects(checks.facts_without_order(corrupted(star, "fact_order", fewer))) == {
        "fact_payment.order_id", "fact_delivery.order_id",
    }
    negative = payments.withColumn("payment_amount", -F.col("payment_amount"))
    assert failed_objects(checks.negative_amounts(corrupted(star, "fact_payment", negative))) == {
        "fact_payment.payment_amount"
    }
    metrics = second.lake.read_partition(
        "processed", "daily_order_metrics", DAY1, CONFORMED["daily_order_metrics"]
    )
    off = metrics.withColumn("average_order_value", F.expr("CAST(average_order_value + 5 AS DECIMAL(10,2))"))
    assert failed_objects(checks.aov_reconciliation(star, off)) == {
        "daily_order_metrics.average_order_value"
    }
    with pytest.raises(QualityGateFailed, match="WQ-002"):
        checks.run_checks(corrupted(star, "fact_order", twice), second.lake, DAY1)


def test_broken_header_fails_the_run_and_is_audited(spark, tmp_path):
    drops.write_all(tmp_path / "drops")
    drops.write(tmp_path / "drops", "orders", "historical", [], ["order_id", "nope"])
    run = make(spark, tmp_path, HISTORICAL, "historical")
    with pytest.raises(SourceMalformed):
        daily_run.run_all(run)
    rows = run.warehouse.read("pipeline_run_audit").collect()
    status = {(r["stage"], r["dataset"]): r["status"] for r in rows}
    assert status["ingestion", "orders"] == "FAILED"
    assert status["pipeline", "_pipeline"] == "FAILED"
    with pytest.raises(RunError, match="ingestion/orders"):
        daily_run.summarise(run)


def test_gate_stops_after_outputs_are_written(spark, tmp_path):
    drops.write_all(tmp_path / "drops")
    run = make(spark, tmp_path, HISTORICAL, "historical")
    run.min_score = 95.0
    daily_run.ingest_drops(run)
    with pytest.raises(QualityGateFailed, match="customers=66.67%"):
        daily_run.validate(run)
    for name in DATASETS:
        assert run.lake.exists(layout.partition("validated", name, HISTORICAL))
        assert run.lake.read_json(layout.quality_report(name, HISTORICAL))["dataset"] == name


def test_two_drops_are_made_of_one_reading(spark, tmp_path):
    """Every record comes with one of the drops, undecided ones with none; a drop without records has its header."""
    columns = SOURCE["customers"].fieldNames()
    rows = [tuple(f"{name} {n}, {n}" for name in columns) + (early,) for n, early in enumerate([True, False, None, True])]
    records = spark.createDataFrame(rows, [*columns, "early"])
    kinds = ((HISTORICAL, "historical"), (DAY1, "incremental"))
    wanted = {"some": ([0, 3], [1]), "all": ([0, 1, 2, 3], [])}
    for name, first in (("some", F.col("early")), ("all", F.lit(True))):
        trade_drops.write_two_drops(records, first, f"{tmp_path}/{name}", "customers", kinds)
        for (day, kind), numbers in zip(kinds, wanted[name], strict=True):
            path = f"{tmp_path}/{name}/{layout.drop('customers', kind, day)}"
            read = spark.read.csv(path, header=True, escape='"')
            assert read.columns == columns
            assert sorted(map(tuple, read.collect())) == [rows[n][:-1] for n in numbers]
        assert not (tmp_path / name / "_split").joinpath("customers").exists()


def test_shuffled_rows_are_let_go(spark):
    """Files of plans that nobody can read any more are removed, not kept until the driver happens to collect them."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark.range(1000).groupBy(F.col("id") % 7).count().collect()
    assert blocks.getAllFiles().size() > 0
    for _ in range(40):
        let_go(spark)
        left = [blocks.getAllFiles().apply(n).getName() for n in range(blocks.getAllFiles().size())]
        if not any(name.startswith("shuffle_") for name in left):
            break
        time.sleep(0.25)
    else:
        raise AssertionError(left)


def test_touched_parts_do_not_look_dimensions_up(spark, ran, monkeypatch):
    """Which parts a batch touches depends on its days and keys; dimensions are read for the rows only."""
    _, first, _, _ = ran
    house, seen = first.warehouse, []
    plain = load.touched_parts

    def touched(warehouse, target, keys, rows):
        seen.append((target.table, rows.columns))
        return plain(warehouse, target, keys, rows)

    monkeypatch.setattr(load, "touched_parts", touched)
    again = Warehouse(spark, f"{house.files.root}-again")
    load.load_warehouse(again, first.lake, HISTORICAL)
    assert len(seen) == 3 and all(len(columns) == 3 for _, columns in seen)
    assert sorted(r["order_key"] for r in again.read("fact_order").collect()) == list(range(1, 31))
