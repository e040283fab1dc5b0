"""Truth tables of the rule kinds, the catalogue, evaluation and the gate."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ordermill.errors import QualityGateFailed
from ordermill.model import DATASETS, LINEAGE, SOURCE
from ordermill.quality import evaluate, report
from ordermill.quality.catalog import CATALOG, parents_of
from ordermill.quality.rules import Scope, WARN
from ordermill.registry.checking import QUERIES

RUN_DATE = date(2026, 9, 29)
RULES = {rule.rule_id: (name, rule) for name, rules in CATALOG.items() for rule in rules}


def raw(spark, dataset, rows):
    """Raw records from dicts of the columns that matter; others are blank but valid."""
    names = SOURCE[dataset].fieldNames()
    schema = ", ".join(f"{n} string" for n in names)
    values = [tuple(row.get(n) for n in names) + (i,) for i, row in enumerate(rows, 1)]
    df = spark.createDataFrame(values, f"{schema}, _source_row_number long")
    lineage = {
        f.name: F.lit(None).cast(f.dataType) for f in LINEAGE if f.name != "_source_row_number"
    }
    return df.withColumns(lineage)


def failures(spark, rule_id, rows, parents=None):
    """Which of ``rows`` break the rule, in order."""
    dataset, rule = RULES[rule_id]
    scope = Scope(SOURCE[dataset], RUN_DATE, parents or {})
    tagged = evaluate.tag(raw(spark, dataset, rows), dataset, scope, (rule,))
    got = tagged.orderBy("_source_row_number").select(evaluate.breaks(dataset, rule))
    return [r[0] for r in got.collect()]


def column(spark, rule_id, name, values):
    return failures(spark, rule_id, [{name: v} for v in values])


CASES = [
    ("DQ-ORD-001", "order_id", ["O1", None, " ", ""], [False, True, True, True]),
    ("DQ-ORD-002", "order_id", ["O1", "O2", "O1", None], [False, False, True, False]),
    ("DQ-ORD-002", "order_id", ["O1"] * 10, [False] + [True] * 9),
    (
        "DQ-ORD-007",
        "order_status",
        ["DELIVERED", "SHIPPED", None, "cancelled "],
        [False, True, True, False],
    ),
    (
        "DQ-ORD-006",
        "order_amount",
        ["456.50", "0", "-10.00", "abc", "NaN", None, "-0.004", "1e3"],
        [False, False, True, True, True, True, False, False],
    ),
    (
        "DQ-RES-003",
        "rating",
        ["4.3", "0", "5.0", None, "7.5", "-1", "5.04", "5.05", "x"],
        [False, False, False, False, True, True, False, True, True],
    ),
    (
        "DQ-CUS-004",
        "signup_date",
        ["2026-01-10", "2026-09-29", "2026-09-30", "2026-02-30", "not-a-date", "31/01/2026", None],
        [False, False, True, True, True, True, True],
    ),
    (
        "DQ-ORD-008",
        "order_date",
        ["2026-09-29 23:59:59", "2026-09-30 00:00:00", "2026-09-29", "2026-09-01 24:00:00"],
        [False, True, True, True],
    ),
    ("DQ-PAY-007", "payment_date", ["2027-01-01 00:00:00", None], [False, True]),
]


@pytest.mark.parametrize(("rule_id", "name", "values", "broken"), CASES)
def test_single_column_rules(spark, rule_id, name, values, broken):
    assert column(spark, rule_id, name, values) == broken


def test_pickup_not_after_delivery(spark):
    day = "2026-09-01 12:"
    pairs = [("00:00", "30:00"), ("30:00", "30:00"), ("30:00", "20:00")]
    rows = [{"pickup_time": day + p, "delivery_time": day + d} for p, d in pairs]
    rows += [{"pickup_time": day + "30:00"}, {"pickup_time": "bad", "delivery_time": day + "20:00"}]
    assert failures(spark, "DQ-DEL-005", rows) == [False, False, True, False, False]


def test_times_valid_when_given(spark):
    rows = [{}, {"pickup_time": "bad"}, {"delivery_time": "2026-09-01 10:00:00"},
            {"pickup_time": "2026-09-01 10:00:00", "delivery_time": "later"}]
    assert failures(spark, "DQ-DEL-007", rows) == [False, True, False, True]


def test_required_when(spark):
    rows = [
        {"delivery_status": "DELIVERED", "delivery_time": "2026-09-01 10:00:00"},
        {"delivery_status": "delivered"},
        {"delivery_status": "FAILED"},
        {},
    ]
    assert failures(spark, "DQ-DEL-008", rows) == [False, True, False, False]


def test_exists_in(spark):
    keys = spark.createDataFrame([("C1",), ("C2",)], "customer_id string")
    rows = [{"customer_id": c} for c in ("C1", " C2", "C3", None)]
    assert failures(spark, "DQ-ORD-004", rows, {"customers": keys}) == [False, False, True, True]
    assert failures(spark, "DQ-ORD-004", rows) == [True] * 4


def test_catalogue():
    assert len(RULES) == 34
    assert sorted(i for i, (_, r) in RULES.items() if r.severity == WARN) == ["DQ-CUS-005", "DQ-DEL-008"]
    assert parents_of("delivery") == ("delivery_partners", "orders")
    assert all(rule.column in SOURCE[name].fieldNames() for name, rule in RULES.values())


ORDER = {
    "order_id": "O1",
    "customer_id": "C1",
    "restaurant_id": "R1",
    "order_date": "2026-09-01 10:00:00",
    "order_amount": "10.00",
    "order_status": "delivered",
}
PAYMENT = {
    "payment_id": "P1",
    "order_id": "O1",
    "payment_method": "upi",
    "payment_amount": "10",
    "payment_status": "success",
    "payment_date": "2026-09-01 10:01:00",
}


def batch(spark):
    rows = {
        "customers": [
            {"customer_id": "C1", "city": "Pune", "signup_date": "2026-01-01", "email": "a@b.c"},
            {"customer_id": "C2", "city": " ", "signup_date": "2026-01-01"},
        ],
        "restaurants": [{"restaurant_id": "R1", "rating": "4.5"}],
        "delivery_partners": [{"delivery_partner_id": "DP1", "joining_date": "2020-01-01"}],
        "orders": [
            ORDER,
            ORDER | {"order_id": "O2", "order_amount": "-1"},
            ORDER | {"order_id": "O3", "customer_id": "C2"},
            ORDER | {"order_id": "O4", "customer_id": "C7"},
        ],
        "payments": [PAYMENT, PAYMENT | {"payment_id": "P2", "order_id": "O2"}],
        "delivery": [],
    }
    return {name: raw(spark, name, rows[name]) for name in DATASETS}


def test_held_back_parents_hold_back_children(spark):
    earlier = {"customers": spark.createDataFrame([("C7",)], "customer_id string")}
    tagged = evaluate.tag_all(batch(spark), RUN_DATE, earlier)

    def failed(dataset, key):
        rows = tagged[dataset].select(key, evaluate.broken_ids(dataset).alias("ids")).collect()
        return {r[key]: r["ids"].split(";") for r in rows if r["ids"]}

    assert failed("customers", "customer_id") == {"C2": ["DQ-CUS-003", "DQ-CUS-005"]}
    assert failed("orders", "order_id") == {"O2": ["DQ-ORD-006"], "O3": ["DQ-ORD-004"]}
    assert failed("payments", "payment_id") == {"P2": ["DQ-PAY-003"]}
    valid = evaluate.valid_records(tagged["orders"], "orders")
    assert sorted(r["order_id"] for r in valid.collect()) == ["O1", "O4"]
    assert dict(valid.dtypes)["order_amount"] == "decimal(10,2)"
    held = evaluate.quarantined_records(tagged["customers"], "customers", datetime(2026, 9, 29))
    row = held.first()
    assert row["_dq_failed_rules"] == "DQ-CUS-003;DQ-CUS-005"  # warnings are listed too
    assert row["signup_date"] == "2026-01-01"  # still text
    counts = evaluate.summary(tagged["orders"], "orders").first()
    assert (counts["total"], counts["valid"], counts["DQ-ORD-006"]) == (4, 2, 1)
    long = evaluate.rule_counts(evaluate.summary(tagged["orders"], "orders"), "orders")
    assert {r["rule_id"]: r["failed_records"] for r in long.collect()}["DQ-ORD-004"] == 1
    expected = spark.createDataFrame(
        [("DQ-ORD-006", 1), ("DQ-ORD-008", 2)], "rule_id string, expected_records long"
    )
    found = {r["rule_id"]: r["found"] for r in report.reconcile(expected, long).collect()}
    assert found == {"DQ-ORD-006": True, "DQ-ORD-008": False}


def test_null_key_breaks_both_rules(spark):
    tagged = evaluate.tag_all(batch(spark) | {"orders": raw(spark, "orders", [ORDER | {"customer_id": None}])}, RUN_DATE)
    ids = tagged["orders"].select(evaluate.broken_ids("orders")).first()[0]
    assert ids == "DQ-ORD-003;DQ-ORD-004"


def test_first_copy_counts_even_when_it_is_held_back(spark):
    rows = [ORDER | {"order_amount": "-1"}, ORDER]
    tagged = evaluate.tag_all(batch(spark) | {"orders": raw(spark, "orders", rows)}, RUN_DATE)
    assert evaluate.valid_records(tagged["orders"], "orders").count() == 0


@pytest.mark.parametrize(
    ("valid", "total", "score"), [(99870, 100000, 99.87), (2, 3, 66.67), (0, 0, 100.0)]
)
def test_score(spark, valid, total, score):
    assert report.quality_score(valid, total) == score
    counts = spark.createDataFrame([(total, valid)], "total long, valid long")
    assert float(report.scores({"orders": counts}).first()["quality_score"]) == score


def make_report(valid, total):
    counts = {"total": total, "valid": valid} | {r.rule_id: 0 for r in CATALOG["orders"]}
    return report.build_report("orders", counts, "r", RUN_DATE, datetime(2026, 9, 29))


def test_gate():
    report.enforce_gate([make_report(9500, 10000)])
    with pytest.raises(QualityGateFailed, match="94.99%"):
        report.enforce_gate([make_report(9500, 10000), make_report(9499, 10000)])
    assert make_report(0, 0)["status"] == "NO_DATA"
    assert make_report(1, 2)["status"] == "FAILED"


def test_cascade_looks_at_each_rule_once(spark, capsys):
    """Spark puts the rules in the place of the column that holds their bits; no filter names it for each rule."""
    found = QUERIES["dq_cascade"](spark, "/root/testdata/sf0.001")
    found.explain()
    filters = [line for line in capsys.readouterr().out.splitlines() if "Filter" in line]
    assert max(line.count("CASH") for line in filters) == 1
    rows = [{"payment_id": "p1", "order_id": "o1"}, {"payment_id": "p2", "order_id": "o2", "payment_amount": "-1"}]
    _, rule = RULES["DQ-PAY-003"]
    fine = {"payment_amount": "1", "payment_status": "SUCCESS", "payment_method": "UPI", "payment_date": "2026-09-01 00:00:00"}
    known = {"orders": spark.createDataFrame([("o3",)], "order_id string")}
    scope = Scope(SOURCE["payments"], RUN_DATE, known)
    rows.append({"payment_id": "p3", "order_id": "o3"})
    tagged = evaluate.tag(raw(spark, "payments", [fine | row for row in rows]), "payments", scope)
    only = tagged.where(evaluate.breaks_only("payments", rule)).select("payment_id").collect()
    by_ids = tagged.where(evaluate.broken_ids("payments") == "DQ-PAY-003").select("payment_id").collect()
    assert only == by_ids == [("p1",)]


def kept_in(spark, folder, plans=None):
    """Writes frames under their names and notes how Spark means to make them."""

    def keep(name, df):
        if plans is not None:
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return keep


PAID = {"payment_amount": "1", "payment_status": "SUCCESS", "payment_method": "UPI", "payment_date": "2026-09-01 00:00:00"}


@pytest.mark.parametrize("copies", [1, 4])
@pytest.mark.parametrize("unknown", [1, 9])
@pytest.mark.parametrize("long_list", [0, 1000])
def test_records_by_written_keys_are_tagged_as_without_writing(spark, tmp_path, monkeypatch, copies, unknown, long_list):
    """Whether keys repeat seldom or often, parents lack seldom or mostly, and lists are short or long."""
    monkeypatch.setattr(evaluate, "LONG_LIST", long_list, raising=False)
    rows = [
        PAID | {"payment_id": f"p{n}", "order_id": f" o{n % 10} " if n % 7 else None}
        for n in range(30)
        for _ in range(copies)
    ]
    rows += [PAID | {"payment_id": key, "order_id": "o9"} for key in (None, " ", "p3", " p3", "p29")]
    orders = spark.createDataFrame([(f"o{n}",) for n in range(unknown, 12)], "order_id string")
    records = raw(spark, "payments", rows)
    scope = evaluate.scope_for("payments", records, RUN_DATE, {"orders": orders}, {})
    plain = evaluate.tag(records, "payments", scope)
    kept = evaluate.tag(records, "payments", scope, keep=kept_in(spark, tmp_path))
    assert sorted(kept.columns) == sorted(plain.columns)
    found = sorted(kept.select("_source_row_number", evaluate.BROKEN).collect())
    assert found == sorted(plain.select("_source_row_number", evaluate.BROKEN).collect())
    assert len(found) == len(rows) and len({bits for _, bits in found}) > 3


def test_many_records_of_few_unknown_keys_stay_in_place(spark, tmp_path, monkeypatch):
    """The list of unknown keys is broadcast, however many records have them; no positions are written."""
    rows = [{"order_id": f"o{n}", "customer_id": "nobody", "restaurant_id": "r1"} for n in range(3000)]
    parents = {
        "customers": spark.createDataFrame([("c1",)], "customer_id string"),
        "restaurants": spark.createDataFrame([("r1",)], "restaurant_id string"),
    }
    path = f"{tmp_path}/raw"
    raw(spark, "orders", rows).write.parquet(path)
    records, plans = spark.read.parquet(path), {}
    scope = evaluate.scope_for("orders", records, RUN_DATE, parents, {})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    try:
        tagged = evaluate.tag(records, "orders", scope, keep=kept_in(spark, f"{tmp_path}/kept", plans))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rule = RULES["DQ-ORD-004"][1]
    assert tagged.where(evaluate.breaks("orders", rule)).count() == len(rows)
    assert "orders_positions" not in plans
    assert "BroadcastHashJoin" in plans["orders_tagged"] and "hashpartitioning" not in plans["orders_tagged"]


def test_known_keys_are_listed_where_most_are_unknown(spark, tmp_path):
    """The shorter of the two lists is written, and the keys of the records are not looked up for it."""
    rows = [PAID | {"payment_id": f"p{n}", "order_id": f"o{n}"} for n in range(40)]
    rows.append(PAID | {"payment_id": "p40", "order_id": None})
    rule, plans, found = RULES["DQ-PAY-003"][1], {}, {}
    for known in (3, 37):
        orders = spark.createDataFrame([(f"o{n}",) for n in range(known)] * 2 + [(None,)], "order_id string")
        records = raw(spark, "payments", rows)
        scope = evaluate.scope_for("payments", records, RUN_DATE, {"orders": orders}, {})
        keep = kept_in(spark, f"{tmp_path}/{known}", plans)
        tagged = evaluate.tag(records, "payments", scope, keep=keep)
        assert tagged.where(~evaluate.breaks("payments", rule)).count() == known
        assert tagged.count() == len(rows)
        found[known] = spark.read.parquet(f"{tmp_path}/{known}/keys_DQ-PAY-003").count()
    assert found == {3: 3, 37: 3}


@pytest.mark.parametrize("max_blocks", [0, 8192])
@pytest.mark.parametrize("unknown", [1, 9])
@pytest.mark.parametrize("copies", [1, 4])
def test_records_of_files_are_marked_where_they_lie(spark, tmp_path, monkeypatch, copies, unknown, max_blocks):
    """Long lists lead to bitmaps over the records' files; the records stay in their places and are tagged alike."""
    monkeypatch.setattr(evaluate, "LONG_LIST", 0)
    monkeypatch.setattr("ordermill.operators.places.MAX_BLOCKS", max_blocks)
    # few rows a block, so that files have several and words are at their ends
    monkeypatch.setattr("ordermill.operators.places.BLOCK_BITS", 7)
    monkeypatch.setattr("ordermill.operators.places.WORDS", 2)
    rows = [
        PAID | {"payment_id": f"p{n}", "order_id": f" o{n % 10} " if n % 7 else None}
        for n in range(500)
        for _ in range(copies)
    ]
    rows += [PAID | {"payment_id": key, "order_id": "o9"} for key in (None, " ", "p3", " p3", "p29")]
    orders = spark.createDataFrame([(f"o{n}",) for n in range(unknown, 12)], "order_id string")
    raw(spark, "payments", rows).repartition(3).write.parquet(f"{tmp_path}/raw")
    records, plans = spark.read.parquet(f"{tmp_path}/raw"), {}
    scope = evaluate.scope_for("payments", records, RUN_DATE, {"orders": orders}, {})
    plain = evaluate.tag(records, "payments", scope)
    kept = evaluate.tag(records, "payments", scope, keep=kept_in(spark, tmp_path, plans))
    assert kept.columns == plain.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    assert kept.count() == len(rows)
    if max_blocks:
        assert "hashpartitioning" not in plans["payments_tagged"]
