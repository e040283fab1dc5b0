"""Conformed datasets and batch metrics."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from ordermill.errors import OrphanRecords
from ordermill.model import CONFORMED, LINEAGE, SOURCE, struct
from ordermill.plans import conform, metrics
from conftest import plain
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = date(2026, 9, 1)


def validated(spark, dataset, rows):
    names = SOURCE[dataset].fieldNames()
    schema = T.StructType(SOURCE[dataset].fields + LINEAGE.fields)
    values = [
        tuple(row.get(n) for n in names) + (datetime(2026, 9, 1, 6), DAY, "f", i, "raw-run")
        for i, row in enumerate(rows, 1)
    ]
    return spark.createDataFrame(values, schema)


def at(hour, minute=0, second=0):
    return datetime(2026, 9, 1, hour, minute, second)


ORDERS = [
    {"order_id": "O1", "customer_id": "C1", "restaurant_id": "R1", "order_date": at(12, 30),
     "order_amount": Decimal("125.55"), "order_status": "DELIVERED"},
    {"order_id": "O2", "customer_id": "C1", "restaurant_id": "R1", "order_date": at(13),
     "order_amount": Decimal("150.00"), "order_status": "DELIVERED"},
    {"order_id": "O3", "customer_id": "C2", "restaurant_id": "R1", "order_date": at(14),
     "order_amount": Decimal("100.00"), "order_status": "PLACED"},
    {"order_id": "O4", "customer_id": "C2", "restaurant_id": "R1", "order_date": at(15),
     "order_amount": Decimal("80.00"), "order_status": "CANCELLED"},
]


def pay(number, order, amount, status, hour=16):
    return {"payment_id": f"P{number}", "order_id": order, "payment_method": "UPI",
            "payment_amount": Decimal(amount), "payment_status": status, "payment_date": at(hour)}


PAYMENTS = [
    pay(1, "O1", "125.55", "SUCCESS"),
    pay(2, "O2", "150.00", "FAILED", 14),
    pay(3, "O2", "150.00", "SUCCESS", 13),
    pay(4, "O3", "100.00", "SUCCESS"),
    pay(5, "O4", "80.00", "FAILED", 15),
    pay(6, "O4", "80.00", "REFUNDED", 16),
]
DELIVERY = [
    {"delivery_id": "D1", "order_id": "O1", "delivery_partner_id": "DP1", "pickup_time": at(13),
     "delivery_time": at(13, 45, 1), "delivery_status": "DELIVERED"},
    {"delivery_id": "D2", "order_id": "O2", "delivery_partner_id": "DP1", "pickup_time": at(13),
     "delivery_time": at(13, 45), "delivery_status": "DELIVERED"},
    {"delivery_id": "D3", "order_id": "O2", "delivery_partner_id": "DP1",
     "delivery_status": "ASSIGNED"},
]


@pytest.fixture
def batch(spark):
    people = [{"customer_id": c, "city": "Pune", "signup_date": DAY} for c in ("C1", "C2")]
    return {
        "customers": validated(spark, "customers", people),
        "restaurants": validated(
            spark, "restaurants",
            [{"restaurant_id": "R1", "city": "Delhi", "cuisine": "Thai", "rating": Decimal("4.5")}],
        ),
        "delivery_partners": validated(spark, "delivery_partners", [{"delivery_partner_id": "DP1"}]),
        "orders": validated(spark, "orders", ORDERS),
        "payments": validated(spark, "payments", PAYMENTS),
        "delivery": validated(spark, "delivery", DELIVERY),
    }


def test_all_datasets_have_their_schemas(batch):
    made = conform.process(batch, {}, "run")
    assert list(made) == list(CONFORMED)
    for name, df in made.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in CONFORMED[name]
        ]
        assert {r["_run_id"] for r in df.select("_run_id").collect()} == {"run"}


def test_order_analytics(batch):
    rows = {r["order_id"]: r for r in conform.process(batch, {}, "run")["order_analytics"].collect()}
    assert len(rows) == 4
    one, two, four = rows["O1"], rows["O2"], rows["O4"]
    assert (one["order_hour"], one["customer_city"], one["restaurant_city"], one["cuisine"]) == (
        12, "Pune", "Delhi", "Thai",
    )
    assert (one["delivery_duration_minutes"], one["is_late"]) == (Decimal("45.02"), True)
    assert (two["payment_status"], two["paid_amount"]) == ("SUCCESS", Decimal("150.00"))
    assert (two["delivery_status"], two["is_late"]) == ("DELIVERED", False)  # 45.00 is not late
    assert (four["payment_status"], four["paid_amount"]) == ("REFUNDED", Decimal("0.00"))
    assert (four["delivery_status"], four["is_late"]) == (None, None)


def test_daily_metrics(batch):
    made = conform.process(batch, {}, "run")
    assert plain(made["daily_order_metrics"]) == [(DAY, 4, 3, 375.55, 125.18, 1, 25.0, DAY, "run")]
    only = made["order_analytics"].where("order_id = 'O4'")
    assert plain(metrics.daily_order_metrics(only, "run"))[0][1:7] == (1, 0, 0.0, None, 1, 100.0)


def test_delivery_takes_the_date_of_earlier_orders(spark, batch):
    earlier = spark.createDataFrame(
        [("O0", "C1", "R1", at(1), date(2026, 8, 30), Decimal(1), "PLACED", date(2026, 8, 30), "r0")],
        CONFORMED["orders"],
    )
    batch["delivery"] = validated(spark, "delivery", [DELIVERY[0] | {"order_id": "O0"}])
    made = conform.process(batch, {"orders": earlier}, "run", check=True)
    assert made["delivery"].first()["order_date"] == date(2026, 8, 30)


def test_cities_come_from_the_current_dimension(spark, batch):
    earlier = spark.createDataFrame(
        [("C2", "n", None, "Old", DAY, date(2026, 8, 30), "r0"),
         ("C3", "n", None, "Goa", DAY, date(2026, 8, 30), "r0")],
        CONFORMED["customers"],
    )
    batch["orders"] = validated(spark, "orders", [ORDERS[2], ORDERS[3] | {"customer_id": "C3"}])
    made = conform.process(batch, {"customers": earlier}, "run")
    cities = {r["order_id"]: r["customer_city"] for r in made["order_analytics"].collect()}
    assert cities == {"O3": "Pune", "O4": "Goa"}


def test_orphans_stop_the_batch(spark, batch):
    batch["payments"] = validated(spark, "payments", [*PAYMENTS, pay(9, "O9", "1", "SUCCESS"), pay(10, None, "1", "SUCCESS")])
    with pytest.raises(OrphanRecords) as caught:
        conform.process(batch, {}, "run", check=True)
    assert caught.value.context["orphan_count"] == 2
    assert "O9" in caught.value.context["sample_keys"]


def test_all_orphan_keys_are_reported(spark, batch):
    batch["payments"] = validated(spark, "payments", [*PAYMENTS, *(pay(20 + i // 2, f"O{20 + i}", "1", "SUCCESS") for i in range(0, 18, 2)), pay(40, "O20", "1", "SUCCESS")])
    reported = {}
    with pytest.raises(OrphanRecords):
        conform.process(batch, {}, "run", check=True, report=lambda name, column, keys: reported.update({(name, column): keys.collect()}))
    assert list(reported) == [("payments", "order_id")]
    keys = {r["key"]: r["records"] for r in reported["payments", "order_id"]}
    assert keys == {f"O{20 + i}": 1 + (i == 0) for i in range(0, 18, 2)}


def test_rating_is_rounded_half_up(spark):
    schema = struct(
        "restaurant_id string, restaurant_name string, city string, cuisine string,"
        " rating decimal(4,2)"
    )
    rows = spark.createDataFrame([("R1", "a", "b", "c", Decimal("4.25"))], schema).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in LINEAGE}
    )
    assert conform.conformed("restaurants", rows, "run").first()["rating"] == Decimal("4.3")
