"""One small session for all tests, and the nine-order star schema."""

from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ordermill.model import STAR  # noqa: E402
from ordermill.session import build_session  # noqa: E402
from ordermill.sources.star import Star  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ordermill tests",
        "local[4]",
        spark__sql__shuffle__partitions=2,
        spark__sql__codegen__wholeStage="false",
        spark__driver__memory="3g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BATCH_DAY = date(2026, 9, 3)
STAMP = datetime(2026, 9, 3, 6)
_STAMPS = (BATCH_DAY, STAMP, STAMP)

# order: customer, restaurant, time, status
ORDERS = {
    1: (1, 1, "09-01 12:30", "DELIVERED"),
    2: (1, 2, "09-01 13:15", "DELIVERED"),
    3: (2, 1, "09-01 20:00", "CANCELLED"),
    4: (2, 2, "09-01 20:45", "DELIVERED"),
    5: (3, 1, "09-02 12:10", "DELIVERED"),
    6: (1, 3, "09-02 19:30", "DELIVERED"),
    7: (3, 2, "09-02 20:20", "CANCELLED"),
    8: (2, 1, "09-02 21:00", "PREPARING"),
    9: (4, 3, "09-02 13:40", "DELIVERED"),
}
# order, method, amount, status, day paid when it differs from the order's
PAYMENTS = (
    (1, "UPI", 500, "SUCCESS", None),
    (2, "CARD", 300, "FAILED", None),
    (2, "UPI", 300, "SUCCESS", None),
    (3, "CARD", 200, "REFUNDED", None),
    (4, "WALLET", 400, "SUCCESS", None),
    (5, "CASH", 250, "SUCCESS", None),
    (6, "CARD", 650, "SUCCESS", None),
    (7, "UPI", 150, "FAILED", None),
    (8, "UPI", 350, "SUCCESS", "09-03"),
    (9, "CARD", 100, "SUCCESS", None),
)
# order: minutes when delivered, else the status
DELIVERIES = {1: 30, 2: 50, 3: "FAILED", 4: 45, 5: 40, 6: 55, 8: "ASSIGNED", 9: 25}


def moment(text: str) -> datetime:
    return datetime.strptime(f"2026-{text}", "%Y-%m-%d %H:%M")


def day_key(when) -> int:
    return int(when.strftime("%Y%m%d"))


def nine_orders(spark) -> Star:
    from datetime import timedelta

    from pyspark.sql import functions as F

    from ordermill.operators.calendar import calendar

    def table(name, rows):
        return spark.createDataFrame(rows, STAR[name])

    placed = {o: moment(row[2]) for o, row in ORDERS.items()}
    payments = []
    for number, (order, method, amount, status, day) in enumerate(PAYMENTS, 1):
        paid = moment(f"{day} 10:00") if day else placed[order]
        payments.append(
            (number, f"P{number}", f"O{order}", method, Decimal(amount), status, day_key(paid), paid)
            + _STAMPS
        )
    deliveries = []
    for order, result in DELIVERIES.items():
        pickup = arrival = minutes = None
        if isinstance(result, int):
            pickup, minutes = placed[order], Decimal(result)
            arrival = pickup + timedelta(minutes=result)
        status = "DELIVERED" if pickup else result
        deliveries.append(
            (order, f"D{order}", f"O{order}", 1, day_key(placed[order]), pickup, arrival, minutes, status)
            + _STAMPS
        )
    bounds = spark.range(1).select(
        F.lit("2026-08-01").cast("date").alias("start"), F.lit("2026-09-30").cast("date").alias("end")
    )
    tables = {
        "dim_customer": table(
            "dim_customer",
            [(k, f"C{k}", f"Name {k}", None, "Pune", date(2026, 1, k)) + _STAMPS for k in range(1, 6)],
        ),
        "dim_restaurant": table(
            "dim_restaurant",
            [
                (k, f"R{k}", f"Rest {k}", city, cuisine, Decimal(rating)) + _STAMPS
                for k, city, cuisine, rating in (
                    (1, "Pune", "Indian", "4.5"),
                    (2, "Mumbai", "Chinese", "4.0"),
                    (3, "Pune", "Italian", "3.5"),
                    (4, "Delhi", "Desserts", "4.8"),
                )
            ],
        ),
        "dim_delivery_partner": table(
            "dim_delivery_partner", [(1, "DP1", "Partner", "Pune", date(2026, 1, 1)) + _STAMPS]
        ),
        "dim_date": calendar(bounds),
        "fact_order": table(
            "fact_order",
            [
                (o, f"O{o}", c, r, day_key(placed[o]), placed[o], Decimal(100), status) + _STAMPS
                for o, (c, r, _, status) in ORDERS.items()
            ],
        ),
        "fact_payment": table("fact_payment", payments),
        "fact_delivery": table("fact_delivery", deliveries),
    }
    return Star(tables.__getitem__)


@pytest.fixture(scope="session")
def star(spark):
    return nine_orders(spark)


def plain(df) -> list[tuple]:
    """Rows as tuples, decimals as floats."""
    return [
        tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()
    ]
