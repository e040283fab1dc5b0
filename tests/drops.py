"""Small dated CSV drops: a historical one and two daily ones, with known defects."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

from ordermill.model import SOURCE

HISTORICAL, DAY1, DAY2 = date(2026, 8, 31), date(2026, 9, 1), date(2026, 9, 2)


def write(root: Path, dataset: str, label: str, rows, header=None) -> Path:
    path = root / dataset / f"{dataset}_{label}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, lineterminator="\n")
        writer.writerow(header or SOURCE[dataset].fieldNames())
        writer.writerows(rows)
    return path


def order(number, day, customer="C1", restaurant="R1", status="DELIVERED", amount="100.00"):
    return (f"O{number}", customer, restaurant, f"{day} 12:{number % 60:02d}:00", amount, status)


def payment(number, day, status="SUCCESS", amount="100.00"):
    return (f"P{number}", f"O{number}", "UPI", amount, status, f"{day} 13:00:00")


def delivery(number, day, minutes=30, status="DELIVERED"):
    start = number % 60
    end = start + minutes
    return (
        f"D{number}",
        f"O{number}",
        "DP1",
        f"{day} 12:{start:02d}:00",
        f"{day} {12 + end // 60}:{end % 60:02d}:00",
        status,
    )


def write_all(root: Path) -> None:
    past = ["2026-08-01", "2026-08-02", "2026-07-15"]
    write(root, "customers", "historical", [
        ("C1", "Asha, A.", "asha@example.com", "Pune", "2026-01-01"),
        ("C2", " Bo ", "", "Delhi", "2026-02-01"),
        ("C3", "Chad", "c@example.com", "", "2026-02-01"),
    ])
    write(root, "restaurants", "historical", [
        ("R1", "Spice", "Pune", "Indian", "4.25"), ("R2", "Wok", "Delhi", "Chinese", ""),
    ])
    write(root, "delivery_partners", "historical", [("DP1", "Dev", "Pune", "2025-05-05")])
    good = [order(n, past[n % 3], f"C{1 + n % 2}", f"R{1 + n % 2}") for n in range(1, 31)]
    write(root, "orders", "historical", good + [
        order(31, past[0], "C3"),  # customer held back
        order(1, past[0]),  # repeated key
        order(32, past[0], amount="-5"),
    ])
    write(root, "payments", "historical",
          [payment(n, past[n % 3], "SUCCESS" if n % 3 else "FAILED") for n in range(1, 31)]
          + [payment(31, past[0]), payment(32, past[0])])
    write(root, "delivery", "historical",
          [delivery(n, past[n % 3], 30 + n) for n in range(1, 31)])

    write(root, "customers", "2026-09-01", [
        ("C1", "Asha, A.", "asha@example.com", "Mumbai", "2026-01-01"),
        ("C4", "Dia", "d@example.com", "Pune", "2026-08-31"),
    ])
    write(root, "restaurants", "2026-09-01", [])
    write(root, "delivery_partners", "2026-09-01", [])
    write(root, "orders", "2026-09-01",
          [order(n, "2026-09-01", "C4") for n in range(41, 46)]
          + [order(2, past[2], "C1", "R1", "CANCELLED")])  # update of an earlier order
    write(root, "payments", "2026-09-01", [payment(n, "2026-09-01") for n in range(41, 46)])
    write(root, "delivery", "2026-09-01", [delivery(n, "2026-09-01", 50) for n in range(41, 46)])

    for name in ("customers", "restaurants", "delivery_partners"):
        write(root, name, "2026-09-02", [])
    write(root, "orders", "2026-09-02", [order(n, "2026-09-02", "C2") for n in range(51, 53)])
    write(root, "payments", "2026-09-02", [payment(n, "2026-09-02") for n in range(51, 53)])
    write(root, "delivery", "2026-09-02", [])
