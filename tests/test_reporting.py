"""Views and reports on nine orders with results worked out by hand."""

from datetime import date

import pytest
from conftest import plain

from ordermill.plans import reports, views
from ordermill.sources.star import Star

SEP1, SEP2, SEP3 = date(2026, 9, 1), date(2026, 9, 2), date(2026, 9, 3)


def test_daily_views(star):
    assert sorted(plain(views.daily_orders(star))) == [(SEP1, 4, 3, 1, 25.0), (SEP2, 5, 3, 1, 20.0)]
    assert sorted(plain(views.daily_revenue(star))) == [
        (SEP1, 3, 1200.0, 400.0),
        (SEP2, 4, 1350.0, 337.5),
    ]


def test_restaurant_performance(star):
    rows = {r[0]: r[5:] for r in plain(views.restaurant_performance(star))}
    assert rows == {
        "R1": (4, 1100.0, 366.67, 25.0, 35.0),
        "R2": (3, 700.0, 350.0, 33.33, 47.5),
        "R3": (2, 750.0, 375.0, 0.0, 40.0),
        "R4": (0, 0.0, None, None, None),
    }


def test_delivery_performance(star):
    assert sorted(plain(views.delivery_performance(star))) == [
        (SEP1, "Mumbai", 2, 2, 0, 47.5, 1, 50.0),
        (SEP1, "Pune", 2, 1, 1, 30.0, 0, 0.0),
        (SEP2, "Pune", 4, 3, 0, 40.0, 1, 33.33),
    ]


def test_customer_summary(star):
    rows = {r[0]: r[4:] for r in plain(views.customer_summary(star))}
    assert rows == {
        "C1": (3, 1450.0, SEP1, SEP2, True),
        "C2": (3, 750.0, SEP1, SEP2, True),
        "C3": (2, 250.0, SEP2, SEP2, True),
        "C4": (1, 100.0, SEP2, SEP2, False),
        "C5": (0, 0.0, None, None, False),
    }


def test_payment_summary(star):
    rows = plain(views.payment_summary(star))
    assert sum(r[3] for r in rows) == 10
    assert (SEP3, "UPI", "SUCCESS", 1, 350.0) in rows
    assert (SEP1, "CARD", "FAILED", 1, 300.0) in rows


EXPECTED = {
    "01_daily_orders": [(SEP1, 4, 3, 1), (SEP2, 5, 3, 1)],
    "02_daily_revenue": [(SEP1, 3, 1200.0), (SEP2, 4, 1350.0)],
    "03_average_order_value": [
        ("overall", None, 7, 2550.0, 364.29),
        ("daily", SEP1, 3, 1200.0, 400.0),
        ("daily", SEP2, 4, 1350.0, 337.5),
    ],
    "04_cancellation_rate": [
        ("overall", None, 9, 2, 22.22),
        ("daily", SEP1, 4, 1, 25.0),
        ("daily", SEP2, 5, 1, 20.0),
    ],
    "05_payment_success_rate": [
        ("CARD", 4, 2, 50.0),
        ("UPI", 4, 3, 75.0),
        ("CASH", 1, 1, 100.0),
        ("WALLET", 1, 1, 100.0),
    ],
    "06_revenue_by_city": [("Pune", 6, 1850.0), ("Mumbai", 3, 700.0), ("Delhi", 0, 0.0)],
    "09_orders_by_cuisine": [
        ("Indian", 4, 1100.0, 44.44),
        ("Chinese", 3, 700.0, 33.33),
        ("Italian", 2, 750.0, 22.22),
        ("Desserts", 0, 0.0, 0.0),
    ],
    "10_average_delivery_time": [
        ("overall", None, 6, 40.83),
        ("city", "Mumbai", 2, 47.5),
        ("city", "Pune", 4, 37.5),
    ],
    "11_late_deliveries": [
        ("overall", None, 6, 2, 33.33),
        ("city", "Mumbai", 2, 1, 50.0),
        ("city", "Pune", 4, 1, 25.0),
    ],
    "12_customer_order_frequency": [(1, 1, 25.0), (2, 1, 25.0), (3, 2, 50.0)],
    "13_repeat_customers": [(4, 3, 75.0)],
    "14_monthly_revenue": [("2026-09", 7, 2550.0, 364.29)],
}


@pytest.mark.parametrize("name", EXPECTED)
def test_report(star, name):
    assert plain(reports.run_report(name, star)) == EXPECTED[name]


def test_restaurant_rankings(star):
    by_orders = plain(reports.run_report("07_orders_by_restaurant", star))
    assert [r[0] for r in by_orders] == ["R1", "R2", "R3", "R4"]
    by_revenue = plain(reports.run_report("08_top_restaurants", star))
    assert [(r[0], r[6]) for r in by_revenue] == [
        ("R1", 1100.0),
        ("R3", 750.0),
        ("R2", 700.0),
        ("R4", 0.0),
    ]


def test_peak_hours(star):
    rows = plain(reports.run_report("15_peak_ordering_hours", star))
    assert rows[0] == (20, "Tuesday", 2, 1)
    assert {r[3] for r in rows[1:]} == {2}
    assert sum(r[2] for r in rows) == 9


def test_overall_rows_exist_without_data(spark, star):
    empty = Star(lambda name: getattr(star, name).limit(0))
    assert plain(reports.run_report("03_average_order_value", empty)) == [
        ("overall", None, None, None, None)
    ]
    assert plain(reports.run_report("10_average_delivery_time", empty)) == [
        ("overall", None, 0, None)
    ]


def test_unknown_report_is_refused_before_tables_are_opened():
    def explode(name):
        raise AssertionError(name)

    with pytest.raises(ValueError, match="unknown report"):
        reports.run_report("16_everything", Star(explode))


def test_views_add_up_to_facts(star):
    assert sum(r[1] for r in plain(views.daily_orders(star))) == 9
    assert sum(r[5] for r in plain(views.restaurant_performance(star))) == 9
    assert sum(r[4] for r in plain(views.customer_summary(star))) == 9


def test_views_answer_sql(spark, star):
    assert len(views.register_views(star)) == 6
    top = spark.sql("SELECT MAX(total_revenue) AS m FROM vw_restaurant_performance").first()
    assert float(top["m"]) == 1100.0
