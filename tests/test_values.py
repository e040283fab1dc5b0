"""Column functions against exact arithmetic."""

from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions.values import (
    blank_to_null,
    half_up,
    minutes_between,
    parse_as,
    percent,
    ratio,
    upper_code,
)
from ordermill.model import struct


def exact(part, whole):
    quotient = (abs(part) / Decimal(whole)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return -quotient if part < 0 else quotient


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.decimals(-(10**12), 10**12, places=2, allow_nan=False), st.integers(1, 10**9)
        ),
        min_size=1,
        max_size=40,
    )
)
def test_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, struct("part decimal(20,2), whole long"))
    rows = df.select("part", "whole", ratio(F.col("part"), F.col("whole"), 20).alias("q")).collect()
    assert [r["q"] for r in rows] == [exact(r["part"], r["whole"]) for r in rows]


def test_ratio_ties_and_zero(spark):
    rows = spark.createDataFrame(
        [(Decimal("0.01"), 2), (Decimal("-0.01"), 2), (Decimal("1"), 0), (None, 3)],
        struct("a decimal(10,2), b long"),
    ).select(ratio(F.col("a"), F.col("b")).alias("q"))
    assert [r["q"] for r in rows.collect()] == [Decimal("0.01"), Decimal("-0.01"), None, None]


def test_percent(spark):
    rows = spark.createDataFrame([(2, 3), (0, 5), (1, 0)], "a long, b long")
    got = [r[0] for r in rows.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("66.67"), Decimal("0.00"), None]


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("2026-09-01 12:00:00", "2026-09-01 12:31:30", "31.50"),
        ("2026-09-01 12:00:00", "2026-09-01 12:45:00", "45.00"),
        ("2026-09-01 12:00:00", "2026-09-01 12:45:01", "45.02"),
        ("2026-09-01 23:45:00", "2026-09-02 00:15:00", "30.00"),
        ("2026-09-01 12:00:00", None, None),
    ],
)
def test_minutes(spark, start, end, minutes):
    df = spark.createDataFrame([(start, end)], "s string, e string")
    got = df.select(
        minutes_between(F.col("s").cast("timestamp"), F.col("e").cast("timestamp"))
    ).first()[0]
    assert got == (Decimal(minutes) if minutes else None)


def test_text(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,), ("\tb ",)], "t string")
    assert [r[0] for r in df.select(blank_to_null(F.col("t"))).collect()] == [
        "a", None, None, None, "\tb",
    ]
    assert df.select(upper_code(F.col("t"))).first()[0] == "A"


def test_half_up(spark):
    df = spark.createDataFrame([(Decimal("2.25"),), (Decimal("2.24"),)], struct("v decimal(5,2)"))
    got = [r[0] for r in df.select(half_up(F.col("v"), 2, 1)).collect()]
    assert got == [Decimal("2.3"), Decimal("2.2")]


def test_parsing_is_strict(spark):
    texts = ["2026-01-10", "2026-1-9", "2026-02-30", "31/01/2026", "2026-01-10 10:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kinds = struct("d date, t timestamp, n decimal(10,2)")
    dates = [r[0] for r in df.select(parse_as(F.col("t"), kinds["d"].dataType)).collect()]
    assert dates == [date(2026, 1, 10)] + [None] * 6
    times = [r[0] for r in df.select(parse_as(F.col("t"), kinds["t"].dataType)).collect()]
    assert times == [None] * 4 + [datetime(2026, 1, 10, 10)] + [None] * 2
    numbers = spark.createDataFrame([("1e3",), (" 4.5 ",), ("NaN",), ("x",), ("99999999999",)], "t string")
    got = [r[0] for r in numbers.select(parse_as(F.col("t"), kinds["n"].dataType)).collect()]
    assert got == [Decimal("1000.00"), Decimal("4.50"), None, None, None]
