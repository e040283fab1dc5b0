"""Calendar rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.model import STAR
from ordermill.operators.keyed import conform


def date_key(day):
    """``yyyymmdd`` as a number."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end``, the two columns of the one-row ``bounds``."""
    days = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date")
    )
    return conform(
        days.selectExpr(
            "year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS date_key",
            "full_date",
            "day(full_date) AS day_of_month",
            "weekday(full_date) + 1 AS day_of_week",
            "date_format(full_date, 'EEEE') AS day_name",
            "weekofyear(full_date) AS week_of_year",
            "month(full_date) AS month",
            "date_format(full_date, 'MMMM') AS month_name",
            "quarter(full_date) AS quarter",
            "year(full_date) AS year",
            "weekday(full_date) >= 5 AS is_weekend",
        ),
        STAR["dim_date"],
    )


def missing_days(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Calendar rows that ``existing`` lacks."""
    return wanted.join(existing.select("full_date"), "full_date", "left_anti").select(
        *wanted.columns
    )
