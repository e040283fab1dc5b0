"""Post-load checks: each gives ``(check_id, object_name, failed_count)`` rows, all 0 when it
passes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.errors import QualityGateFailed
from ordermill.functions.values import count_if
from ordermill.model import CONFORMED
from ordermill.operators.calendar import date_key
from ordermill.operators.lookup import orphan_total, orphans
from ordermill.plans import views
from ordermill.plans.load import STAGED_ONLY, TARGETS
from ordermill.sources.lake import Lake
from ordermill.sources.publish import read_manifest
from ordermill.sources.star import Star

# fixed values: check ids with their severity
SEVERITY = {
    "WQ-001": "ERROR",
    "WQ-002": "ERROR",
    "WQ-003": "ERROR",
    "WQ-004": "ERROR",
    "WQ-005": "WARN",
    "WQ-006": "ERROR",
}
AOV_TOLERANCE = "0.01"


def _rows(check_id: str, frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per object from one-row frames with a ``failed_count``."""
    named = (
        df.select(
            F.lit(check_id).alias("check_id"),
            F.lit(name).alias("object_name"),
            F.col("failed_count").cast("long").alias("failed_count"),
        )
        for name, df in frames
    )
    return reduce(DataFrame.unionByName, named)


def staged_rows(lake: Lake, run_date: date) -> DataFrame:
    """WQ-001: staged partitions hold as many rows as their manifests say."""
    frames = []
    for dataset in [t.dataset for t in TARGETS] + [STAGED_ONLY]:
        expected = read_manifest(lake, dataset, run_date)["row_count"]
        staged = lake.read_partition("processed", dataset, run_date, CONFORMED[dataset])
        difference = F.abs(F.count(F.lit(1)) - F.lit(expected)).alias("failed_count")
        frames.append((f"stg_{dataset}", staged.agg(difference)))
    return _rows("WQ-001", frames)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, and rows without one; counted per key before anything
    is gathered."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    extra = F.when(F.col(key).isNull(), F.col("_rows")).otherwise(F.col("_rows") - 1)
    return per_key.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("failed_count"))


def key_uniqueness(star: Star) -> DataFrame:
    """WQ-002: business keys are unique."""
    keys = {t.table: t.key for t in TARGETS} | {"dim_date": "full_date"}
    return _rows(
        "WQ-002",
        [(table, repeated_keys(getattr(star, table), key)) for table, key in keys.items()],
    )


def _unmatched(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    found = orphans(child, column, parent.select(key))
    return found.agg(orphan_total().alias("failed_count"))


def fact_keys(star: Star) -> DataFrame:
    """WQ-003: every dimension key of a fact is set and exists."""
    frames = []
    for target in TARGETS:
        points = [(dim, surrogate, surrogate) for dim, _, surrogate in target.lookups]
        if target.day:
            points.append(("dim_date", target.day[1], "date_key"))
        fact = getattr(star, target.table)
        for dimension, column, key in points:
            counted = _unmatched(fact, column, getattr(star, dimension), key)
            frames.append((f"{target.table}.{column}", counted))
    return _rows("WQ-003", frames)


def facts_without_order(star: Star) -> DataFrame:
    """WQ-004: payments and deliveries belong to an order."""
    return _rows(
        "WQ-004",
        [
            (f"{table}.order_id", _unmatched(getattr(star, table), "order_id", star.fact_order, "order_id"))
            for table in ("fact_payment", "fact_delivery")
        ],
    )


def of_days(star: Star, days: DataFrame) -> Star:
    """The star with orders of ``days`` (one column of dates) and the payments of those orders.

    Orders are narrowed by a semi-join with a few date keys, payments by one with the orders' ids, for
    which Spark may add a Bloom filter at run time; both come before anything is aggregated.
    """
    column = days.columns[0]
    keys = days.where(F.col(column).isNotNull()).select(date_key(column).alias("order_date_key"))
    orders = star.fact_order.join(keys.distinct(), "order_date_key", "left_semi")
    payments = star.fact_payment.join(orders.select("order_id"), "order_id", "left_semi")
    narrowed = {"fact_order": orders, "fact_payment": payments}
    return Star(lambda name: narrowed[name] if name in narrowed else getattr(star, name))


def aov_reconciliation(star: Star, staged_metrics: DataFrame) -> DataFrame:
    """WQ-005: the batch's average order values agree with the warehouse's, NULL counting as 0."""
    batch = staged_metrics.select("order_date", F.col("average_order_value").alias("batch_aov"))
    stored = views.daily_revenue(of_days(star, batch.select("order_date"))).select(
        "order_date", F.col("average_order_value").alias("stored_aov")
    )
    zero = F.lit(0).cast("decimal(14,2)")
    apart = F.abs(F.coalesce("stored_aov", zero) - F.coalesce("batch_aov", zero))
    counted = batch.join(stored, "order_date", "left").agg(
        count_if(apart > F.lit(AOV_TOLERANCE).cast("decimal(3,2)")).alias("failed_count")
    )
    return _rows("WQ-005", [("daily_order_metrics.average_order_value", counted)])


def negative_amounts(star: Star) -> DataFrame:
    """WQ-006: no negative amounts."""
    return _rows(
        "WQ-006",
        [
            (
                f"{table}.{column}",
                getattr(star, table).agg(count_if(F.col(column) < 0).alias("failed_count")),
            )
            for table, column in (
                ("fact_order", "order_amount"),
                ("fact_payment", "payment_amount"),
            )
        ],
    )


STAR_CHECKS: tuple[Callable[[Star], DataFrame], ...] = (
    key_uniqueness,
    fact_keys,
    facts_without_order,
    negative_amounts,
)


def run_checks(
    star: Star,
    lake: Lake,
    run_date: date,
    pruned: Callable[[DataFrame], Star] | None = None,
) -> list[dict]:
    """All checks; raises after running them when one with severity ERROR failed.

    ``pruned`` may open the star with only the parts that hold given order days.
    """
    metrics = lake.read_partition("processed", STAGED_ONLY, run_date, CONFORMED[STAGED_ONLY])
    dated = star if pruned is None else pruned(metrics.select("order_date"))
    frames = [staged_rows(lake, run_date), aov_reconciliation(dated, metrics)]
    frames += [check(star) for check in STAR_CHECKS]
    failures: dict[str, dict[str, int]] = {check_id: {} for check_id in SEVERITY}
    for row in reduce(DataFrame.unionByName, frames).where("failed_count <> 0").collect():
        failures[row["check_id"]][row["object_name"]] = row["failed_count"]
    results = [
        {
            "check_id": check_id,
            "severity": SEVERITY[check_id],
            "failures": found,
            "passed": not found,
        }
        for check_id, found in failures.items()
    ]
    failed = [r for r in results if not r["passed"] and r["severity"] == "ERROR"]
    if failed:
        raise QualityGateFailed(
            "post-load checks failed",
            checks=[r["check_id"] for r in failed],
            failures={r["check_id"]: r["failures"] for r in failed},
        )
    return results
