"""Quality scores, reports, the gate, and reconciliation with expected defects."""

from __future__ import annotations

from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.errors import QualityGateFailed
from ordermill.functions.values import percent
from ordermill.model import MIN_QUALITY_SCORE
from ordermill.quality.catalog import CATALOG
from ordermill.quality.rules import ERROR, WARN


def score_column():
    """Valid share of ``total`` in percent; a dataset without records scores 100."""
    score = percent(F.col("valid"), F.col("total"))
    return F.coalesce(score, F.lit(Decimal("100.00"))).cast("decimal(5,2)")


def scores(summaries: dict[str, DataFrame], threshold: float = MIN_QUALITY_SCORE) -> DataFrame:
    """One row per dataset: counts, score and status."""
    rows = None
    for dataset, counts in summaries.items():
        row = counts.select(F.lit(dataset).alias("dataset"), "total", "valid")
        rows = row if rows is None else rows.unionByName(row)
    passed = F.col("quality_score") >= F.lit(threshold).cast("decimal(5,2)")
    return rows.select(
        "dataset",
        F.col("total").alias("total_records"),
        F.col("valid").alias("valid_records"),
        (F.col("total") - F.col("valid")).alias("invalid_records"),
        score_column().alias("quality_score"),
    ).withColumns(
        {
            "passed": passed,
            "status": F.when(F.col("total_records") == 0, "NO_DATA")
            .when(passed, "PASSED")
            .otherwise("FAILED"),
        }
    )


def quality_score(valid: int, total: int) -> float:
    """:func:`score_column` for two counts already on the driver."""
    if total == 0:
        return 100.0
    exact = Decimal(valid) * 100 / Decimal(total)
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def build_report(
    dataset: str,
    counts: dict[str, int],
    run_id: str,
    run_date: date,
    validated_at: datetime,
    threshold: float = MIN_QUALITY_SCORE,
) -> dict:
    """The dataset's report from its one-row summary; only rules that failed are listed."""
    total, valid = counts["total"], counts["valid"]
    score = quality_score(valid, total)
    passed = score >= threshold

    def failing(severity: str) -> list[dict]:
        return [
            {"rule_id": r.rule_id, "severity": severity, "failed_records": counts[r.rule_id]}
            for r in CATALOG[dataset]
            if r.severity == severity and counts[r.rule_id]
        ]

    return {
        "run_id": run_id,
        "run_date": run_date.isoformat(),
        "dataset": dataset,
        "total_records": total,
        "valid_records": valid,
        "invalid_records": total - valid,
        "quality_score": score,
        "threshold": threshold,
        "passed": passed,
        "status": "NO_DATA" if total == 0 else "PASSED" if passed else "FAILED",
        "rule_results": failing(ERROR),
        "warnings": failing(WARN),
        "validated_at": validated_at.strftime("%Y-%m-%dT%H:%M:%SZ"),
    }


def enforce_gate(reports: list[dict], threshold: float = MIN_QUALITY_SCORE) -> None:
    """Stop the run when a dataset scores below ``threshold``; called after outputs are written."""
    low = {r["dataset"]: r["quality_score"] for r in reports if r["quality_score"] < threshold}
    if low:
        listed = "; ".join(f"{name}={score:.2f}%" for name, score in low.items())
        raise QualityGateFailed(
            f"quality score below {threshold:.2f}%: {listed}", datasets=",".join(low)
        )


def reconcile(expected: DataFrame, detected: DataFrame) -> DataFrame:
    """Expected against detected failures per rule; ``found`` is TRUE when none was missed."""
    seen = detected.select("rule_id", F.col("failed_records").alias("detected_records"))
    return expected.join(seen, "rule_id", "left").select(
        "rule_id",
        "expected_records",
        F.coalesce("detected_records", F.lit(0)).alias("detected_records"),
        (F.coalesce("detected_records", F.lit(0)) >= F.col("expected_records")).alias("found"),
    )
