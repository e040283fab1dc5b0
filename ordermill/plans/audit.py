"""Run audit: one record per run, dataset and stage; roll-up, metrics and monitoring queries."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.errors import LoadRefused, RunError
from ordermill.functions.values import half_up, ratio, sum_if
from ordermill.model import AUDIT, AUDIT_KEY, WHOLE_RUN
from ordermill.operators.keyed import conform, top_per_key
from ordermill.operators.merge import replace_rows
from ordermill.sources import layout
from ordermill.sources.lake import Lake
from ordermill.sources.warehouse import Warehouse

RECENT_RUNS = 7
COMMITS = 5  # attempts to add a run to the audit table while others do


# --- records ------------------------------------------------------------------------------------


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def save_record(lake: Lake, run_date: date, record: dict) -> dict:
    """Keep one stage record beside the data; a rerun of the stage replaces it."""
    text = {
        name: value.isoformat(sep=" ") if isinstance(value, datetime) else value
        for name, value in record.items()
        if value is not None
    }
    text["run_date"] = run_date.isoformat()
    lake.write_json(layout.audit_record(record["stage"], record["dataset"], run_date), text)
    return record


def run_records(lake: Lake, run_date: date, run_id: str) -> DataFrame:
    """All records this run has left so far."""
    folder = layout.audit_folder(run_date)
    if not lake.names(folder):
        return lake.spark.createDataFrame([], AUDIT)
    rows = lake.spark.read.schema(AUDIT).option("multiLine", True).json(lake.uri(folder))
    return rows.where(F.col("run_id") == run_id)


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Audit table after ``new`` records; records of the same run, dataset and stage go."""
    return replace_rows(existing, conform(new, AUDIT), AUDIT_KEY)


def write_audit(warehouse: Warehouse, new: DataFrame) -> int:
    """Put records into the audit table; returns its new version.

    The table has a part for each run date, and only the parts of ``new`` (one, for a run) are read and
    written.  When another run closes at the same time, this one starts again from its version.
    """
    table = "pipeline_run_audit"
    days = [row["run_date"] for row in new.select("run_date").distinct().collect()]
    for attempt in range(1, COMMITS + 1):
        version = warehouse.version(table)
        parts = {
            str(day): upsert(warehouse.read(table, [str(day)]), new.where(F.col("run_date") == F.lit(day)))
            for day in days
        }
        try:
            return warehouse.replace_parts(table, parts, version)
        except LoadRefused:
            if attempt == COMMITS:
                raise


# --- run level ----------------------------------------------------------------------------------


def failed_stages(records: DataFrame) -> DataFrame:
    """Stage records that keep a run from being successful."""
    return records.where("status = 'FAILED' AND stage <> 'pipeline'").select(
        "run_id", F.concat_ws("/", "stage", "dataset").alias("failed")
    )


def run_rollup(
    records: DataFrame, finished_at=None, status: str = "SUCCESS", error: str | None = None
) -> DataFrame:
    """One record per run from its stage records.

    Records in come from ingestion, out from the load, rejected from validation.  Without
    ``finished_at`` the run ends with its last stage.
    """
    stage = F.col("stage")
    ended = F.max("finished_at") if finished_at is None else F.lit(finished_at).cast("timestamp")
    runs = (
        records.where(stage != "pipeline")
        .groupBy("run_id", "run_date")
        .agg(
            F.max("load_type").alias("load_type"),
            sum_if(stage == "ingestion", F.col("records_in")).alias("records_in"),
            sum_if(stage == "warehouse_load", F.col("records_out")).alias("records_out"),
            sum_if(stage == "validation", F.col("records_rejected")).alias("records_rejected"),
            F.min("started_at").alias("started_at"),
            ended.alias("finished_at"),
        )
    )
    seconds = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return conform(
        runs.withColumns(
            {
                "dataset": F.lit(WHOLE_RUN),
                "stage": F.lit("pipeline"),
                "status": F.lit(status),
                "quality_score": F.lit(None),
                "duration_seconds": half_up(seconds.cast("decimal(20,0)") / 1_000_000, 10, 2),
                "error_message": F.lit(error),
            }
        ),
        AUDIT,
    )


def assert_no_failed_stage(records: DataFrame) -> None:
    failed = [row["failed"] for row in failed_stages(records).collect()]
    if failed:
        raise RunError("run has failed stages; it is not successful", failed=failed)


def stage_metrics(records: DataFrame) -> DataFrame:
    """Published metrics in long form: ``(run_id, metric, dataset, unit, value)``."""
    stage = F.col("stage")
    is_run = stage == "pipeline"
    ok = F.col("status") != "FAILED"
    number = "decimal(20,2)"
    # metric, when it is published, its value, unit
    published = (
        ("RecordsIngested", (stage == "ingestion") & ok, F.col("records_out"), "Count"),
        ("RecordsRejected", stage == "validation", F.col("records_rejected"), "Count"),
        (
            "DataQualityScore",
            (stage == "validation") & (F.col("records_in") > 0),
            F.col("quality_score"),
            "Percent",
        ),
        ("RecordsProcessed", (stage == "publish") & ok, F.col("records_out"), "Count"),
        ("PipelineSuccess", is_run & ok, F.lit(1), "Count"),
        ("PipelineDurationSeconds", is_run & ok, F.col("duration_seconds"), "Seconds"),
        ("PipelineFailure", is_run & ~ok, F.lit(1), "Count"),
    )
    candidates = F.array(
        *(
            F.when(
                condition,
                F.struct(
                    F.lit(name).alias("metric"),
                    F.lit(unit).alias("unit"),
                    value.cast(number).alias("value"),
                ),
            )
            for name, condition, value, unit in published
        )
    )
    return (
        records.select("run_id", "dataset", F.explode(F.array_compact(candidates)).alias("m"))
        .select("run_id", "m.metric", F.nullif("dataset", F.lit(WHOLE_RUN)).alias("dataset"),
                "m.unit", "m.value")
        .where("value IS NOT NULL")
    )


# --- monitoring queries over the audit table ----------------------------------------------------


def recent_runs(audit: DataFrame) -> DataFrame:
    """The last seven runs, newest first."""
    return (
        audit.where("stage = 'pipeline'")
        .select(
            "run_id",
            "run_date",
            "load_type",
            "status",
            "records_in",
            "records_out",
            "records_rejected",
            "duration_seconds",
            "finished_at",
            "error_message",
        )
        .orderBy(F.col("finished_at").desc_nulls_first(), "run_id")
        .limit(RECENT_RUNS)
    )


def quality_trend(audit: DataFrame) -> DataFrame:
    """Quality score per dataset and run date, of the latest attempt."""
    scored = audit.where(
        (F.col("stage") == "validation")
        & (F.col("dataset") != WHOLE_RUN)
        & F.col("quality_score").isNotNull()
    )
    return (
        top_per_key(
            scored,
            ["run_date", "dataset"],
            F.col("finished_at").desc_nulls_first(),
            F.col("run_id").desc(),
        )
        .select(
            "dataset", "run_date", "run_id", "records_in", "records_rejected", "quality_score"
        )
        .orderBy("dataset", "run_date")
    )


def slowest_stages(audit: DataFrame) -> DataFrame:
    """Stages by mean seconds per run: ingestion runs per dataset and is summed, the others write
    the whole step's time on every row."""
    seconds = F.when(F.col("stage") == "ingestion", F.sum("duration_seconds")).otherwise(
        F.max("duration_seconds")
    )
    per_run = (
        audit.where((F.col("stage") != "pipeline") & F.col("duration_seconds").isNotNull())
        .groupBy("run_id", "stage")
        .agg(seconds.cast("decimal(20,2)").alias("seconds"))
    )
    return (
        per_run.groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("seconds").alias("_total"),
            F.max("seconds").alias("max_seconds"),
        )
        .select("stage", "runs", ratio(F.col("_total"), F.col("runs")).alias("avg_seconds"),
                "max_seconds")
        .orderBy(F.col("avg_seconds").desc(), "stage")
    )


MONITORING = {
    "recent_runs": recent_runs,
    "quality_trend": quality_trend,
    "slowest_stages": slowest_stages,
}
