"""One run date from drops to checked star schema, stage by stage.

Every stage reads what the stage before wrote, so stages may run in one process or be scheduled
separately, and each may be retried.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T

from ordermill.model import (
    CALENDAR_END,
    CALENDAR_START,
    CONFORMED,
    DATASETS,
    KEY,
    LINEAGE,
    MIN_QUALITY_SCORE,
    SOURCE,
    WHOLE_RUN,
)
from ordermill.plans import audit, checks, load
from ordermill.plans.conform import process
from ordermill.quality import evaluate, report
from ordermill.quality.catalog import WAVES, parents_of
from ordermill.session import CODEC, let_go, side_by_side
from ordermill.sources import ingest, layout, publish
from ordermill.sources.lake import Lake
from ordermill.sources.warehouse import Warehouse

HISTORY = ("customers", "restaurants", "delivery_partners", "orders")


@dataclass
class Run:
    """A run date of one load type, and where it reads and writes."""

    lake: Lake
    warehouse: Warehouse
    source_root: str
    run_date: date
    load_type: str
    run_id: str
    min_score: float = MIN_QUALITY_SCORE
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END)
    results: dict = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str, dataset: str = WHOLE_RUN):
        """Collect the stage's records; a failure leaves a FAILED record and is raised again."""
        started = audit.now()

        def record(dataset: str, status: str, **counts):
            finished = audit.now()
            audit.save_record(
                self.lake,
                self.run_date,
                {
                    "run_id": self.run_id,
                    "load_type": self.load_type,
                    "dataset": dataset,
                    "stage": name,
                    "status": status,
                    "started_at": started,
                    "finished_at": finished,
                    "duration_seconds": round((finished - started).total_seconds(), 2),
                    **counts,
                },
            )

        self.lake.delete(layout.audit_record(name, dataset, self.run_date))  # an earlier attempt's
        try:
            yield record
        except Exception as error:
            record(dataset, "FAILED", error_message=f"{type(error).__name__}: {error}")
            raise


def ingest_drops(run: Run) -> list[dict]:
    """All drops; they do not depend on each other."""

    def one(dataset: str) -> dict:
        with run.stage("ingestion", dataset) as record:
            result = ingest.ingest(
                run.lake, run.source_root, dataset, run.load_type, run.run_date, run.run_id
            )
            record(
                dataset,
                result["status"],
                records_in=result["records_read"],
                records_out=result["records_written"],
            )
            return result

    return side_by_side([partial(one, dataset) for dataset in DATASETS])


def validate_dataset(run: Run, dataset: str, valid: dict) -> tuple[dict, DataFrame]:
    """Write one dataset's valid and quarantined records and its report.

    Returns the report and the valid keys for the datasets that refer to this one.
    """
    lake, day = run.lake, run.run_date
    raw = lake.read_partition("raw", dataset, day, ingest.raw_schema(dataset))
    # Not made distinct here: the lookup first narrows the history to the keys of this batch.
    earlier = {name: lake.history(name, day) for name in parents_of(dataset)}
    scope = evaluate.scope_for(dataset, raw, day, valid, earlier)
    scratch = layout.staging("validated", dataset, run.run_id)

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", CODEC).parquet(lake.uri(f"{scratch}/{name}"))
        return lake.read(f"{scratch}/{name}", df.schema)

    seen = Observation()
    tagged = evaluate.tag(raw, dataset, scope, keep=keep, seen=seen)
    counts = seen.get
    validated_at = audit.now().replace(microsecond=0)
    kept = evaluate.valid_records(tagged, dataset)
    held = evaluate.quarantined_records(tagged, dataset, validated_at)
    side_by_side(
        [
            lambda: lake.write_partition(kept, "validated", dataset, day, run.run_id),
            lambda: lake.write_partition(held, "quarantine", dataset, day, run.run_id),
        ]
    )
    lake.delete(scratch)
    result = report.build_report(dataset, counts, run.run_id, day, validated_at, run.min_score)
    lake.write_json(layout.quality_report(dataset, day), result)
    written = lake.read_partition("validated", dataset, day, validated_schema(dataset))
    return result, written.select(KEY[dataset])


def validate(run: Run) -> list[dict]:
    """All datasets, parents first; the gate is applied after every output is written."""
    reports, valid = [], {}
    with run.stage("validation") as record:
        for wave in WAVES:
            done = side_by_side([partial(validate_dataset, run, name, valid) for name in wave])
            for dataset, (result, keys) in zip(wave, done, strict=True):
                valid[dataset] = keys
                reports.append(result)
                record(
                    dataset,
                    {"PASSED": "SUCCESS"}.get(result["status"], result["status"]),
                    records_in=result["total_records"],
                    records_out=result["valid_records"],
                    records_rejected=result["invalid_records"],
                    quality_score=result["quality_score"],
                )
            let_go(run.lake.spark)
        report.enforce_gate(reports, run.min_score)
    return reports


def validated_schema(dataset: str) -> T.StructType:
    return T.StructType(SOURCE[dataset].fields + LINEAGE.fields)


def transform(run: Run) -> dict[str, int]:
    """Stage all eight processed datasets; returns their row counts."""
    lake, day = run.lake, run.run_date
    with run.stage("transformation") as record:
        validated = {
            name: lake.read_partition("validated", name, day, validated_schema(name))
            for name in DATASETS
        }
        earlier = {name: lake.history(name, day) for name in HISTORY}
        lake.delete(layout.orphan_keys(day))
        process(
            validated,
            earlier,
            run.run_id,
            keep=lambda name, df: publish.stage(lake, name, df, day, run.run_id),
            check=True,
            report=lambda name, column, keys: keys.write.parquet(
                lake.uri(f"{layout.orphan_keys(day)}/{name}__{column}")
            ),
        )
        counts = {}
        for name in CONFORMED:
            folder = layout.staging("processed", name, run.run_id)
            counts[name] = lake.read_json(f"{folder}/{publish.STAGED}")["row_count"]
            record(name, "SUCCESS" if counts[name] else "NO_DATA", records_out=counts[name])
    return counts


def publish_processed(run: Run) -> list[dict]:
    with run.stage("publish") as record:
        manifests = publish.publish(run.lake, run.run_date, run.run_id)
        for manifest in manifests:
            rows = manifest["row_count"]
            record(manifest["dataset"], "SUCCESS" if rows else "NO_DATA", records_out=rows)
    return manifests


def load_star(run: Run) -> list[dict]:
    with run.stage("warehouse_load") as record:
        results = load.load_warehouse(run.warehouse, run.lake, run.run_date, *run.calendar)
        for result in results:
            record(
                result["dataset"],
                result["status"],
                records_in=result["records_in"],
                records_out=result["records_staged"],
            )
    return results


def check_star(run: Run) -> list[dict]:
    with run.stage("post_load_checks") as record:
        results = checks.run_checks(
            run.warehouse.star(), run.lake, run.run_date, pruned=run.warehouse.star
        )
        record(
            WHOLE_RUN,
            "SUCCESS",
            records_in=len(results),
            records_rejected=sum(not r["passed"] for r in results),
        )
    return results


def summarise(run: Run) -> dict:
    """Put the run's records and their roll-up into the audit table; refused when a stage failed."""
    records = audit.run_records(run.lake, run.run_date, run.run_id).where("stage <> 'pipeline'")
    audit.assert_no_failed_stage(records)
    return _close(run, records, "SUCCESS", None)


def record_failure(run: Run, task: str, error: Exception | str) -> dict | None:
    """Close a failed run: roll-up with status FAILED.  Never hides the original error."""
    try:
        records = audit.run_records(run.lake, run.run_date, run.run_id).where("stage <> 'pipeline'")
        return _close(run, records, "FAILED", f"{task}: {error}")
    except Exception:  # noqa: BLE001
        return None


def _close(run: Run, records, status: str, error: str | None) -> dict:
    finished = audit.now()
    total = audit.run_rollup(records, finished, status, error)
    rows = records.unionByName(total)
    audit.write_audit(run.warehouse, rows)
    closed = total.first()
    result = {"status": status} | (closed.asDict() if closed else {})
    if closed:
        kept = {k: v for k, v in result.items() if k not in ("run_date",)}
        for name in ("duration_seconds", "quality_score"):
            kept[name] = None if kept[name] is None else float(kept[name])
        audit.save_record(run.lake, run.run_date, kept)
    return result


STAGES = (
    ("ingestion", ingest_drops),
    ("validation", validate),
    ("transformation", transform),
    ("publish", publish_processed),
    ("warehouse_load", load_star),
    ("post_load_checks", check_star),
    ("summary", summarise),
)


def run_all(run: Run) -> dict:
    """All stages in order; stops at the first failure, which is recorded and raised."""
    for name, stage in STAGES:
        try:
            run.results[name] = stage(run)
        except Exception as error:
            record_failure(run, name, error)
            raise
        let_go(run.lake.spark)
    return run.results
