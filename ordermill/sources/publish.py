"""Staged processed output: verified as a whole, then published partition by partition."""

from __future__ import annotations

from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.errors import PublishRefused
from ordermill.model import CONFORMED
from ordermill.operators.lookup import bounded
from ordermill.session import CODEC, side_by_side
from ordermill.sources import layout
from ordermill.sources.lake import Lake

STAGED, MANIFEST, FILES = "_staged.json", "_manifest.json", "_manifest_files"
_ANALYTICS = ("orders", "payments", "delivery", "customers", "restaurants")
BUILT_FROM = {"order_analytics": _ANALYTICS, "daily_order_metrics": _ANALYTICS}


def stage(lake: Lake, dataset: str, df: DataFrame, run_date: date, run_id: str) -> DataFrame:
    """Write a dataset to its staging folder, its row count last; returns the written copy."""
    folder = layout.staging("processed", dataset, run_id)
    lake.delete(folder)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("compression", CODEC).parquet(lake.uri(folder))
    rows = seen.get["rows"]
    lake.write_json(
        f"{folder}/{STAGED}",
        {
            "dataset": dataset,
            "run_id": run_id,
            "run_date": run_date.isoformat(),
            "row_count": rows,
            "staged_at": datetime.now(UTC).isoformat(timespec="seconds"),
        },
    )
    return bounded(lake.read(folder, CONFORMED[dataset]), rows)


def schema_differences(found: T.StructType, wanted: T.StructType) -> list[str]:
    """Names, order and types; nullability does not matter."""
    pairs = [(f.name, f.dataType.simpleString()) for f in found]
    agreed = [(f.name, f.dataType.simpleString()) for f in wanted]
    if pairs == agreed:
        return []
    have, want = dict(pairs), dict(agreed)
    return [
        f"{name}: expected {want.get(name)}, found {have.get(name)}"
        for name in dict.fromkeys([*want, *have])
        if want.get(name) != have.get(name)
    ] or ["column order differs"]


def staged_folder(lake: Lake, dataset: str, run_date: date, run_id: str) -> str | None:
    """Where this run's complete output lies: in staging, or already moved by a publish that was
    interrupted before its manifest."""
    staging = layout.staging("processed", dataset, run_id)
    target = layout.partition("processed", dataset, run_date)
    for folder in (staging, target):
        marker = lake.read_json(f"{folder}/{STAGED}")
        if marker and marker["run_id"] == run_id:
            return folder
    return None


def verify_staged(lake: Lake, dataset: str, run_date: date, run_id: str) -> tuple[str, int]:
    """Folder and row count of a staged dataset that is complete and has the agreed schema in
    every file."""
    folder = staged_folder(lake, dataset, run_date, run_id)
    if folder is None:
        raise PublishRefused(
            "staged output is missing or incomplete; rerun the transformation", dataset=dataset
        )
    expected = lake.read_json(f"{folder}/{STAGED}")["row_count"]
    written = lake.spark.read.option("mergeSchema", True).parquet(lake.uri(folder))
    differences = schema_differences(written.schema, CONFORMED[dataset])
    if differences:
        raise PublishRefused("staged schema differs", dataset=dataset, differences=differences)
    rows = written.count()
    if rows != expected:
        raise PublishRefused(
            "staged row count differs", dataset=dataset, expected=expected, found=rows
        )
    return folder, rows


def read_manifest(lake: Lake, dataset: str, run_date: date) -> dict | None:
    return lake.read_json(f"{layout.partition('processed', dataset, run_date)}/{MANIFEST}")


def file_counts(lake: Lake, dataset: str, run_date: date) -> DataFrame:
    """Rows per file of a processed partition."""
    folder = layout.partition("processed", dataset, run_date)
    return (
        lake.read(folder, CONFORMED[dataset])
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _publish_one(
    lake: Lake, dataset: str, folder: str, rows: int, run_date: date, run_id: str
) -> dict:
    target = layout.partition("processed", dataset, run_date)
    if folder != target:
        lake.swap(folder, target)
    # One line per file, written by Spark: large partitions have many files.
    counts = file_counts(lake, dataset, run_date)
    counts.write.mode("overwrite").json(lake.uri(f"{target}/{FILES}"))
    manifest = {
        "dataset": dataset,
        "run_id": run_id,
        "run_date": run_date.isoformat(),
        "row_count": rows,
        "files": FILES,
        "schema": [
            {"name": f.name, "type": f.dataType.simpleString()} for f in CONFORMED[dataset]
        ],
        "source_partitions": [
            layout.partition("raw", source, run_date)
            for source in BUILT_FROM.get(dataset, (dataset,))
        ],
        "created_at": datetime.now(UTC).isoformat(timespec="seconds"),
    }
    lake.write_json(f"{target}/{MANIFEST}", manifest)  # last: a partition without it is incomplete
    lake.delete(f"{target}/{STAGED}")
    return manifest


def publish(lake: Lake, run_date: date, run_id: str, datasets=tuple(CONFORMED)) -> list[dict]:
    """Replace the run date's partitions; nothing is replaced unless every dataset verifies.

    Datasets this run has already published are left alone, so a retry after success does nothing.
    """

    def already_published(dataset: str) -> dict | None:
        manifest = read_manifest(lake, dataset, run_date)
        staged = lake.exists(f"{layout.staging('processed', dataset, run_id)}/{STAGED}")
        return manifest if manifest and manifest["run_id"] == run_id and not staged else None

    manifests = {dataset: already_published(dataset) for dataset in datasets}
    pending = [dataset for dataset in datasets if manifests[dataset] is None]
    verified = side_by_side(
        [partial(verify_staged, lake, dataset, run_date, run_id) for dataset in pending]
    )
    published = side_by_side(
        [
            partial(_publish_one, lake, dataset, folder, rows, run_date, run_id)
            for dataset, (folder, rows) in zip(pending, verified, strict=True)
        ]
    )
    manifests |= dict(zip(pending, published, strict=True))
    return [manifests[dataset] for dataset in datasets]
