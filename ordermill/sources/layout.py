"""Where things lie in the lake: ``<zone>/<dataset>/year=YYYY/month=MM/day=DD/``."""

from __future__ import annotations

import re
from datetime import date

from ordermill.model import LOAD_TYPES

ZONES = ("raw", "validated", "quarantine", "processed", "reports")


def day_folder(run_date: date) -> str:
    return run_date.strftime("year=%Y/month=%m/day=%d")


def zone_folder(zone: str, dataset: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    return f"{zone}/{dataset}"


def partition(zone: str, dataset: str, run_date: date) -> str:
    return f"{zone_folder(zone, dataset)}/{day_folder(run_date)}"


def staging(zone: str, dataset: str, run_id: str) -> str:
    """Run-scoped scratch; characters that URIs or Hadoop paths dislike become ``_``."""
    safe = re.sub(r"[^\w.=-]", "_", run_id, flags=re.ASCII)
    return f"_tmp/{safe}/{zone_folder(zone, dataset)}"


def aside(target: str) -> str:
    """Where a partition lies while another one takes its place: outside the zones, so that no scan of a
    dataset sees both."""
    return f"_aside/{target}"


def quality_report(dataset: str, run_date: date) -> str:
    return f"reports/data_quality/{day_folder(run_date)}/{dataset}.json"


def orphan_keys(run_date: date) -> str:
    return f"reports/orphan_keys/{day_folder(run_date)}"


def audit_folder(run_date: date) -> str:
    return f"reports/audit/{day_folder(run_date)}"


def audit_record(stage: str, dataset: str, run_date: date) -> str:
    return f"{audit_folder(run_date)}/{stage}__{dataset}.json"


def drop(dataset: str, load_type: str, run_date: date) -> str:
    """Path of a drop below the source root: ``orders/orders_historical.csv`` or
    ``orders/orders_2026-09-29.csv``."""
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load type must be one of {LOAD_TYPES}, not {load_type!r}")
    label = "historical" if load_type == "historical" else run_date.isoformat()
    return f"{dataset}/{dataset}_{label}.csv"
