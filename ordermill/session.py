"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# AQE sizes partitions, turns joins into broadcasts when a side proves small at run time, and
# splits hot join partitions; the library relies on these three and states them explicitly.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # Call sites of every column expression are for notebooks; capturing them triples build time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Of written tables and copies, whatever the session's own is: zstd files are about a third smaller than
# snappy ones, and each is read once or twice.
CODEC = "zstd"


def build_session(app: str = "ordermill", master: str | None = None, **overrides) -> SparkSession:
    """A session with the settings above; ``overrides`` use ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (SETTINGS | {k.replace("__", "."): v for k, v in overrides.items()}).items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``, removed when the driver ends.

    Where that is unset, a temporary folder is used in local mode only: on a cluster executors
    could not see it, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/ordermill-{purpose}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"


def let_go(spark: SparkSession) -> None:
    """Let go of plans that nobody reads any more, between stages that read only what was written.

    Spark keeps what a plan has shuffled on the executors' disks, and its broadcasts, until the driver collects the
    plan, which it may not do for half an hour.
    """
    gc.collect()  # handles in Python keep plans alive
    spark._jvm.System.gc()


def side_by_side(tasks: list[Callable[[], object]]) -> list:
    """Results of independent Spark actions submitted together, so that small jobs do not wait for
    each other and large ones fill each other's gaps.  All finish before the first error is raised.
    """
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        futures = [pool.submit(task) for task in tasks]
    return [future.result() for future in futures]
