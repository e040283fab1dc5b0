"""Reading the given tables and places for what an operator writes."""

from __future__ import annotations

import gc
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ordermill.llm.segments import give_back
from ordermill.session import shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    Handles of plans that are no longer needed go with it, and what the driver learned from them: an
    operator of many steps would otherwise keep all its plans until Python happens to look.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    gc.collect()
    give_back()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder, as tasks use them to write files of their own format."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def fresh_name(stem: str) -> str:
    """A name that no other attempt at the same task has."""
    return f"{stem}-{uuid.uuid4().hex}"
