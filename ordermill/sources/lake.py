"""A lake on any Hadoop file system: Parquet partitions plus a few small JSON files."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.errors import SourceMissing
from ordermill.model import CONFORMED, KEY
from ordermill.session import CODEC
from ordermill.sources import layout


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- files ----------------------------------------------------------------------------------

    def uri(self, path: str) -> str:
        return f"{self.root}/{path}"

    def _at(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.uri(path))
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def move(self, source: str, target: str) -> None:
        fs, at = self._at(source)
        _, to = self._at(target)
        fs.mkdirs(to.getParent())
        # renaming to a folder that exists would move into it
        if fs.exists(to) or not fs.rename(at, to):
            raise OSError(f"could not move {source} to {target}")

    def create_new(self, path: str) -> bool:
        """Create an empty file; False when it exists, whoever made it."""
        fs, at = self._at(path)
        fs.mkdirs(at.getParent())
        return fs.createNewFile(at)

    def names(self, path: str) -> list[str]:
        """Names in a folder; empty when it does not exist."""
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def file_sizes(self, path: str) -> dict[str, int]:
        """Bytes of each data file in a folder, or of the file itself, by name; hidden files are left out."""
        fs, at = self._at(path)
        files = {s.getPath().getName(): s.getLen() for s in fs.listStatus(at) if s.isFile()}
        return {name: size for name, size in files.items() if name[0] not in "_."}

    def write_json(self, path: str, value: dict) -> None:
        fs, at = self._at(path)
        stream = fs.create(at, True)
        try:
            stream.write(bytearray((json.dumps(value, indent=2) + "\n").encode()))
        finally:
            stream.close()

    def read_json(self, path: str) -> dict | None:
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # --- partitions -----------------------------------------------------------------------------

    def read(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.uri(path))

    def read_partition(
        self, zone: str, dataset: str, run_date: date, schema: T.StructType
    ) -> DataFrame:
        path = layout.partition(zone, dataset, run_date)
        if not self.restore(path):
            raise SourceMissing(f"no {zone} partition; run the stage before first", path=path)
        return self.read(path, schema)

    def replace_partition(
        self, zone: str, dataset: str, run_date: date, run_id: str, write: Callable[[str], None]
    ) -> str:
        """Let ``write`` fill a staging folder, then swap it in; other partitions stay untouched
        and a failed write leaves the old partition in place.

        The old partition is set aside, not deleted, until the new one stands; :meth:`restore` puts it
        back when a run died in between, which readers and the next writer ask for first.
        """
        staged = layout.staging(zone, dataset, run_id) + "/swap"
        target = layout.partition(zone, dataset, run_date)
        self.delete(staged)
        write(self.uri(staged))
        self.swap(staged, target)
        return target

    def swap(self, staged: str, target: str) -> None:
        """Put ``staged`` in the place of ``target``, which is never lost on the way."""
        aside = layout.aside(target)
        self.restore(target)
        if self.exists(target):
            self.move(target, aside)
        self.move(staged, target)
        self.delete(aside)

    def restore(self, target: str) -> bool:
        """Undo a swap that stopped half-way: the partition set aside comes back unless the new one
        stands.  Returns whether ``target`` exists."""
        aside = layout.aside(target)
        if self.exists(aside):
            if self.exists(target):
                self.delete(aside)
            else:
                self.move(aside, target)
                return True
        return self.exists(target)

    def restore_all(self, folder: str) -> None:
        """:meth:`restore` for the partitions of a dataset; there is nothing to do unless a run died."""
        aside = layout.aside(folder)
        for year in self.names(aside):
            for month in self.names(f"{aside}/{year}"):
                for day in self.names(f"{aside}/{year}/{month}"):
                    self.restore(f"{folder}/{year}/{month}/{day}")

    def write_partition(
        self, df: DataFrame, zone: str, dataset: str, run_date: date, run_id: str
    ) -> str:
        return self.replace_partition(
            zone, dataset, run_date, run_id, lambda uri: df.write.option("compression", CODEC).parquet(uri)
        )

    def history(self, dataset: str, before: date) -> DataFrame | None:
        """Processed rows of run dates before ``before``; None when nothing was processed yet.

        The comparison is on partition columns only, so later partitions are never opened.
        """
        folder = layout.zone_folder("processed", dataset)
        self.restore_all(folder)
        if not self.names(folder):
            return None
        parts = T.StructType([T.StructField(n, T.IntegerType()) for n in ("year", "month", "day")])
        rows = self.read(folder, T.StructType(CONFORMED[dataset].fields + parts.fields))
        return rows.where(F.make_date("year", "month", "day") < F.lit(before)).drop(
            "year", "month", "day"
        )

    def history_keys(self, dataset: str, before: date) -> DataFrame | None:
        """Distinct business keys of :meth:`history`."""
        rows = self.history(dataset, before)
        return None if rows is None else rows.select(KEY[dataset]).distinct()
