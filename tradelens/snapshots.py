"""Parquet tables that change by snapshots: files first, then a manifest, so a reader sees the old table or the new one."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAST_LINE = "end"


def _same(columns: list[str]) -> Column:
    """Equal columns of ``_old`` and ``_new``, where null equals null."""
    return reduce(Column.__and__, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in columns])


class CommitConflict(RuntimeError):
    """Another writer has published the version that this one was going to."""


class SnapshotTable:
    """A table below ``path``: ``data/snapshot=<id>/...`` holds files, ``manifests/<version>`` names the folders that are the table.

    A manifest is created, never overwritten, and its last line tells that it is whole, so a writer that fails at any point leaves
    the newest whole manifest as it was. Of two writers that started from one version the second gets ``CommitConflict`` and has to try again.
    Manifests hold the schema and one line per folder (a partition, or the whole table), so they grow with partitions, not with rows.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by or [])
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        root = self._path("")
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._hadoop.Path(f"{self.path}/{below}" if below else self.path)

    def _list(self, below: str) -> list:
        at = self._path(below)
        return list(self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _manifest(self, version: int) -> list[str] | None:
        """Lines of a manifest without the last, none if it is not whole."""
        stream = self._fs.open(self._path(f"manifests/{version:020d}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        lines = text.split("\n")
        return lines[:-1] if lines[-1] == LAST_LINE else None

    def versions(self) -> list[int]:
        """Versions of all whole manifests, the newest last."""
        return [v for v in self._numbers() if self._manifest(v) is not None]

    def _numbers(self) -> list[int]:
        return sorted(int(s.getPath().getName()) for s in self._list("manifests") if s.getPath().getName().isdigit())

    def _state(self, version: int | None = None) -> tuple[int, StructType | None, list[str]]:
        """Version, schema and folders of a snapshot (the newest whole one if none is named); version -1 before the first commit."""
        numbers = self._numbers()
        for v in [version] if version is not None else reversed(numbers):
            if (lines := self._manifest(v)) is not None:
                return v, StructType.fromJson(json.loads(lines[0])), lines[1:]
        return -1, None, []

    def _read(self, schema: StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(StructType([*schema.fields]).add("snapshot", "string")).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, by default the newest."""
        at, schema, folders = self._state(version)
        if schema is None:
            raise FileNotFoundError(f"no snapshot below {self.path}")
        return self._read(schema, folders).select(*schema.names)

    def _write(self, df: DataFrame) -> list[str]:
        """Rows in a folder of their own; the folders that a manifest has to name for them."""
        base = f"data/snapshot={uuid.uuid4().hex}"
        writer = df.write.partitionBy(*self.partition_by) if self.partition_by else df.write
        writer.parquet(f"{self.path}/{base}")
        folders = [base]
        for _ in self.partition_by:
            folders = [f"{f}/{s.getPath().getName()}" for f in folders for s in self._list(f) if s.isDirectory()]
        return folders

    def _publish(self, version: int, schema: StructType, folders: list[str]) -> None:
        at = self._path(f"manifests/{version:020d}")
        if self._fs.exists(at):
            raise CommitConflict(at.toString())
        try:
            stream = self._fs.create(at, False)
        except Exception as e:
            raise CommitConflict(at.toString()) from e
        stream.write(bytearray("\n".join([schema.json(), *sorted(folders), LAST_LINE]).encode()))
        stream.close()

    def _touched(self, schema: StructType, folders: list[str], new: DataFrame, keys: list[str]) -> list[str]:
        """Folders that hold a partition or a key of the new rows: a key that moves to another partition leaves its old one."""
        encoded = {f: self._path(f).toUri().getRawPath() for f in folders}
        old = self._read(schema, folders).select(*{*keys, *self.partition_by}, F.regexp_extract("_metadata.file_path", r"(/data/snapshot=.*)/[^/]*$", 1).alias("_folder"))
        found = [old.alias("_old").join(new.select(*by).distinct().alias("_new"), _same(by), "left_semi").select("_folder") for by in (self.partition_by, keys)]
        names = {r[0] for r in found[0].union(found[1]).distinct().collect()}
        return [f for f, e in encoded.items() if e[e.rindex("/data/snapshot=") :] in names]

    def upsert(self, new: DataFrame, keys: list[str], order: str) -> DataFrame:
        """Insert rows or replace those of the same key; of several new rows the last by ``order`` counts. Only folders that can hold the keys are written anew.

        Null keys are keys like others. An empty ``new`` publishes the table as it is. Columns that only one side has are null in the other's rows.
        """
        version, schema, folders = self._state()
        last = W.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
        first = new.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
        kept: list[str] = []
        if schema is not None:
            touched = self._touched(schema, folders, first, keys) if self.partition_by and folders else folders
            kept = [f for f in folders if f not in touched]
            old = self._read(schema, touched).select(*schema.names)
            first = old.alias("_old").join(first.alias("_new"), _same(keys), "left_anti").unionByName(first, allowMissingColumns=True)
        numbers = self._numbers()
        self._publish(max([version, *numbers]) + 1, first.schema, kept + self._write(first))
        return self.read()

    def vacuum(self, keep: int = 1, hours: float = 24) -> list[str]:
        """Remove manifests but the newest ``keep``, then data that none of those names and that is older than ``hours`` (a commit may be under way)."""
        whole = self.versions()
        named = {f.split("/")[1] for v in whole[-keep:] for f in self._manifest(v)[1:]}
        for v in self._numbers():
            if v not in whole[-keep:] and v < whole[-1]:
                self._fs.delete(self._path(f"manifests/{v:020d}"), False)
        old = [s for s in self._list("data") if s.getPath().getName() not in named and s.getModificationTime() <= (time.time() - hours * 3600) * 1000]
        for s in old:
            self._fs.delete(s.getPath(), True)
        return [s.getPath().getName() for s in old]
