"""Writing tables: upserts, appends, replacements, new columns, artifacts and text reports."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.snapshots import SnapshotTable


def staging_path(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of this process; a cluster has to name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tradelens-")
        atexit.register(shutil.rmtree, root.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the staging folder and read back, which ends its lineage."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert(new: DataFrame, path: str, keys: list[str], order: str, partition_by: list[str] | None = None) -> DataFrame:
    """Upsert into the snapshot table at ``path`` (see ``SnapshotTable``): readers see the table before or after it, never between.

    With ``partition_by``, only partitions that hold a partition or a key of ``new`` are written anew.
    """
    return SnapshotTable(new.sparkSession, path, partition_by).upsert(new, keys, order)


def replaced_filing_rows(old: DataFrame, new: DataFrame, key: str = "filing_id") -> DataFrame:
    """``old`` without the filings of ``new``, and ``new``."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def append_blocks(blocks: DataFrame, path: str) -> None:
    """Append block events; struct references are written as JSON text."""
    texts = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "struct" else F.col(f.name) for f in blocks.schema]
    blocks.select(*texts).write.mode("append").parquet(path)


class RunLedger:
    """Runs as appended events: STARTED, then SUCCEEDED or FAILED. JSON texts have sorted keys; the last event of a run is its state."""

    SCHEMA = "run_id string, status string, at timestamp, params string, summary string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, run_id: str, status: str, params: dict | None, summary: dict | None) -> None:
        import datetime as dt
        import json

        text = lambda d: json.dumps(d, sort_keys=True) if d is not None else None
        row = (run_id, status, dt.datetime.now(), text(params), text(summary))
        self.spark.createDataFrame([row], self.SCHEMA).write.mode("append").parquet(self.path)

    def start(self, run_id: str, params: dict) -> None:
        self._append(run_id, "STARTED", params, None)

    def finish(self, run_id: str, summary: dict, failed: bool = False) -> None:
        self._append(run_id, "FAILED" if failed else "SUCCEEDED", None, summary)

    def runs(self) -> DataFrame:
        """run_id, status, started, finished, params, summary of every run."""
        events = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        ended = F.col("status") != "STARTED"
        return events.groupBy("run_id").agg(
            F.max_by("status", F.struct(ended.cast("int"), "at")).alias("status"), F.min(F.when(~ended, F.col("at"))).alias("started"), F.max(F.when(ended, F.col("at"))).alias("finished"),
            F.max("params").alias("params"), F.max_by("summary", F.struct(ended.cast("int"), "at")).alias("summary"),
        )


def write_with_new_columns(df: DataFrame, path: str) -> None:
    """Append rows whose columns may be new to the table; old rows read them as null, and no file is written anew."""
    df.write.mode("append").parquet(path)


def read_with_new_columns(spark: SparkSession, path: str) -> DataFrame:
    """A table with the columns of all its files."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_artifacts(reports: dict[str, DataFrame], folder: str) -> None:
    """Each report as JSON lines below ``folder``, in as many files as it needs."""
    for name, report in reports.items():
        report.write.mode("overwrite").json(f"{folder}/{name}")


def money(value: Column) -> Column:
    """``+$1.2B``, ``-$3.4M``, ``+$5.6K`` or whole dollars."""
    a, sign = F.abs(value), F.when(value < 0, "-").otherwise("+")
    scaled = F.when(a >= 1e9, F.format_string("%.1fB", a / 1e9)).when(a >= 1e6, F.format_string("%.1fM", a / 1e6)).when(a >= 1e3, F.format_string("%.1fK", a / 1e3)).otherwise(F.format_string("%.0f", a))
    return F.concat(sign, F.lit("$"), scaled)


def numbered(df: DataFrame, order: list, column: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) by ``order``, ties in any order, without sorting all rows in one task.

    Rows are dealt by ranges of the order and sorted there; a row's place is its number in its range after the rows of the ranges before,
    of which the driver gets one count for each range.
    """
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(ranges.withColumns({"_range": F.spark_partition_id(), "_index": index}), "numbered")
    before, starts = 0, []
    for r in sorted(rows.groupBy("_range").count().collect()):
        starts.append((r[0], before))
        before += r[1]
    offsets = df.sparkSession.createDataFrame(starts, "_range int, _before long")
    return rows.join(F.broadcast(offsets), "_range").withColumn(column, F.col("_before") + F.col("_index") + 1).drop("_range", "_index", "_before")


def render_report(df: DataFrame, line: Column, section: str, order: list) -> DataFrame:
    """A table of report lines (section, position, line), ordered within the section."""
    return numbered(df.withColumn("line", line), order).select(F.lit(section).alias("section"), F.col("position").cast("int").alias("position"), "line")


def write_markdown(lines: DataFrame, folder: str, titles: dict[str, str]) -> None:
    """Report lines (section, position, line) as markdown text below ``folder``: each section of ``titles`` with its title and a bullet per line, in that order.

    Files are parts of the text in the order of their names. Sections without lines have their title only.
    """
    spark = lines.sparkSession
    places = spark.createDataFrame([(s, k, t) for k, (s, t) in enumerate(titles.items())], "section string, place int, title string")
    heads = places.select("place", F.lit(0).alias("position"), F.concat(F.lit("## "), "title").alias("value"))
    bullets = lines.join(F.broadcast(places), "section").select("place", "position", F.concat(F.lit("- "), F.regexp_replace("line", r"\s*\n\s*", " ")).alias("value"))
    heads.unionByName(bullets).repartitionByRange("place", "position").sortWithinPartitions("place", "position").select("value").write.mode("overwrite").text(folder)
