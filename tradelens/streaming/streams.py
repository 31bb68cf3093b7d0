"""Streams of landed filings and trades."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tradelens.sources.forms import parse_form4


def stream_form4(spark: SparkSession, folder: str, files_per_trigger: int = 1000, whole: bool = True) -> DataFrame:
    """Transactions of ownership filings as files land in ``folder``; the checkpoint of the query makes each file count once.

    A file is a document, or with ``whole`` false holds a document per line.
    """
    files = spark.readStream.option("wholetext", whole).option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return parse_form4(files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content")))


def changed_only(filings: DataFrame, known: DataFrame) -> DataFrame:
    """Filings (filing_id, content) whose content hash is not among the known (filing_id, hash) pairs."""
    hashed = filings.withColumn("hash", F.sha2(F.col("content").cast("binary"), 256))
    return hashed.join(known, ["filing_id", "hash"], "left_anti")


def stream_changed_only(filings: DataFrame, event_time: str, known: DataFrame, delay: str = "7 days") -> DataFrame:
    """Filings of a stream whose content is not in the ledger of (filing_id, hash), each (filing_id, content) once within the watermark.

    The ledger is a table: what it holds is known whenever it arrives. What comes twice in the stream is told apart by state, which is dropped
    ``delay`` after the first arrival; rows behind the watermark are dropped.
    """
    fresh = changed_only(filings.withWatermark(event_time, delay), known)
    return fresh.dropDuplicatesWithinWatermark(["filing_id", "hash"])


def cluster_buy_windows(buys: DataFrame, event_time: str, days: int = 30, slide: int = 1, delay: str = "60 days", least: int = 2, streaming: bool = True) -> DataFrame:
    """Distinct buyers per ticker in sliding windows; ``buys``: ticker, actor_id, value and the event time. The same plan serves batch and stream.

    Two aggregations in one query: trades to (window, ticker, actor), then actors to (window, ticker). In append mode a window comes out once, when the
    watermark has passed its end, and its state goes; no set of actors is held, and a ticker's actors are spread over tasks. Rows within
    ``delay`` of the newest one count, later ones are dropped. Rows without an actor only move the watermark (a filter would keep them from it).
    """
    rows = buys.withWatermark(event_time, delay) if streaming else buys
    per_actor = rows.groupBy(F.window(event_time, f"{days} days", f"{slide} days"), "ticker", "actor_id").agg(F.count("actor_id").alias("trades"), F.sum(F.when(F.col("actor_id").isNotNull(), F.col("value"))).alias("total_value"))
    agg = per_actor.groupBy("window", "ticker").agg(F.count("actor_id").cast("int").alias("actors"), F.sum("trades").alias("trades"), F.sum("total_value").alias("total_value"))
    return agg.where(F.col("actors") >= least).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "ticker", "actors", "trades", "total_value")


def rescore_touched(history: DataFrame, new: DataFrame, score, key: str = "subject_key") -> DataFrame:
    """Score only the subjects that ``new`` touches, over their whole history and the new rows."""
    touched = new.select(key).distinct()
    return score(history.join(touched, key, "left_semi").unionByName(new))


def rescore_stream(stream: DataFrame, history_path: str, scores_path: str, score, checkpoint: str, key: str = "subject_key"):
    """Query that scores the subjects touched by each batch over their whole history, and keeps history and scores by batch.

    Both tables have a folder ``batch=<id>`` for each batch of this query (the history before it goes to ``batch=-1``, see ``start_history``), and a batch
    overwrites its own folders only. A batch that Spark repeats after a failure therefore leaves what it left the first time: it
    sees the history up to itself, whatever came later. ``latest_scores`` reads the newest scores.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{history_path}/batch={batch_id}")
        history = spark.read.schema(df.schema.add("batch", "long")).parquet(history_path).where(F.col("batch") <= batch_id)
        touched = history.where(F.col("batch") == batch_id).select(key).distinct()
        scored = score(history.drop("batch").join(touched, key, "left_semi"))
        scored.write.mode("overwrite").parquet(f"{scores_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_history(rows: DataFrame, history_path: str) -> None:
    """Rows that were there before the stream."""
    rows.write.mode("overwrite").parquet(f"{history_path}/batch=-1")


def latest_scores(spark: SparkSession, scores_path: str, key: str = "subject_key") -> DataFrame:
    """Scores of each subject from the newest batch that touched it."""
    scores = spark.read.parquet(scores_path)
    newest = scores.groupBy(key).agg(F.max("batch").alias("batch"))
    return scores.join(newest, [key, "batch"], "left_semi").drop("batch")


CHANGES = "issuer string, owner string, period string, filing_id long, change int"


class SupersedeProcessor(StatefulProcessor):
    """State of one (issuer, owner, period): the newest amendment, and the filings not older than it that the watermark has not left behind."""

    def __init__(self, horizon_ms: int):
        self.horizon = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "day string, id long")
        self.live = handle.getMapState("live", "id long", "day string, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        newest, out = self.newest.get() if self.newest.exists() else None, []
        for pdf in rows:
            for day, filing_id, amends, at in sorted(zip(pdf["filing_date"], pdf["filing_id"], pdf["is_amendment"], pdf["filed_at"], strict=True)):
                own = (day, int(filing_id))
                if newest and own < newest or self.live.containsKey((own[1],)):
                    continue
                if amends:
                    newest = own
                    self.newest.update(own)
                    for (other,), (other_day, _) in list(self.live.iterator()):
                        if (other_day, other) < own:
                            self.live.removeKey((other,))
                            out.append((other, -1))
                until = int(at.value // 1_000_000) + self.horizon
                self.live.updateValue((own[1],), (day, until))
                self.handle.registerTimer(until)
                out.append((own[1], 1))
        if out:
            yield pd.DataFrame([(*key, i, c) for i, c in out], columns=["issuer", "owner", "period", "filing_id", "change"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for (filing_id,), (_, until) in list(self.live.iterator()):
            if until <= now:
                self.live.removeKey((filing_id,))
        return iter(())

    def close(self) -> None:
        pass


def stream_supersede(filings: DataFrame, delay: str = "10 days", horizon: str = "3650 days") -> DataFrame:
    """Changes (+1 a filing stands, -1 it is retracted) as filings and their amendments arrive, with state that ends.

    ``filings``: issuer, owner, period, filing_id, filing_date, is_amendment. State is kept per (issuer, owner, period) in the state store: the newest
    amendment as a value, the filings that stand as map entries. A filing behind a newer amendment has no row, nor has a repeated one. Filings dated
    more than ``delay`` before the newest date seen are late and dropped. When the watermark has passed a filing's date by ``horizon`` a timer drops its entry: it
    stands for good, and what amends it later no longer retracts it. Needs the RocksDB state store.
    """
    date = F.col("filing_date").cast("string")
    rows = filings.select("issuer", "owner", "period", F.col("filing_id").cast("long").alias("filing_id"), date.alias("filing_date"), F.coalesce("is_amendment", F.lit(False)).alias("is_amendment"), F.to_timestamp("filing_date").alias("filed_at"))
    rows = rows.where("filing_id is not null and filed_at is not null").withWatermark("filed_at", delay)
    processor = SupersedeProcessor(int(milliseconds(horizon)))
    return rows.groupBy("issuer", "owner", "period").transformWithStateInPandas(processor, CHANGES, "Append", "EventTime")


def milliseconds(text: str) -> float:
    """Milliseconds of a length of time such as ``10 days``."""
    import pandas as pd

    return pd.Timedelta(text).total_seconds() * 1000


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def standing(changes: DataFrame) -> DataFrame:
    """Filings that stand after all changes."""
    return changes.groupBy("issuer", "owner", "period", "filing_id").agg(F.sum("change").alias("n")).where("n > 0").drop("n")


def touched_since(filings: DataFrame, since: Column) -> DataFrame:
    return filings.where(F.col("parsed_at") >= since).select("subject_key").distinct()
