"""Streams: restarts, repeated batches, late rows, state that ends."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tradelens.operators.resolve import supersede_amendments
from tradelens.streaming import streams


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def run(stream, out, checkpoint):
    q = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet")
    q.awaitTermination()
    return q


def test_repeated_batch_of_rescoring_changes_nothing(spark, tmp_path):
    landed, history, scores, checkpoint = (str(tmp_path / n) for n in ("landed", "history", "scores", "checkpoint"))
    schema = "subject_key string, value long"
    streams.start_history(spark.createDataFrame([("a", 1), ("b", 10), ("c", 100)], schema), history)
    batches = [[("a", 2)], [("b", 20), ("a", 3)], [("d", 5), ("a", 4)]]
    score = lambda df: df.groupBy("subject_key").agg(F.sum("value").alias("score"), F.count("*").alias("n"))
    start = lambda: streams.rescore_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed), history, scores, score, checkpoint).awaitTermination()
    for rows in batches:
        land(spark.createDataFrame(rows, schema), landed)
        start()
    want = {("a", 10, 4), ("b", 30, 2), ("d", 5, 1)}
    assert {tuple(r) for r in streams.latest_scores(spark, scores).select("subject_key", "score", "n").collect()} == want
    # as after a failure between the sink and the commit of the last batch
    last = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    start()
    assert {tuple(r) for r in streams.latest_scores(spark, scores).select("subject_key", "score", "n").collect()} == want
    assert spark.read.parquet(history).count() == 8


def test_changed_filings_pass_once_over_restarts(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    schema = "filing_id long, content string, at timestamp"
    day = lambda d: dt.datetime(2024, 1, d)
    known = spark.createDataFrame([(1, "old")], "filing_id long, content string").select("filing_id", F.sha2("content", 256).alias("hash"))
    for rows in ([(1, "old", day(1)), (1, "new", day(1)), (2, "x", day(1))], [(1, "new", day(2)), (2, "x", day(2)), (2, "y", day(2))], [(3, "z", day(20))], [(4, "late", day(1)), (2, "x", day(20))]):
        land(spark.createDataFrame(rows, schema), landed)
        run(streams.stream_changed_only(spark.readStream.schema(schema).parquet(landed), "at", known, "7 days").select("filing_id", "content"), out, checkpoint)
    # 2 "x" comes again after its state has ended; 4 is behind the watermark
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [(1, "new"), (2, "x"), (2, "x"), (2, "y"), (3, "z")]


def test_cluster_windows_count_late_rows_within_the_delay_and_end(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    schema = "ticker string, actor_id long, value double, at timestamp"
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    state = []
    for rows in ([("T", 1, 1.0, day(0)), ("T", 1, 2.0, day(0)), ("U", 9, 1.0, day(0))], [("T", 3, 1.0, day(5))], [("T", 2, 4.0, day(0))], [(None, None, None, day(12))], [("T", 4, 8.0, day(0))], [(None, None, None, day(60))]):
        land(spark.createDataFrame(rows, schema), landed)
        windows = streams.cluster_buy_windows(spark.readStream.schema(schema).parquet(landed), "at", 1, 1, "10 days")
        state.append(sum(o["numRowsTotal"] for o in run(windows, out, checkpoint).lastProgress["stateOperators"]))
    got = [(r.window_start, r.ticker, r.actors, r.trades, r.total_value) for r in spark.read.parquet(out).collect()]
    assert got == [(day(0), "T", 2, 3, 7.0)]
    # what is left is the last row that moved the watermark
    assert max(state) > 2 and state[-1] == 1


def test_superseded_filings_equal_the_batch_and_state_ends(spark, tmp_path):
    schema = "issuer string, owner string, period string, filing_id long, filing_date string, is_amendment boolean"
    rows = [("i", "o", "p", k, f"2024-01-{d:02d}", a) for k, d, a in [(1, 1, False), (2, 3, False), (3, 2, True), (4, 5, True), (5, 5, False), (6, 4, False), (7, 6, None), (8, 6, True)]]
    rows += [("i", "o2", "p", 9, "2024-01-02", False), (None, "o", "p", 10, "2024-01-02", True), (None, "o", "p", 11, "2024-01-01", False)]
    filings = spark.createDataFrame(rows, schema)

    def streamed(name, parts, **options):
        landed, out, checkpoint = (str(tmp_path / f"{name}-{n}") for n in ("landed", "out", "checkpoint"))
        progress = None
        for part in parts:
            land(spark.createDataFrame(part, schema), landed)
            with streams.rocksdb(spark):
                progress = run(streams.stream_supersede(spark.readStream.schema(schema).parquet(landed), **options), out, checkpoint).lastProgress
        return sorted((r.issuer or "", r.owner, r.filing_id) for r in streams.standing(spark.read.parquet(out)).collect()), progress

    want = sorted((r.issuer or "", r.owner, r.filing_id) for r in supersede_amendments(filings.withColumn("is_amendment", F.coalesce("is_amendment", F.lit(False)))).collect())
    got, _ = streamed("all", [rows[::2], rows[1::2], rows[:3]], delay="60 days")
    assert got == want
    # the first filing has left the state when its amendment comes: it stands for good; a filing behind the watermark is dropped
    parts = [[("i", "o", "p", 1, "2024-01-01", False)], [("x", "y", "z", 2, "2024-03-01", False)], [("i", "o", "p", 3, "2024-03-01", True), ("i", "o", "p", 4, "2024-01-05", True)]]
    got, _ = streamed("short", parts, delay="10 days", horizon="5 days")
    assert got == [("i", "o", 1), ("i", "o", 3), ("x", "y", 2)]
