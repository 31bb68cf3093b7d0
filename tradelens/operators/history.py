"""Stability, turnover and divergence of signals over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def label_stability(history: DataFrame) -> DataFrame:
    """Per ticker over ordered dates (ticker, as_of_date, label): dates present, share of active labels, flip rate over adjacent present dates, dominant label."""
    w = W.partitionBy("ticker").orderBy("as_of_date")
    flips = history.withColumn("before", F.lag("label").over(w))
    dates = history.agg(F.count_distinct("as_of_date").alias("dates"))
    active = F.col("label").isin("bullish", "bearish")
    agg = flips.groupBy("ticker").agg(F.count("*").alias("present"), F.count_if(active).alias("active"), F.count_if(F.col("before").isNotNull()).alias("pairs"), F.count_if(F.col("before") != F.col("label")).alias("flips"))
    counts = history.groupBy("ticker", "label").agg(F.count("*").alias("n"))
    dominant = counts.groupBy("ticker").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("dominant_label"))
    return agg.crossJoin(F.broadcast(dates)).join(dominant, "ticker").select("ticker", "present", (F.col("active") / F.col("dates")).alias("active_share"), F.when(F.col("pairs") > 0, F.col("flips") / F.col("pairs")).otherwise(0.0).alias("flip_rate"), "dominant_label")


def signal_turnover(history: DataFrame) -> DataFrame:
    """1 - intersection / union of (subject_key, label) pairs of adjacent dates: as_of_date, turnover; joined on the date's index, so a date's set is never gathered."""
    dates = history.select("as_of_date").distinct().withColumn("i", F.row_number().over(W.orderBy("as_of_date")))
    pairs = history.select("subject_key", "label", "as_of_date").distinct().join(F.broadcast(dates), "as_of_date")
    sizes = pairs.groupBy("i").agg(F.count("*").alias("n"))
    shared = pairs.select("subject_key", "label", "i").join(pairs.select("subject_key", "label", (F.col("i") + 1).alias("i")), ["subject_key", "label", "i"]).groupBy("i").agg(F.count("*").alias("both"))
    before = sizes.select((F.col("i") + 1).alias("i"), F.col("n").alias("m"))
    out = dates.join(sizes, "i").join(before, "i").join(shared, "i", "left").withColumn("both", F.coalesce("both", F.lit(0)))
    union = F.col("n") + F.col("m") - F.col("both")
    return out.select("as_of_date", F.round(F.when(union > 0, 1 - F.col("both") / union).otherwise(0.0), 4).alias("turnover"))


def divergence_periods(series: DataFrame, gap: float = 0.3) -> DataFrame:
    """Runs of dates (date, breadth, volume) whose signs oppose or that differ by more than ``gap``: start, end, days, max_gap, ongoing."""
    apart = (F.col("breadth") * F.col("volume") < 0) | (F.abs(F.col("breadth") - F.col("volume")) > gap)
    w = W.orderBy("date")
    rows = series.withColumn("apart", apart).withColumn("i", F.row_number().over(w)).withColumn("last", F.max("date").over(W.partitionBy()))
    runs = rows.where("apart").withColumn("island", F.col("i") - F.row_number().over(w))
    agg = runs.groupBy("island").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"), F.max(F.abs(F.col("breadth") - F.col("volume"))).alias("max_gap"), F.max("last").alias("last"))
    return agg.select("start_date", "end_date", F.datediff("end_date", "start_date").alias("days"), "max_gap", (F.col("end_date") == F.col("last")).alias("ongoing"))


def breadth_vs_volume(positions: DataFrame, flat: float = 0.1) -> DataFrame:
    """Compares breadth with net over gross volume of a positioning table: volume_share, both directions, diverging, gap."""
    gross = F.col("volume_buy") + F.col("volume_sell")
    share = F.when(gross > 0, F.col("volume_net") / gross).otherwise(0.0)
    side = lambda c: F.when(c > flat, "bullish").when(c < -flat, "bearish").otherwise("neutral")
    out = positions.withColumn("volume_share", share)
    out = out.withColumn("breadth_direction", side(F.col("breadth"))).withColumn("volume_direction", side(F.col("volume_share")))
    opposed = (F.col("breadth_direction") != F.col("volume_direction")) & (F.col("breadth_direction") != "neutral") & (F.col("volume_direction") != "neutral")
    gap = F.abs(F.col("breadth") - F.col("volume_share"))
    return out.withColumn("gap", gap).withColumn("diverging", opposed | (gap > 0.3))
