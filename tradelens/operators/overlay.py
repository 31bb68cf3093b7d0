"""Overlay of insider and legislator signals: decisions, diagnostics and opportunities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.numeric import strength_tier


def latest_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row per key."""
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("_k = 1").drop("_k")


def combine_candidates(results: DataFrame, window: int) -> DataFrame:
    """Entity results of one window with a sufficient label and included input."""
    return results.where((F.col("scope") == "entity") & (F.col("lookback_window") == window) & (F.col("label") != "insufficient") & (F.col("input_count") > 0) & (F.col("included_count") > 0))


def overlay(insider: DataFrame, legislator: DataFrame, events: DataFrame, threshold: float = 0.8, conflict: float = 0.5) -> DataFrame:
    """Decision per legislator subject.

    ``insider``, ``legislator``: subject_key, label, score, confidence, event_id (may be null). ``events``: event_id,
    status, entity_key, instrument_key, resolution_confidence. Without an event id, an ``entity:`` key counts as resolved
    with confidence 1. Subjects that only insiders have are not emitted.
    """

    def with_event(df: DataFrame, side: str) -> DataFrame:
        e = events.select(*[F.col(c).alias(f"{side}_{c}") for c in ("event_id", "status", "entity_key", "instrument_key", "resolution_confidence")], F.lit(True).alias(f"{side}_found"))
        df = df.select("subject_key", *[F.col(c).alias(f"{side}_{c}") for c in ("label", "score", "confidence", "event_id")]).join(e, f"{side}_event_id", "left")
        own = F.col(f"{side}_event_id").isNull() & F.startswith("subject_key", F.lit("entity:"))
        return (
            df.withColumn(f"{side}_found", F.coalesce(f"{side}_found", own))
            .withColumn(f"{side}_status", F.when(own, "RESOLVED").otherwise(F.col(f"{side}_status")))
            .withColumn(f"{side}_entity_key", F.when(own, F.col("subject_key")).otherwise(F.col(f"{side}_entity_key")))
            .withColumn(f"{side}_resolution_confidence", F.when(own, 1.0).otherwise(F.col(f"{side}_resolution_confidence")))
        )

    both = with_event(legislator, "l").join(with_event(insider, "i"), "subject_key", "left")
    least = F.least("i_resolution_confidence", "l_resolution_confidence")
    signal = F.least("i_confidence", "l_confidence")
    resolved = (F.col("i_status") == "RESOLVED") & (F.col("l_status") == "RESOLVED")
    mismatch = (F.coalesce("i_instrument_key", F.lit("")) != "") & (F.coalesce("l_instrument_key", F.lit("")) != "") & (F.col("i_instrument_key") != F.col("l_instrument_key"))
    same = F.col("i_label") == F.col("l_label")
    strong = signal >= conflict

    def out(outcome: str, reason: str | None = None, score: Column | None = None) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), F.lit(reason).cast("string").alias("reason"), (score if score is not None else F.lit(0.0)).alias("conflict"))

    opposed = F.col("i_label").isin("bullish", "bearish") & F.col("l_label").isin("bullish", "bearish") & ~same
    decision = (
        F.when(~F.col("l_found"), out("BLOCKED_AMBIGUOUS", "AMBIGUOUS_ENTITY_MATCH"))
        .when(F.col("i_label").isNull() | ~F.coalesce("i_found", F.lit(False)), out("SINGLE_SOURCE_ONLY", "MISSING_COUNTERPART"))
        .when(~resolved, out("BLOCKED_AMBIGUOUS", "AMBIGUOUS_ENTITY_MATCH"))
        .when(~F.equal_null("i_entity_key", "l_entity_key"), out("BLOCKED_AMBIGUOUS", "AMBIGUOUS_ENTITY_MATCH"))
        .when(mismatch, out("BLOCKED_INSTRUMENT_MISMATCH", "INSTRUMENT_MISMATCH"))
        .when(least < threshold, out("BLOCKED_LOW_CONFIDENCE", "LOW_RESOLUTION_CONFIDENCE"))
        .when(same & (F.col("l_label") == "bullish") & strong, out("ALIGNED_BULLISH"))
        .when(same & (F.col("l_label") == "bearish") & strong, out("ALIGNED_BEARISH"))
        .when(opposed & strong, out("TRUE_CONFLICT", None, F.least(F.lit(1.0), F.abs(F.col("i_score") - F.col("l_score")) / 2 * signal)))
        .otherwise(out("LOW_CONFIDENCE_ALIGNMENT"))
    )
    both = both.withColumn("d", decision).withColumn("eligible", F.col("d.reason").isNull())
    score = (F.col("i_score") + F.col("l_score")) / 2
    label = F.when(F.col("d.outcome") == "ALIGNED_BULLISH", "bullish").when(F.col("d.outcome") == "ALIGNED_BEARISH", "bearish").otherwise("mixed")
    yes = lambda c: F.when(F.col("eligible"), c)
    return both.select(
        "subject_key", "eligible", F.col("d.outcome").alias("outcome"), F.col("d.reason").alias("reason_code"), F.col("d.conflict").alias("conflict_score"),
        yes(score).alias("score"), yes(label).alias("label"), yes(least).alias("confidence"), yes(strength_tier(F.col("i_confidence"), F.col("l_confidence"), F.abs(score))).alias("strength_tier"),
        F.col("i_score").alias("insider_score"), F.col("l_score").alias("legislator_score"),
    )


def overlap_diagnostics(insider: DataFrame, legislator: DataFrame) -> DataFrame:
    """Counts of candidate subjects on both sides and on one side only: part, subjects, sample (20 smallest)."""
    side = insider.select("subject_key").distinct().withColumn("i", F.lit(1)).join(legislator.select("subject_key").distinct().withColumn("l", F.lit(1)), "subject_key", "full_outer")
    part = F.when(F.col("i").isNull(), "legislator_only").when(F.col("l").isNull(), "insider_only").otherwise("overlap")
    ranked = side.withColumn("part", part).withColumn("k", F.row_number().over(W.partitionBy("part").orderBy("subject_key")))
    return ranked.groupBy("part").agg(F.count("*").alias("subjects"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= 20, F.col("subject_key")))), ",").alias("sample"))


def overlap_opportunities(decisions: DataFrame, insider: DataFrame, legislator: DataFrame, limit: int = 20) -> DataFrame:
    """Subjects of both sides by bucket: conflict, low confidence, aligned, blocked ambiguous, insufficient or neutral; at most ``limit`` per bucket."""
    both = insider.select("subject_key", F.col("label").alias("i_label")).join(legislator.select("subject_key", F.col("label").alias("l_label")), "subject_key")
    d = decisions.select("subject_key", "outcome", "eligible")
    either = lambda value: (F.col("i_label") == value) | (F.col("l_label") == value)
    bucket = (
        F.when(F.col("eligible") & (F.col("outcome") == "TRUE_CONFLICT"), "conflict").when(F.col("eligible") & F.startswith("outcome", F.lit("ALIGNED")), "aligned").when(F.col("eligible"), "low_confidence")
        .when(F.col("outcome") == "BLOCKED_AMBIGUOUS", "blocked_ambiguous").when(either("insufficient"), "insufficient").when(either("neutral"), "neutral").otherwise("low_confidence")
    )
    found = both.join(d, "subject_key", "left").withColumn("bucket", bucket)
    return found.withColumn("place", F.row_number().over(W.partitionBy("bucket").orderBy("subject_key"))).where(F.col("place") <= limit).select("subject_key", "bucket", "place")
