"""Alerts and summaries of a reference day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cluster_buys(trades: DataFrame, reference: Column, days: int = 30, least: int = 2) -> DataFrame:
    """Tickers that at least ``least`` insiders bought in the last ``days``."""
    own = trades.where((F.col("direction") == "BUY") & F.col("included") & (F.col("execution_date") >= F.date_sub(reference, days)) & (F.col("execution_date") <= reference))
    agg = own.groupBy("ticker").agg(
        F.count_distinct("actor_id").alias("actors"), F.array_join(F.array_sort(F.collect_set(F.col("actor_id").cast("string"))), ",").alias("actor_list"),
        F.count("*").alias("trades"), F.sum("value").alias("total_value"), F.min("execution_date").alias("first_date"), F.max("execution_date").alias("last_date"),
    )
    return agg.where(F.col("actors") >= least)


def anomalous_buying(trades: DataFrame, reference: Column, days: int = 30) -> DataFrame:
    """Tickers with recent buys and no history, or more than twice the monthly mean of the year before."""
    d = F.col("execution_date")
    recent = (d >= F.date_sub(reference, days)) & (d <= reference)
    history = (d >= F.date_sub(reference, 360)) & (d < F.date_sub(reference, days))
    agg = trades.where((F.col("direction") == "BUY") & F.col("included")).groupBy("ticker").agg(F.count_if(recent).alias("recent_buys"), F.count_if(history).alias("history_buys"), F.max(F.when(history, d)).alias("last_buy"))
    monthly = F.col("history_buys") / 12
    kind = F.when(F.col("history_buys") == 0, "first_buy_in_period").when(F.col("recent_buys") > monthly * 2 * (days / 30), "elevated_activity")
    return agg.where("recent_buys > 0").withColumn("kind", kind).where("kind is not null").select("ticker", "kind", "recent_buys", monthly.alias("monthly_mean"), F.floor(F.datediff(reference, "last_buy") / 30).alias("months_since"))


def participation_index(trades: DataFrame, reference: Column, universe: int = 504, days: int = 90) -> DataFrame:
    """Distinct tickers bought in the window as a share of the universe, and the mean distinct tickers per month before it."""
    own = trades.where((F.col("direction") == "BUY") & F.col("included"))
    d = F.col("execution_date")
    now = own.where((d >= F.date_sub(reference, days)) & (d <= reference)).agg(F.count_distinct("ticker").alias("count"))
    monthly = own.where(d < F.date_sub(reference, days)).groupBy(F.trunc(d, "month").alias("m")).agg(F.count_distinct("ticker").alias("n")).agg(F.avg("n").alias("monthly"))
    return now.crossJoin(monthly).select("count", (F.col("count") / universe).alias("rate"), (F.col("monthly") * (days / 30) / universe).alias("historical_rate"))


def committee_trades(trades: DataFrame, members: DataFrame) -> DataFrame:
    """Included legislator trades in a sector of one of the filer's committees; ``members``: member_id, committee, sector."""
    return trades.where("included").join(members, (F.col("actor_id") == F.col("member_id")) & (trades.sector == members.sector), "inner").drop(members.sector)


def committee_rotation(matched: DataFrame, reference: Column) -> DataFrame:
    """Committees whose majority direction turned between days 31-180 and the last 30 days."""
    age = F.datediff(reference, "execution_date")
    recent, prior = (age >= 0) & (age <= 30), (age > 30) & (age <= 180)
    n = lambda when, side: F.count_if(when & (F.col("direction") == side))
    agg = matched.groupBy("committee").agg(n(recent, "BUY").alias("rb"), n(recent, "SELL").alias("rs"), n(prior, "BUY").alias("pb"), n(prior, "SELL").alias("ps"))
    side = lambda b, s: F.when(F.col(b) > F.col(s), "BUY").when(F.col(s) > F.col(b), "SELL")
    out = agg.withColumn("prior_direction", side("pb", "ps")).withColumn("recent_direction", side("rb", "rs"))
    return out.where("prior_direction <> recent_direction").select("committee", "prior_direction", "recent_direction", "rb", "rs", "pb", "ps")


def earnings_proximity(buys: DataFrame, calendar: DataFrame, reference: Column, days: int = 90, near: int = 30) -> DataFrame:
    """First buy per ticker of the last ``days`` that precedes an earnings date by at most ``near`` days."""
    own = buys.where((F.col("execution_date") >= F.date_sub(reference, days)) & (F.col("execution_date") <= reference))
    met = own.join(calendar, "ticker").withColumn("distance", F.datediff("earnings_date", "execution_date")).where((F.col("distance") > 0) & (F.col("distance") <= near))
    w = W.partitionBy("ticker").orderBy("execution_date", "actor_id", "record_id", "earnings_date")
    return met.withColumn("k", F.row_number().over(w)).where("k = 1").select("ticker", "actor_id", "execution_date", "earnings_date", "distance")


def strong_signals(results: DataFrame, confidence: float = 0.4, least: int = 2) -> DataFrame:
    """Best bullish result per ticker with enough confidence and included trades."""
    w = W.partitionBy("ticker").orderBy(F.desc("confidence"), F.desc("score"), "window_days")
    own = results.where((F.col("label") == "bullish") & (F.col("confidence") >= confidence) & (F.col("included_count") >= least))
    return own.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def latest_buy_per_ticker(trades: DataFrame) -> DataFrame:
    """Latest included buy of each ticker; ties go to the largest record id."""
    row = F.struct("record_id", "actor_id", "title", "ownership", "execution_date")
    best = F.max_by(row, F.struct("execution_date", "record_id"))
    return trades.where((F.col("direction") == "BUY") & F.col("included")).groupBy("ticker").agg(best.alias("r")).select("ticker", "r.*")


def sector_summary(results: DataFrame, top: int = 5) -> DataFrame:
    """Bullish and bearish counts, distinct tickers and the strongest tickers of each sector; ``results``: ticker, sector, label, score."""
    sector = F.coalesce("sector", F.lit("Unknown"))
    best = results.groupBy(sector.alias("sector"), "ticker").agg(F.max(F.abs("score")).alias("a"))
    ranked = best.withColumn("k", F.row_number().over(W.partitionBy("sector").orderBy(F.desc("a"), "ticker"))).where(F.col("k") <= top)
    leaders = ranked.groupBy("sector").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "ticker"))), lambda x: x["ticker"]), ",").alias("top_tickers"))
    counts = results.groupBy(sector.alias("sector")).agg(F.count_if(F.col("label") == "bullish").alias("bullish"), F.count_if(F.col("label") == "bearish").alias("bearish"), F.count_distinct("ticker").alias("tickers"))
    return counts.withColumn("net", F.col("bullish") - F.col("bearish")).join(leaders, "sector")
