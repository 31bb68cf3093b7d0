"""Forward returns, event studies and trailing regimes over daily closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.numeric import regime_of
from tradelens.operators.resolve import small


def asof_forward(probes: DataFrame, prices: DataFrame, key: str, date: str) -> DataFrame:
    """Adds found_date and found_close: the first close of the key on or after the probe's date.

    Each close stands for the days after the close before it, so the closes of a key become one row per day and the probes
    are joined by key and day; days before a key's first close take that one. The rows grow with keys and calendar days,
    not with probes, which are neither sorted nor shuffled while those rows are few.
    """
    own = prices.select(F.col(key).alias("_key"), F.col("date").alias("found_date"), F.col("close").alias("found_close")).where("_key is not null and found_date is not null")
    before = F.lag("found_date").over(W.partitionBy("_key").orderBy("found_date"))
    own = own.withColumn("_before", before).where("_before is null or _before < found_date")
    days = own.select("_key", "found_date", "found_close", F.explode(F.sequence(F.coalesce(F.date_add("_before", 1), "found_date"), "found_date")).alias("_day"))
    firsts = own.where("_before is null").select("_key", F.col("found_date").alias("_first"))
    at = probes.withColumns({"_key": F.col(key), "_at": F.col(date)}).join(small(firsts), "_key", "left")
    out = at.withColumn("_day", F.when(F.col("_at").isNotNull(), F.greatest("_at", "_first"))).join(small(days), ["_key", "_day"], "left")
    return out.select(*[F.col(f"`{c}`") for c in probes.columns], "found_date", "found_close")


def forward_returns(events: DataFrame, prices: DataFrame, days: list[int]) -> DataFrame:
    """Return of each event (ticker, event_date, further columns) over each horizon; null without both closes or with a base of 0."""
    base = asof_forward(events, prices, "ticker", "event_date").withColumnsRenamed({"found_date": "base_date", "found_close": "base_close"})
    probes = base.withColumn("forward_days", F.explode(F.array(*map(F.lit, days)))).withColumn("target", F.expr("date_add(event_date, forward_days)"))
    out = asof_forward(probes, prices, "ticker", "target")
    return out.withColumn("forward_return", F.when(F.col("base_close") > 0, (F.col("found_close") - F.col("base_close")) / F.col("base_close"))).drop("found_date", "found_close", "target")


def price_returns(prices: DataFrame, days: int) -> DataFrame:
    """For every close the return to the first one at least ``days`` later: ticker, date, forward_return."""
    probes = prices.select("ticker", "date", F.col("close").alias("base"), F.date_add("date", days).alias("target"))
    found = asof_forward(probes, prices, "ticker", "target")
    return found.select("ticker", "date", ((F.col("found_close") - F.col("base")) / F.col("base")).alias("forward_return")).where("forward_return is not null")


def trailing_regime(dates: DataFrame, benchmark: DataFrame, days: int = 61) -> DataFrame:
    """Regime of each reference_date from the benchmark's first and last close in the window before it."""
    months = F.sequence(F.trunc(F.date_sub("reference_date", days), "month"), F.trunc(F.date_sub("reference_date", 1), "month"), F.expr("interval 1 month"))
    asked = dates.select("reference_date").distinct().withColumn("month", F.explode(months))
    met = asked.join(benchmark.select("date", "close", F.trunc("date", "month").alias("month")), "month", "left")
    inside = (F.col("date") >= F.date_sub("reference_date", days)) & (F.col("date") <= F.date_sub("reference_date", 1))
    at, value = F.when(inside, F.col("date")), F.when(inside, F.col("close"))
    agg = met.groupBy("reference_date").agg(F.count(at).alias("n"), F.min_by(value, at).alias("a"), F.max_by(value, at).alias("b"))
    change = F.when(F.col("n") >= 2, (F.col("b") - F.col("a")) / F.col("a"))
    return agg.select("reference_date", change.alias("change"), regime_of(change).alias("r")).select("reference_date", "change", "r.regime", "r.weight")


def directional_study(returns: DataFrame, groups: list[list[str]], up: Column) -> DataFrame:
    """Accuracy and mean return per horizon and grouping: ``groups`` are sets of columns; columns outside a set are null."""
    known = returns.where("forward_return is not null").withColumn("hit", F.when(up, F.col("forward_return") > 0).otherwise(F.col("forward_return") < 0))
    names = sorted({c for g in groups for c in g})
    sets = [[F.col(c) for c in ["forward_days", *g]] for g in groups]
    agg = known.groupingSets(sets, *[F.col(c) for c in ["forward_days", *names]]).agg(F.count("*").alias("n"), F.avg(F.col("hit").cast("double")).alias("accuracy"), F.avg("forward_return").alias("mean_return"))
    return agg


def pearson(df: DataFrame, keys: list[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Correlation per key; null under ``least`` points or without variance."""
    ok = (F.count("*") >= least) & (F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0)
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.when(ok, F.corr(x, y)).alias("correlation"))
