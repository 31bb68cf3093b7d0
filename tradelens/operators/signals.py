"""Scores of trades and signals of companies, members, sectors and the market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions import numeric as N
from tradelens.functions.config import V2, Config
from tradelens.sinks import staged


def insider_company_signal(scored: DataFrame, reference: Column, cfg: Config = V2, strict: bool = False) -> DataFrame:
    """Signal per subject and lookback window from scored insider trades.

    ``scored``: subject_key, actor_id, execution_date, included (boolean), direction_weight, signal. Every
    subject gets a row per window. A lone insider is not capped, others at the share of what the rest carry.
    Windows have no upper bound unless ``strict``. Sums per insider are staged: made twice, by trades in another order, a lone
    insider's could differ in the last bit from the total, which would leave a rest that is not there and cap the insider at it.
    """
    windows = F.explode(F.array(*map(F.lit, cfg.windows))).alias("window_days")
    frame = scored.select("subject_key").distinct().select("subject_key", windows)
    trades = scored.where("included").select("subject_key", "actor_id", "execution_date", "direction_weight", "signal", windows)
    inside = F.col("execution_date") >= F.date_sub(reference, F.col("window_days"))
    inside = inside & (F.col("execution_date") <= reference) if strict else inside
    buy, sell = F.col("direction_weight") > 0, F.col("direction_weight") < 0
    by_insider = trades.where(inside).groupBy("subject_key", "window_days", "actor_id").agg(F.sum("signal").alias("s"), F.count("*").alias("n"), F.count_if(buy).alias("buys"), F.count_if(sell).alias("sells"))
    by_insider = staged(by_insider, "insiders")
    key = ["subject_key", "window_days"]
    totals = by_insider.groupBy(*key).agg(F.sum(F.abs("s")).alias("total"))
    others = F.col("total") - F.abs("s")
    limit = F.when(others <= 0, F.abs("s")).otherwise(others * (cfg.saturation / (1 - cfg.saturation)))
    capped = F.when(F.abs("s") > limit, F.signum("s") * limit).otherwise(F.col("s"))
    joined = by_insider.join(totals, key).withColumn("capped", capped)
    agg = joined.groupBy(*key).agg(
        F.sum("capped").alias("capped"), F.count("*").alias("insiders"), F.sum("n").alias("n"), F.sum("buys").alias("buy_count"), F.sum("sells").alias("sell_count"),
        F.count_if(F.col("buys") > 0).alias("unique_buyers"), F.count_if(F.col("sells") > 0).alias("unique_sellers"), F.max_by(F.struct("actor_id", "capped"), F.struct(F.abs("capped"), -F.col("actor_id"))).alias("top"),
    )
    flat = F.tanh(F.col("capped") / F.col("insiders"))
    lifted = F.tanh(F.atanh(F.greatest(F.lit(-0.999), F.least(F.lit(0.999), flat))) * (1 + cfg.conviction * (F.col("unique_buyers") - 1)))
    score = F.when((F.col("unique_buyers") >= 2) & (flat != 0), lifted).otherwise(flat)
    confidence = N.insider_confidence(F.col("n"), F.col("insiders"), (F.col("buy_count") > 0) & (F.col("sell_count") > 0), cfg)
    enough = F.coalesce(F.col("n"), F.lit(0)) >= 2
    out = frame.join(agg, key, "left").withColumn("score0", score).withColumn("conf0", confidence)
    zero = lambda c: F.when(enough, c).otherwise(0)
    return out.select(
        *key, F.when(enough, N.insider_label(F.col("score0"), F.col("conf0"))).otherwise("insufficient").alias("label"), F.round(F.when(enough, F.col("score0")).otherwise(0.0), 4).alias("score"),
        F.round(F.when(enough, F.col("conf0")).otherwise(0.0), 4).alias("confidence"), F.when(enough, N.confidence_tier(F.col("conf0"))).otherwise("insufficient").alias("confidence_tier"),
        *[zero(F.col(c)).cast("long").alias(c) for c in ("buy_count", "sell_count", "unique_buyers", "unique_sellers")],
        F.coalesce("n", F.lit(0)).cast("long").alias("trade_count"),
    )


def winsorize(scored: DataFrame, keys: list[str], percentile: float = 0.95, column: str = "final", order: str = "record_id") -> DataFrame:
    """Clip the absolute score at the non-zero one with index floor(n * p) in ascending order, per key; signs stay.

    Scores are counted in buckets of their logarithm first; only the bucket that the threshold lies in is ranked, so a key
    with a large share of all rows is not sorted in one task. The scores are read three times, so they are staged once.
    """
    scored = staged(scored, "scored")
    rows = scored.where(F.col(column) != 0).select(*keys, F.abs(column).alias("a"), order).withColumn("bucket", F.floor(F.log("a") * 64))
    w = W.partitionBy(*keys)
    before = F.coalesce(F.sum("c").over(w.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy(*keys, "bucket").agg(F.count("*").alias("c")).withColumns({"total": F.sum("c").over(w), "before": before})
    at = F.least(F.floor(F.col("total") * percentile), F.col("total") - 1)
    target = sizes.withColumn("at", at).where("before <= at and at < before + c").select(*keys, "bucket", (F.col("at") - F.col("before")).alias("offset"))
    ranked = rows.join(target, [*keys, "bucket"]).withColumn("k", F.row_number().over(w.orderBy("a", order)) - 1)
    cut = ranked.where("k = offset").select(*keys, F.col("a").alias("threshold"))
    out = scored.crossJoin(F.broadcast(cut)) if not keys else scored.join(cut, keys, "left")
    return out.withColumn(column, F.when(F.abs(column) > F.col("threshold"), F.signum(column) * F.col("threshold")).otherwise(F.col(column))).drop("threshold")


def net(c: str) -> Column:
    """Sum of ``c``, and 0 if it is within the rounding of a sum of its terms in any order: terms that cancel leave 0, not a residue with a sign."""
    total = F.sum(c)
    return F.when(F.abs(total) <= F.sum(F.abs(c)) * F.count(c) * 2.0**-52, 0.0).otherwise(total)


def cap_sweep(scored: DataFrame, caps: list[float], cfg: Config = V2) -> DataFrame:
    """``positioning`` of all trades under each member cap: cap and its fields. Trades are aggregated to members once; only those are copied per cap."""
    members = winsorize(scored, [], cfg.winsor).groupBy("member_id").agg(net("final").alias("m"), F.count("*").alias("n"), F.sum("stale").alias("stale"))
    return _positioning_of_members(members.withColumn("cap", F.explode(F.array(*map(F.lit, caps)))), ["cap"], F.col("cap"))


def positioning(scored: DataFrame, keys: list[str], cfg: Config = V2) -> DataFrame:
    """Member-capped aggregate per key of scored legislator trades (member_id, final, stale, record_id): the fields of the positioning table."""
    clipped = winsorize(scored, keys, cfg.winsor)
    members = clipped.groupBy(*keys, "member_id").agg(net("final").alias("m"), F.count("*").alias("n"), F.sum("stale").alias("stale"))
    return _positioning_of_members(members, keys, cfg.member_cap)


def _positioning_of_members(members: DataFrame, keys: list[str], cap) -> DataFrame:
    totals = members.groupBy(*keys).agg((F.sum(F.abs("m")) * cap).alias("limit"))
    capped = members.join(totals, keys)
    capped = capped.withColumn("c", F.when(F.abs("m") > F.col("limit"), F.signum("m") * F.col("limit")).otherwise(F.col("m")))
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(F.abs("c")), "member_id"))
    leading = capped.select(*keys, "member_id", "c").withColumn("place", place).where("place <= 5").groupBy(*keys).agg(F.sum(F.abs("c")).alias("top5"))
    agg = capped.groupBy(*keys).agg(
        F.count("*").alias("unique_members"), F.count_if(F.col("c") > 0).alias("buyers"), F.count_if(F.col("c") < 0).alias("sellers"), F.count_if(F.col("c") == 0).alias("neutral"),
        F.sum("c").alias("volume_net"), F.sum(F.when(F.col("c") > 0, F.col("c")).otherwise(0)).alias("volume_buy"), F.sum(F.when(F.col("c") < 0, -F.col("c")).otherwise(0)).alias("volume_sell"),
        F.sum(F.abs("c")).alias("total"), F.count_if(F.abs("m") > F.col("limit")).alias("members_capped"),
        (F.sum("stale") / F.sum("n")).alias("mean_staleness"), F.sum("n").alias("transactions"),
    ).join(leading, keys)
    concentration = F.when(F.col("total") > 0, F.col("top5") / F.col("total")).otherwise(0.0)
    return agg.withColumn("breadth", (F.col("buyers") - F.col("sellers")) / F.col("unique_members")).withColumn("concentration_top5", concentration).withColumn("is_concentrated", concentration > 0.5).drop("top5", "total")


def composite_confidence(agg: DataFrame, resolution_rate: Column, chamber_balance: Column) -> DataFrame:
    """Adds composite and tier to a positioning table."""
    composite = (
        F.least(F.lit(1.0), F.col("unique_members") / 50) * 0.25 + resolution_rate * 0.20 + F.col("mean_staleness") * 0.20 + (1 - F.col("concentration_top5")) * 0.15
        + F.least(F.lit(1.0), F.col("transactions") / 200) * 0.10 + (1 - F.abs(chamber_balance - 0.5) * 2) * 0.10
    )
    return agg.withColumn("composite", composite).withColumn("tier", F.when(F.col("composite") > 0.7, "HIGH").when(F.col("composite") > 0.4, "MODERATE").otherwise("LOW"))


def legislator_entity_signal(scored: DataFrame, keys: list[str], cfg: Config = V2) -> DataFrame:
    """Signal per subject: net over gross capped volume, with the composite confidence at a resolution rate of 1."""
    agg = composite_confidence(positioning(scored, keys, cfg), F.lit(1.0), F.lit(0.5))
    gross = F.col("volume_buy") + F.col("volume_sell")
    return agg.withColumn("score", F.when(gross > 0, F.col("volume_net") / gross).otherwise(0.0)).withColumn("label", N.legislator_label(F.col("score"), F.col("composite"), F.col("transactions")))


def market_positioning(trades: DataFrame, scored: DataFrame, minimum: int = 50, cfg: Config = V2) -> DataFrame:
    """One row for all included trades with the resolution rate of all; none below the minimum count."""
    rate = trades.agg((F.count_if("included") / F.count("*")).alias("resolution_rate"))
    agg = positioning(scored.withColumn("scope", F.lit("market")), ["scope"], cfg).crossJoin(F.broadcast(rate))
    return composite_confidence(agg, F.col("resolution_rate"), F.lit(0.5)).where(F.col("transactions") >= minimum)


def member_sector_exposure(memberships: DataFrame) -> DataFrame:
    """Exposure of members (member_id) to sectors from committee rows (member_id, committee, sector, is_primary), as a share of the member's largest."""
    weight = F.sum(F.when(F.col("is_primary"), 1.0).otherwise(0.5))
    own = memberships.groupBy("member_id", "sector").agg(weight.alias("w"), F.array_join(F.array_sort(F.collect_set("committee")), ",").alias("committees"))
    return own.select("member_id", "sector", F.round(F.col("w") / F.max("w").over(W.partitionBy("member_id")), 3).alias("exposure"), "committees")


def sector_positioning(scored: DataFrame, exposures: DataFrame) -> DataFrame:
    """Members' net scores spread over sectors in proportion to exposure, per sector."""
    nets = scored.groupBy("member_id").agg(net("final").alias("net"))
    share = F.col("exposure") / F.sum("exposure").over(W.partitionBy("member_id"))
    spread = nets.join(exposures, "member_id").withColumn("v", F.col("net") * share)
    agg = spread.groupBy("sector").agg(
        F.sum(F.when(F.col("v") > 0, F.col("v")).otherwise(0)).alias("buy_volume"), F.sum(F.when(F.col("v") < 0, -F.col("v")).otherwise(0)).alias("sell_volume"),
        F.count_distinct(F.when(F.col("v") > 0, F.col("member_id"))).alias("buyers"), F.count_distinct(F.when(F.col("v") < 0, F.col("member_id"))).alias("sellers"),
        F.count_distinct("member_id").alias("members"), F.sum("exposure").alias("exposure"),
    )
    return agg.withColumn("net_volume", F.col("buy_volume") - F.col("sell_volume")).withColumn("breadth", (F.col("buyers") - F.col("sellers")) / F.col("members"))
