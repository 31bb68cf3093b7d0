"""Column functions for amounts, dates, weights and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelens.functions.config import V2, Config
from tradelens.functions.text import literal_map


def pct_holdings(shares: Column, after: Column) -> Column:
    """Shares over holdings before and after; null without a positive base."""
    return F.when((shares > 0) & (after + shares > 0), shares / (after + shares))


def size_signal(pct: Column) -> Column:
    return F.when(pct.isNull(), 0.6).when(pct <= 0.01, 0.5).when(pct <= 0.05, 0.8).when(pct <= 0.20, 1.0).otherwise(1.2)


def days_before(date: Column, reference: Column) -> Column:
    """Days from the date to the reference, at least 0; null without a date."""
    return F.when(date.isNotNull(), F.greatest(F.lit(0), F.datediff(reference, date)))


def recency(date: Column, reference: Column, cfg: Config = V2) -> Column:
    return F.when(date.isNull(), 0.5).otherwise(F.exp(-cfg.decay * days_before(date, reference) / cfg.insider_half_life))


def insider_txn_score(code: Column, role: Column, planned: Column, ownership: Column, pct: Column, date: Column, reference: Column, cfg: Config = V2, regime: Column | None = None) -> Column:
    side = F.when(code == "P", cfg.buy_weight).when(code == "S", cfg.sell_weight).otherwise(0.0)
    weight = F.coalesce(F.element_at(literal_map(cfg.role_weight), role), F.lit(0.0))
    factor = side * weight * F.when(planned, cfg.planned_discount).otherwise(1.0) * size_signal(pct) * F.when(ownership == "D", 1.0).otherwise(cfg.indirect_weight) * recency(date, reference, cfg)
    return factor if regime is None else factor * regime


def insider_rank(role: Column, planned: Column, ownership: Column, pct: Column, date: Column, reference: Column) -> Column:
    """struct(rank, factors, missing) of the additive scale with a maximum of 9."""
    days = days_before(date, reference)
    share = F.format_string("%.1f%%", pct * 100)
    parts = [
        (F.lit(True), F.when(role.isin("ceo", "cfo"), 3).when(role.isin("chair", "president", "coo"), 2).otherwise(1),
         F.when(role.isin("ceo", "cfo"), F.concat(F.lit("C-suite ("), F.upper(role), F.lit(") purchase (+3)"))).when(role.isin("chair", "president", "coo"), F.concat(F.initcap(role), F.lit(" purchase (+2)"))).otherwise("Officer purchase (+1)"), F.lit(None).cast("string")),
        (~planned, F.lit(2), F.lit("Discretionary, not 10b5-1 (+2)"), F.lit("10b5-1 planned trade (0)")),
        (ownership == "D", F.lit(2), F.lit("Direct ownership (+2)"), F.lit("Indirect ownership (0)")),
        (F.coalesce(pct > 0.05, F.lit(False)), F.lit(1), F.concat(F.lit("Material size: "), share, F.lit(" of holdings (+1)")), F.when(F.coalesce(pct, F.lit(0.0)) != 0, F.concat(F.lit("Size: "), share, F.lit(" of holdings"))).otherwise("Size unknown")),
        (F.coalesce(days < 14, F.lit(False)), F.lit(1), F.concat(F.lit("Very recent: "), days.cast("string"), F.lit("d ago (+1)")), F.when(date.isNull(), "Date unknown").otherwise(F.concat(days.cast("string"), F.lit("d ago (not within 14d)")))),
    ]
    rank = sum((F.when(ok, points).otherwise(0) for ok, points, _, _ in parts), F.lit(0))
    keep = lambda a: F.filter(a, lambda x: x.isNotNull())
    return F.struct(rank.alias("rank"), keep(F.array(*[F.when(ok, text) for ok, _, text, _ in parts])).alias("factors"), keep(F.array(*[F.when(~ok, text) for ok, _, _, text in parts])).alias("missing"))


def amount_estimate(low: Column, high: Column, method: str = "geometric_mean") -> Column:
    """Estimate within a range; 0 without positive bounds."""
    value = {
        "lower_bound": low, "midpoint": (low + high) / 2, "geometric_mean": F.sqrt(low * high),
        "log_uniform": F.when(low == high, low).otherwise((high - low) / (F.ln(high) - F.ln(low))),
    }[method]
    return F.when((low > 0) & (high > 0), value.cast("double")).otherwise(0.0)


def staleness(date: Column, reference: Column, cfg: Config = V2) -> Column:
    lag = F.datediff(reference, date)
    if cfg.staleness == "steps":
        return F.when(date.isNull(), 0.2).when(lag <= 45, 1.0).when(lag <= 60, 0.9).when(lag <= 90, 0.7).when(lag <= 180, 0.4).otherwise(0.2)
    return F.when(date.isNull(), 0.5).when(lag < 0, 0.9).otherwise(F.exp(-cfg.decay * lag / cfg.legislator_half_life))


def disclosure_lag_weight(date: Column, disclosed: Column) -> Column:
    lag = F.datediff(disclosed, date)
    return F.when(lag.isNull(), 0.7).when(lag <= 30, 1.0).when(lag <= 60, 0.85).when(lag <= 120, 0.6).otherwise(0.3)


def owner_weight(owner: Column, cfg: Config = V2) -> Column:
    return F.coalesce(F.element_at(literal_map(cfg.owner_weight), owner), F.lit(cfg.owner_default))


def legislator_txn_score(action: Column, low: Column, high: Column, owner: Column, date: Column, disclosed: Column, reference: Column, confidence: Column, relevance: Column, cfg: Config = V2, regime: float = 1.0, log_scale: bool = False, method: str = "geometric_mean") -> Column:
    """struct(base, stale, raw, final) of a legislator's trade."""
    base = amount_estimate(low, high, method)
    base = F.ln(1 + base) if log_scale else base
    side = F.when(action == "purchase", 1.0).when(action.isin("sale", "sale_partial"), -1.0).otherwise(0.0)
    stale = staleness(date, reference, cfg)
    raw = base * side * stale * owner_weight(owner, cfg)
    final = raw * confidence * relevance * disclosure_lag_weight(date, disclosed) * regime
    return F.struct(base.alias("base"), stale.alias("stale"), raw.alias("raw"), final.alias("final"))


def is_discretionary(code: Column, planned: Column) -> Column:
    """An open-market purchase or sale that was not planned."""
    return F.coalesce(code.isin("P", "S"), F.lit(False)) & ~F.coalesce(planned, F.lit(False))


def insider_label(score: Column, confidence: Column) -> Column:
    return F.when(confidence < 0.25, "insufficient").when(score > 0.15, "bullish").when(score < -0.15, "bearish").otherwise("neutral")


def legislator_label(score: Column, confidence: Column, count: Column) -> Column:
    return F.when((confidence < 0.25) | (count < 2), "insufficient").when(score > 0.05, "bullish").when(score < -0.05, "bearish").otherwise("neutral")


def confidence_tier(confidence: Column) -> Column:
    return F.when(confidence < 0.25, "insufficient").when(confidence < 0.5, "low").when(confidence < 0.75, "moderate").otherwise("high")


def insider_confidence(trades: Column, insiders: Column, both_sides: Column | None = None, cfg: Config = V2) -> Column:
    import math

    value = F.least(F.lit(1.0), F.log1p(trades) / math.log(11)) * 0.4 + F.least(F.lit(1.0), F.log1p(insiders) / math.log(6)) * 0.6
    if both_sides is not None and cfg.both_sides_boost != 1.0:
        value = value * F.when(both_sides, cfg.both_sides_boost).otherwise(1.0)
    return F.when(trades == 0, 0.0).otherwise(F.least(F.lit(0.9), value))


def strength_tier(insider: Column, legislator: Column, magnitude: Column) -> Column:
    return F.when((insider >= 0.7) & (legislator >= 0.7) & (magnitude > 0.3), "strong").when((insider >= 0.4) & (legislator >= 0.4), "moderate").otherwise("weak")


def regime_of(change: Column) -> Column:
    """struct(regime, weight) of a benchmark's trailing return."""
    name = F.when(change.isNull(), "unknown").when(change <= -0.02, "bear").when(change >= 0.08, "bull").otherwise("neutral")
    return F.struct(name.alias("regime"), F.when(name == "bear", 1.1).when(name == "bull", 0.95).otherwise(1.0).alias("weight"))


def sweep_values(start: float, end: float, steps: int) -> Column:
    """Array of evenly spaced values, at least two."""
    n = max(2, steps)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(start) + i * ((end - start) / (n - 1)))


def date_spine(start: Column, end: Column, interval: str = "monthly") -> Column:
    """Array of first days of months, or of every 14th day, up to the end."""
    if interval == "monthly":
        return F.filter(F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month")), lambda d: d >= F.trunc(start, "month"))
    return F.sequence(start, end, F.expr("interval 14 days"))
