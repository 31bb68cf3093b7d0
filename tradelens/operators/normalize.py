"""Normalization and filters of trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.functions import numeric as N
from tradelens.functions import text as T
from tradelens.functions.config import V2, Config

MINIMUM_INSIDER = 10_000
MINIMUM_LEGISLATOR = 15_000


def normalize_insider(trades: DataFrame) -> DataFrame:
    """Adds role, included and reason_code to insider trades (title, actor_name, is_officer, is_director, is_ten_pct, is_other, code, value).

    Included are open-market trades of an included role with a value of at least the minimum. Other codes are
    not included; they get a reason code only where the role is excluded.
    """
    role = T.role_class(F.col("title"), F.col("actor_name"), *[F.coalesce(F.col(c), F.lit(False)) for c in ("is_officer", "is_director", "is_ten_pct", "is_other")])
    open_market = F.col("code").isin("P", "S")
    small = F.col("value").isNull() | (F.col("value") < MINIMUM_INSIDER)
    out = trades.withColumn("_r", role)
    reason = F.when(F.col("_r.reason").isNotNull(), "ENTITY_ROLE_EXCLUDED").when(open_market & small, "BELOW_MINIMUM_VALUE")
    included = open_market & F.col("_r.reason").isNull() & ~small
    return out.select(*trades.columns, F.col("_r.role").alias("role"), included.alias("included"), reason.alias("reason_code"), F.col("_r.reason").alias("reason_detail"))


def score_insider(normalized: DataFrame, reference: Column, cfg: Config = V2) -> DataFrame:
    """Adds pct, direction_weight and signal to normalized insider trades."""
    pct = N.pct_holdings(F.col("shares"), F.col("shares_after"))
    side = F.when(F.col("code") == "P", cfg.buy_weight).when(F.col("code") == "S", cfg.sell_weight).otherwise(0.0)
    signal = N.insider_txn_score(F.col("code"), F.col("role"), F.col("planned"), F.col("ownership"), pct, F.col("execution_date"), reference, cfg)
    return normalized.withColumns({"pct": pct, "direction_weight": side, "signal": signal})


def normalize_legislator(trades: DataFrame) -> DataFrame:
    """Adds included and reason_code to legislators' trades (action, ticker, low, high)."""
    reason = F.when(~F.col("action").isin("purchase", "sale", "sale_partial"), "NON_SIGNAL_ASSET").when(F.col("ticker").isNull(), "MISSING_TICKER").when(F.col("high") <= MINIMUM_LEGISLATOR, "BELOW_MINIMUM_VALUE")
    return trades.withColumn("reason_code", reason).withColumn("included", F.col("reason_code").isNull())


def score_legislator(normalized: DataFrame, reference: Column, cfg: Config = V2) -> DataFrame:
    """Included trades with member_id, stale and final; confidence .95, full relevance."""
    score = N.legislator_txn_score(F.col("action"), F.col("low"), F.col("high"), F.col("owner_type"), F.col("execution_date"), F.col("disclosure_date"), reference, F.lit(0.95), F.lit(1.0), cfg)
    return normalized.where("included").withColumn("_s", score).select("record_id", "ticker", "subject_key", "sector", "chamber", F.col("actor_id").alias("member_id"), "execution_date", F.col("_s.stale").alias("stale"), F.col("_s.final").alias("final"))


def in_window(df: DataFrame, reference: Column, days: int, strict: bool = False) -> DataFrame:
    """Rows from ``days`` before the reference on; with ``strict`` also none after it."""
    d = F.col("execution_date")
    ok = d >= F.date_sub(reference, days)
    return df.where(ok & (d <= reference) if strict else ok)


def inclusion_v1(df: DataFrame) -> DataFrame:
    """Adds the archive's inclusion reason: role, derivative, swap, code, exercise-and-sell, indirect entity, in that order.

    ``df``: role, is_derivative, equity_swap, code, exercise_and_sell, ownership, entity_owner.
    """
    reason = (
        F.when(F.col("role") == "excluded", "excluded_role").when(F.col("is_derivative"), "derivative").when(F.col("equity_swap"), "equity_swap").when(~F.col("code").isin("P", "S"), F.concat(F.lit("code:"), F.col("code")))
        .when(F.col("exercise_and_sell"), "exercise_and_sell").when((F.col("ownership") == "I") & F.col("entity_owner"), "indirect_entity")
    )
    return df.withColumn("reason", reason).withColumn("included", F.col("reason").isNull())


def search_results(results: DataFrame, label: str | None = None, min_confidence: float | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """Results by optional filters, strongest first."""
    if label is not None:
        results = results.where(F.lower("label") == label.lower())
    if min_confidence is not None:
        results = results.where(F.col("confidence") >= min_confidence)
    return results.orderBy(F.desc(F.abs("score")), "subject_key", "window_days").offset(offset).limit(limit)


def excluded_rows(df: DataFrame, since: Column) -> DataFrame:
    return df.where(~F.col("included") & (F.col("execution_date") >= since))


def recent_filings(df: DataFrame, column: str, reference: Column, days: int) -> DataFrame:
    """Filings of the last ``days`` by a text date in one of two formats; undated ones stay, 3650 days or more keep all."""
    if days >= 3650:
        return df
    d = F.coalesce(F.try_to_date(F.col(column), "MM/dd/yyyy"), F.try_to_date(F.col(column), "yyyy-MM-dd"))
    return df.where(d.isNull() | (d >= F.date_sub(reference, days)))
