"""Histories, indices, reports and diagnostics over trades and signals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.config import V2, Config
from tradelens.operators import signals, studies
from tradelens.operators.resolve import small
from tradelens.sinks import staged


def risk_appetite_index(scores: DataFrame, cyclical: list[str], defensive: list[str]) -> DataFrame:
    """Per window of company scores (window_days, sector, label, score): means, cyclical and defensive means, breadth and shares."""
    active = F.col("label") != "insufficient"
    by_sector = scores.where(active).groupBy("window_days", "sector").agg(F.avg("score").alias("sector_mean"))
    equal = by_sector.groupBy("window_days").agg(F.avg("sector_mean").alias("sector_equal_mean"))
    mean_of = lambda names: F.avg(F.when(active & F.col("sector").isin(names), F.col("score")))
    share = lambda label, base: F.count_if(F.col("label") == label) / F.nullif(base, F.lit(0))
    agg = scores.groupBy("window_days").agg(
        F.avg(F.when(active, F.col("score"))).alias("mean_score"), mean_of(cyclical).alias("cyclical_mean"), mean_of(defensive).alias("defensive_mean"), share("bullish", F.count_if(active)).alias("bullish_breadth"),
        share("bearish", F.count_if(active)).alias("bearish_breadth"), share("neutral", F.count("*")).alias("neutral_share"), share("insufficient", F.count("*")).alias("insufficient_share"),
    )
    return agg.join(equal, "window_days", "left")


def positioning_history(scored: DataFrame, spine: DataFrame, window: int, least: int = 5, cfg: Config = V2) -> DataFrame:
    """Positioning at each as_of_date over the trades of the ``window`` days before it, in one job keyed by date.

    Each trade goes to the dates it can count for (a range join on the small spine), so no date is a job of its own.
    """
    met = scored.join(small(spine), (F.col("execution_date") >= F.date_sub("as_of_date", window)) & (F.col("execution_date") <= F.col("as_of_date")))
    return signals.positioning(met, ["as_of_date"], cfg).where(F.col("transactions") >= least)


def backtest_points(history: DataFrame, benchmark: DataFrame, days: int) -> DataFrame:
    """A positioning history with net (the share of the volume that is net), confidence and the benchmark's forward_return.

    The return goes from the close (date, close) of the as_of_date itself to the first one at least ``days`` later; without both it is null.
    """
    returns = studies.price_returns(benchmark.select(F.lit("benchmark").alias("ticker"), "date", "close").where("close > 0"), days)
    stale = F.col("mean_staleness")
    points = history.withColumns({"net": F.col("volume_net") / F.greatest(F.col("volume_buy") + F.col("volume_sell"), F.lit(1.0)), "confidence": F.when(stale < 1, 1 - stale).otherwise(0.5)})
    return points.join(returns.select(F.col("date").alias("as_of_date"), "forward_return"), "as_of_date", "left")


def backtest_summary(points: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row on points with a return: their number, correlations of breadth, net and confidence with the return (null below three points or without
    spread), the share of positive and of negative nets that the return confirms, the benchmark's total and the mean return."""
    r, n = F.col("forward_return"), F.count("forward_return")
    valid = points.where(r.isNotNull())
    with_return = lambda c: F.when((n >= 3) & (F.stddev_pop(c) > 0) & (F.stddev_pop(r) > 0), F.corr(c, r))
    share = lambda hit, of: F.count_if(hit) / F.nullif(F.count_if(of), F.lit(0))
    up, down = F.col("net") > 0, F.col("net") < 0
    summary = valid.agg(
        n.alias("valid_points"), *[with_return(F.col(c)).alias(f"corr_{c}") for c in ("breadth", "net", "confidence")], share(up & (r > 0), up).alias("positive_hit_rate"), share(down & (r < 0), down).alias("negative_hit_rate"),
        F.avg(r).alias("mean_return"),
    )
    first, last = F.min_by("close", "date"), F.max_by("close", "date")
    total = benchmark.agg(F.when((F.count("*") >= 2) & (first > 0), (last - first) / first).alias("benchmark_total"))
    return points.agg(F.count("*").alias("points")).crossJoin(summary).crossJoin(total)


def signal_history(score, trades: DataFrame, spine: DataFrame, window: int) -> DataFrame:
    """Signals of all reference dates in one job: trades inside each date's window get its as_of_date as part of their key, then ``score`` runs once.

    Trades outside a window are dropped before they multiply.
    """
    met = trades.join(small(spine), (F.col("execution_date") >= F.date_sub("as_of_date", window)) & (F.col("execution_date") <= F.col("as_of_date")))
    keyed = met.withColumn("subject_key", F.concat_ws("@", "subject_key", F.col("as_of_date").cast("string")))
    out = score(keyed)
    parts = F.split("subject_key", "@")
    return out.withColumn("as_of_date", parts[1].cast("date")).withColumn("subject_key", parts[0])


def candidate_issuers(unresolved: DataFrame, top: int = 10) -> DataFrame:
    """Unresolved issuers (name, reason, record_id) grouped by name: count, histogram of reasons, up to three record ids; the ``top`` largest."""
    reasons = unresolved.groupBy("name", "reason").agg(F.count("*").alias("n"))
    histogram = reasons.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("reason", "n"))), lambda r: F.concat_ws("=", r["reason"], r["n"].cast("string"))), ",").alias("reasons"))
    ranked = unresolved.withColumn("k", F.row_number().over(W.partitionBy("name").orderBy("record_id")))
    examples = ranked.where("k <= 3").groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("record_id")), ",").alias("examples"))
    counts = unresolved.groupBy("name").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "name").limit(top).join(histogram, "name").join(examples, "name")


def vendor_match_report(matches: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Counts and rates of matched trades (a_id, b_id, score)."""
    n = ours.agg(F.count("*").alias("ours")).crossJoin(theirs.agg(F.count("*").alias("theirs"))).crossJoin(matches.agg(F.count("*").alias("matched"), F.avg("score").alias("mean_score")))
    return n.withColumn("match_rate", F.col("matched") / F.nullif(F.greatest("ours", "theirs"), F.lit(0)))


def positioning_report(normalized: DataFrame) -> DataFrame:
    """Included, excluded by asset, excluded otherwise and resolved counts."""
    asset = F.col("reason_code") == "NON_SIGNAL_ASSET"
    return normalized.agg(F.count_if("included").alias("included"), F.count_if(~F.col("included") & asset).alias("excluded_asset"), F.count_if(~F.col("included") & ~asset).alias("excluded_other"), F.count_if(F.col("ticker").isNotNull()).alias("resolved"))


def member_diagnostics(trades: DataFrame, condition: Column, top: int = 10) -> DataFrame:
    """Count, date span, volumes and the most traded tickers of the members that meet a condition."""
    own = trades.where(condition)
    side = lambda d: F.sum(F.when(F.col("direction") == d, (F.col("low") + F.col("high")) / 2).otherwise(0))
    agg = own.groupBy("actor_id").agg(F.count("*").alias("n"), F.min("execution_date").alias("first_date"), F.max("execution_date").alias("last_date"), side("BUY").alias("buy_volume"), side("SELL").alias("sell_volume"))
    counts = own.groupBy("actor_id", "ticker").agg(F.count("*").alias("c"))
    ranked = counts.withColumn("k", F.row_number().over(W.partitionBy("actor_id").orderBy(F.desc("c"), "ticker"))).where(F.col("k") <= top)
    tickers = ranked.groupBy("actor_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "ticker"))), lambda r: r["ticker"]), ",").alias("top_tickers"))
    return agg.join(tickers, "actor_id")


def top_k(df: DataFrame, k: int, by: list[Column], within: list[str] | None = None) -> DataFrame:
    """The first ``k`` rows by an order, overall or within each group; ``place`` counts from 1. The order should end in a unique column."""
    if not within:
        return df.orderBy(*by).limit(k).withColumn("place", F.row_number().over(W.orderBy(*by)))
    return df.withColumn("place", F.row_number().over(W.partitionBy(*within).orderBy(*by))).where(F.col("place") <= k)


def parse_quality(normalized: DataFrame) -> DataFrame:
    """One row about parsed trades (ticker, included, entity_key): counts and the rates of resolved, ticketed and included ones."""
    n = F.count("*")
    counts = normalized.agg(n.alias("trades"), F.count_if(F.col("entity_key").isNotNull()).alias("resolved"), F.count_if(F.col("ticker").isNotNull()).alias("with_ticker"), F.count_if("included").alias("included"))
    rate = lambda c: F.round(F.coalesce(F.col(c) / F.nullif(F.col("trades"), F.lit(0)), F.lit(0.0)), 4)
    return counts.withColumns({"resolved_rate": rate("resolved"), "ticker_rate": rate("with_ticker"), "included_rate": rate("included")})


def quality_lists(normalized: DataFrame, top: int = 10) -> DataFrame:
    """The issuers that each part of the parsed trades (asset_name, entity_key, ticker, included, reason_code) names most: part, place, issuer, n.

    ``unresolved``: without entity or ticker; of those ``signal_like`` (a ticker or a sure resolution is missing) and ``non_signal`` (assets that give no
    signal); ``recovered``: included trades. Ordered by count, then name; issuers without a name are ``<unknown>``.
    """
    open_ = F.col("entity_key").isNull() | F.col("ticker").isNull()
    reason = F.coalesce("reason_code", F.lit(""))
    parts = {"unresolved": open_, "signal_like": open_ & reason.isin("MISSING_TICKER", "LOW_RESOLUTION_CONFIDENCE"), "non_signal": open_ & (reason == "NON_SIGNAL_ASSET"), "recovered": F.coalesce("included", F.lit(False))}
    part = F.explode(F.array_compact(F.array(*[F.when(c, name) for name, c in parts.items()]))).alias("part")
    counts = normalized.select(part, F.coalesce(F.nullif("asset_name", F.lit("")), F.lit("<unknown>")).alias("issuer")).groupBy("part", "issuer").agg(F.count("*").alias("n"))
    return top_k(counts, top, [F.desc("n"), F.col("issuer")], ["part"]).select("part", "place", "issuer", "n")


def first_subjects(results: DataFrame, top: int = 10) -> DataFrame:
    """The first results by subject: subject_key, label, score, confidence, input_count, place."""
    return top_k(results.select("subject_key", "label", "score", "confidence", "input_count"), top, [F.col("subject_key")])


def run_observability(normalized: DataFrame, blocks: DataFrame, runs: DataFrame) -> DataFrame:
    """What a run left, as rows (part, name, n).

    ``normalized``: source, included, reason_code, ticker; ``blocks``: reason_code; ``runs``: the ledger's run_id and status. Parts: exclusion and block
    (rows by reason, ``none`` without one), source (rows), unresolved (rows without a ticker by source) and failed_run (one row for each).
    """

    def counted(df: DataFrame, part: str, column: str) -> DataFrame:
        return df.groupBy(F.coalesce(F.col(column), F.lit("none")).alias("name")).agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "name", "n")

    parts = [
        counted(normalized.where("not included"), "exclusion", "reason_code"), counted(blocks, "block", "reason_code"), counted(normalized, "source", "source"),
        counted(normalized.where("ticker is null"), "unresolved", "source"), counted(runs.where("status = 'FAILED'"), "failed_run", "run_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def histogram(df: DataFrame, column: str, name: str) -> DataFrame:
    """Counts of a column's values as rows (histogram, value, n); nulls count as none."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("none")).alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("histogram"), "value", "n")


def candidate_details(unresolved: DataFrame, top: int = 10) -> DataFrame:
    """Unresolved issuers (name, category, reason, instrument, record_id) grouped by name, the ``top`` largest: count, three histograms as
    ``value=count`` texts, and up to three record ids."""
    leading = top_k(unresolved.groupBy("name").agg(F.count("*").alias("n")), top, [F.desc("n"), F.col("name")]).drop("place")
    out = leading
    for column in ("category", "reason", "instrument"):
        value = F.coalesce(column, F.lit("none"))
        counts = unresolved.join(leading.select("name"), "name", "left_semi").groupBy("name", value.alias("v")).agg(F.count("*").alias("c"))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("v", "c"))), lambda r: F.concat_ws("=", r["v"], r["c"].cast("string"))), ",")
        out = out.join(counts.groupBy("name").agg(text.alias(f"{column}_counts")), "name")
    first = top_k(unresolved.select("name", "record_id"), 3, [F.col("record_id")], ["name"])
    return out.join(first.groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("record_id")), ",").alias("examples")), "name")


def store_status(trades: DataFrame, reference: Column, days: int) -> DataFrame:
    """Per source of stored trades: rows, included rows, first and last date, and whether the newest row is older than the window."""
    agg = trades.groupBy("source").agg(F.count("*").alias("rows"), F.count_if("included").alias("included"), F.min("execution_date").alias("first_date"), F.max("execution_date").alias("last_date"))
    return agg.withColumn("stale", F.datediff(reference, "last_date") > days)


def ingest_summary(filings: DataFrame, trades: DataFrame, members: DataFrame) -> DataFrame:
    """Counts after an ingest as rows (metric, key, n): filings without trades by chamber and format, included and excluded trades, members by
    chamber and with committees. ``filings``: filing_id, chamber, format; ``trades``: filing_id, included; ``members``: chamber, committees (array)."""
    row = lambda metric, key, n: [F.lit(metric).alias("metric"), key.alias("key"), n.alias("n")]
    empty = filings.join(trades.select("filing_id").distinct(), "filing_id", "left_anti").groupBy("chamber", "format").agg(F.count("*").alias("n"))
    kind = F.when(F.col("included"), "included").otherwise("excluded")
    by_kind = trades.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    by_chamber = members.groupBy("chamber").agg(F.count("*").alias("n"), F.count_if(F.size("committees") > 0).alias("seated"))
    out = empty.select(*row("filings_without_trades", F.concat_ws("/", "chamber", "format"), F.col("n"))).unionByName(by_kind.select(*row("trades", F.col("kind"), F.col("n"))))
    return out.unionByName(by_chamber.select(*row("members", F.col("chamber"), F.col("n")))).unionByName(by_chamber.select(*row("members_with_committees", F.col("chamber"), F.col("seated"))))


def crossref_summary(legislators: DataFrame, insiders: DataFrame, crossed: DataFrame) -> DataFrame:
    """One row beside ``resolve.crossref``: tickers of both sides, of legislators alone, and the share of crossed tickers that agree."""
    legs, ins = legislators.select("ticker").distinct(), insiders.select("ticker").distinct()
    alone = legs.join(ins, "ticker", "left_anti").agg(F.count("*").alias("legislator_only"))
    rate = F.round(F.coalesce(F.count_if(F.startswith("agreement", F.lit("BOTH"))) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 4)
    return crossed.agg(F.count("*").alias("crossed"), rate.alias("agreement_rate")).crossJoin(alone)


def _compared(matches: DataFrame, ours: DataFrame, theirs: DataFrame, days: int = 7) -> DataFrame:
    """Each match with the kinds in which its trades differ, and whether its tickers are equal: a_id, b_id, kinds, same_ticker."""
    a = ours.select(*[F.col(c).alias(f"a_{c}") for c in ("id", "ticker", "action", "date", "amount")])
    b = theirs.select(*[F.col(c).alias(f"b_{c}") for c in ("id", "ticker", "action", "date", "amount")])
    both = matches.select("a_id", "b_id").join(b, "b_id").join(a, "a_id")
    close = F.abs(F.col("a_amount") - F.col("b_amount")) <= 0.1 * F.greatest("a_amount", "b_amount")
    close = F.coalesce(close, F.col("a_amount").isNull() & F.col("b_amount").isNull())
    apart = F.abs(F.datediff("a_date", "b_date")) > days
    kinds = F.array(F.when(F.col("a_ticker") != F.col("b_ticker"), "ticker"), F.when(F.col("a_action") != F.col("b_action"), "action"), F.when(apart, "date"), F.when(~close, "amount"))
    return both.select("a_id", "b_id", F.array_compact(kinds).alias("kinds"), (F.col("a_ticker") == F.col("b_ticker")).alias("same_ticker"))


def vendor_discrepancies(matches: DataFrame, ours: DataFrame, theirs: DataFrame, days: int = 7) -> DataFrame:
    """What differs in each match (a_id, b_id) of trades (id, ticker, action, date, amount): rows (a_id, b_id, kind).

    Tickers, actions and dates differ only where both sides have one, dates by more than ``days``; an amount that one side lacks differs.
    """
    return _compared(matches, ours, theirs, days).select("a_id", "b_id", F.explode("kinds").alias("kind"))


def vendor_validation(matches: DataFrame, ours: DataFrame, theirs: DataFrame, samples: int = 10) -> DataFrame:
    """The report on matches (a_id, b_id) as rows (part, name, value, detail).

    ``metric``: trades of both sides, matched and unmatched ones, the share of ours that is matched, and the shares of matches with equal tickers and with
    amounts that agree; ``discrepancy``: how many matches differ in each kind; ``sample``: the first matches that differ, by a_id, with their kinds.
    """
    compared = _compared(matches, ours, theirs).select(F.when(F.size("kinds") > 0, F.col("a_id")).alias("a_id"), "kinds", "same_ticker")
    compared = staged(compared, "compared")
    found = compared.select("a_id", F.explode("kinds").alias("kind"))
    equal = compared.agg(F.count("*").alias("matched"), F.count_if("same_ticker").alias("same_ticker"), F.count_if(F.array_contains("kinds", "amount")).alias("other_amount"))
    one = equal.crossJoin(ours.agg(F.count("*").alias("ours"))).crossJoin(theirs.agg(F.count("*").alias("theirs")))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    m = F.col("matched")
    metrics = {
        "ours": F.col("ours"), "theirs": F.col("theirs"), "matched": m, "unmatched_ours": F.col("ours") - m, "unmatched_theirs": F.col("theirs") - m,
        "match_rate": share(m, F.col("ours")), "ticker_rate": share(F.col("same_ticker"), m), "amount_rate": share(m - F.col("other_amount"), m),
    }
    none = F.lit(None).cast("string")
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.round(v.cast("double"), 6).alias("value")) for k, v in metrics.items()])).alias("r")
    out = one.select(rows).select(F.lit("metric").alias("part"), "r.name", "r.value", none.alias("detail"))
    kinds = found.groupBy("kind").agg(F.count("*").cast("double").alias("value")).select(F.lit("discrepancy").alias("part"), F.col("kind").alias("name"), "value", none.alias("detail"))
    first = found.select("a_id").distinct().orderBy("a_id").limit(samples)
    sample = found.join(first, "a_id").groupBy("a_id").agg(F.array_join(F.array_sort(F.collect_list("kind")), ",").alias("detail"))
    return out.unionByName(kinds).unionByName(sample.select(F.lit("sample").alias("part"), F.col("a_id").alias("name"), F.lit(None).cast("double").alias("value"), "detail"))


def unmatched(matches: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Trades of both sides without a match: side, id."""
    left = ours.join(matches, F.col("id") == F.col("a_id"), "left_anti").select(F.lit("ours").alias("side"), "id")
    return left.unionByName(theirs.join(matches, F.col("id") == F.col("b_id"), "left_anti").select(F.lit("theirs").alias("side"), "id"))
