"""From parsed filings to stored trades and signals: normalization, imports, enrichment, overlays from a store, briefs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.functions import assets
from tradelens.functions import numeric as N
from tradelens.functions import text as T
from tradelens.functions.config import V2, Config
from tradelens.operators import alerts, normalize, overlay, resolve, signals
from tradelens.sources.rosters import latest_results


def normalize_form4(parsed: DataFrame, entities: DataFrame) -> DataFrame:
    """Rows of ``parse_form4`` as normalized trades.

    Ids are issuer, owner, period, file stem and the line from 1. Issuers are resolved by ticker, CIK and name; roles
    follow the owner's flags; open-market trades of an included role count from a minimum value on. Documents that could
    not be read have no rows.
    """
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    filing = F.concat_ws(":", "issuer_cik", "owner_cik", "period", stem)
    rows = parsed.where("not parse_error and line is not null").withColumns({"filing_id": filing, "source": F.lit("insider"), "cik": F.col("issuer_cik")})
    rows = rows.withColumn("record_id", F.concat_ws(":", "filing_id", (F.col("line") + 1).cast("string")))
    # the rows go through the resolution themselves: a join of events back to them would parse every document twice
    out = resolve.resolve_entities(rows, entities).drop("candidates", "evidence").withColumnsRenamed({"entity_key": "event_key", "confidence": "resolution_confidence"})
    tickers = resolve.small(entities.select(F.col("entity_key").alias("event_key"), F.col("ticker").alias("entity_ticker")).dropDuplicates(["event_key"]))
    out = out.join(tickers, "event_key", "left")
    ticker = F.coalesce("entity_ticker", F.nullif(F.upper(F.trim("ticker")), F.lit("")))
    out = out.withColumn("ticker", ticker).withColumns({
        "actor_id": F.col("owner_cik"), "actor_name": F.col("owner_name"), "value": F.col("total_value"), "execution_date": F.col("transaction_date"), "disclosure_date": F.try_to_date("period", "yyyy-MM-dd"),
        "planned": T.planned_trade(F.col("footnotes")), "owner_type": F.when(F.col("ownership") == "D", "direct").otherwise("indirect"), "action": T.txn_class(F.col("code")),
        "direction": F.when(F.col("code") == "P", "BUY").when(F.col("code") == "S", "SELL").otherwise("NEUTRAL"), "subject_key": T.subject_key(F.col("ticker"), F.col("issuer_cik")),
    })
    out = out.withColumn("entity_key", F.coalesce("event_key", "subject_key"))
    return normalize.normalize_insider(out).select(
        "source", "record_id", "filing_id", "actor_id", "actor_name", F.col("role").alias("actor_type"), "role", "owner_type", "entity_key", "subject_key", "ticker", "issuer_name", "action", "code", "direction", "execution_date",
        "disclosure_date", "value", "shares", "shares_after", "price", "planned", "ownership", "event_id", "resolution_confidence", "included", "reason_code", "reason_detail",
    )


def normalize_legislator_filings(txns: DataFrame, entities: DataFrame, chamber: str, reference: Column | None = None) -> DataFrame:
    """Parsed transactions of one chamber as normalized trades.

    ``txns``: record_id, filing_id, filer_name, ticker, asset_name, asset_type, action, owner_type, execution_date, low, high and
    notification_date (house) or filing_date (senate). The house resolves the issuer first and judges the asset with the
    resolved ticker, and needs a resolved issuer; the senate judges the asset as filed. A house trade is disclosed on
    its notification date, a senate trade on its filing date, else on the reference date.
    """
    house = chamber == "house"
    rows = txns.withColumns({"source": F.lit("congress"), "cik": F.lit(None).cast("string"), "issuer_name": F.col("asset_name")})
    events = resolve.resolve_entities(rows.select("record_id", "source", "ticker", "cik", "issuer_name"), entities)
    events = events.select("record_id", "event_id", "status", F.col("entity_key").alias("event_key"), F.col("confidence").alias("resolution_confidence"))
    tickers = resolve.small(entities.select(F.col("entity_key").alias("event_key"), F.col("ticker").alias("entity_ticker")).dropDuplicates(["event_key"]))
    out = rows.join(events, "record_id").join(tickers, "event_key", "left")
    filed = F.nullif(F.upper(F.trim("ticker")), F.lit(""))
    out = out.withColumn("resolved_ticker", F.coalesce("entity_ticker", filed))
    judged = F.coalesce("resolved_ticker", filed) if house else filed
    out = out.withColumn("category", assets.asset_category(F.col("asset_name"), judged, F.col("asset_type")))
    out = out.withColumn("policy", assets.asset_policy(F.col("category"), judged, F.col("asset_type")))
    resolved = (F.col("status") == "RESOLVED") if house else F.lit(True)
    include = F.col("policy.include") & resolved & F.col("resolved_ticker").isNotNull() & F.col("action").isin("purchase", "sale", "sale_partial")
    small = F.coalesce(F.col("high") <= normalize.MINIMUM_LEGISLATOR, F.lit(False))
    reason = (
        F.when(include & small, "BELOW_MINIMUM_VALUE").when(include, None).when(~F.col("policy.include"), "NON_SIGNAL_ASSET").when(F.col("resolved_ticker").isNull(), "MISSING_TICKER")
        .when(F.col("status") != "RESOLVED", "LOW_RESOLUTION_CONFIDENCE").otherwise("NON_SIGNAL_ASSET" if house else "LOW_RESOLUTION_CONFIDENCE")
    )
    disclosed = F.col("notification_date") if house else F.coalesce("filing_date", reference if reference is not None else F.lit(None).cast("date"))
    return out.select(
        "source", "record_id", "filing_id", F.col("filing_id").alias("actor_id"), F.col("filer_name").alias("actor_name"), F.lit("member").alias("actor_type"), F.lit(chamber).alias("chamber"),
        F.coalesce(F.nullif("owner_type", F.lit("")), F.lit("self")).alias("owner_type"), F.coalesce("event_key", T.subject_key(F.col("resolved_ticker"))).alias("entity_key"), T.subject_key(F.col("resolved_ticker")).alias("subject_key"),
        F.col("resolved_ticker").alias("ticker"), "asset_name", "asset_type", "category", "action", T.direction(F.col("action")).alias("direction"), "execution_date", disclosed.alias("disclosure_date"), "low", "high",
        ((F.col("low") + F.col("high")) / 2).alias("estimate"), "event_id", "status", "resolution_confidence", (include & ~small).alias("included"), reason.alias("reason_code"), F.col("policy.reason").alias("reason_detail"),
    )


def enrich_committees(trades: DataFrame, members: DataFrame, sectors: DataFrame) -> DataFrame:
    """Adds bioguide, committees (parent codes), committee_sectors and committee_sector_match to trades (actor_name, ticker).

    ``members``: bioguide, name, state, committees (code, title); ``sectors``: ticker, sector. Filers are matched by name. Names
    are resolved once each, not once for a trade.
    """
    norm = T.filer_name_norm
    roster = members.select(F.col("bioguide").alias("member_id"), norm(F.col("name")).alias("norm"), "state", F.xxhash64("bioguide").alias("position")).where("norm is not null")
    names = trades.select("actor_name").distinct().select(F.col("actor_name").alias("name"), norm(F.col("actor_name")).alias("norm"), F.lit(None).cast("string").alias("state"))
    found = resolve.resolve_filers(names, roster).where("member_id is not null").select(F.col("name").alias("actor_name"), F.col("member_id").alias("bioguide"))
    codes = F.transform("committees", lambda c: c["code"])
    own = members.select("bioguide", F.array_sort(F.filter(codes, lambda c: F.length(c) <= 4)).alias("committees"), T.committee_sectors(codes).alias("committee_sectors"))
    by_ticker = sectors.select("ticker", F.col("sector").alias("stock_sector")).dropDuplicates(["ticker"])
    out = trades.join(resolve.small(found.join(own, "bioguide")), "actor_name", "left").join(resolve.small(by_ticker), "ticker", "left")
    match = F.when(F.col("bioguide").isNotNull(), F.coalesce(F.array_contains("committee_sectors", F.col("stock_sector")), F.lit(False)))
    return out.withColumn("committee_sector_match", match).select(*trades.columns, "bioguide", "committees", "committee_sectors", "committee_sector_match")


def overlay_from_store(results: DataFrame, events: DataFrame, window: int = 90) -> tuple[DataFrame, DataFrame]:
    """Combined rows and block events of stored results of both sources at one window.

    ``results``: source, scope, subject_key, lookback_window, label, score, confidence, input_count, included_count, as_of_date,
    run_id, provenance_refs (with resolution_event_ids). The latest row of a subject counts, whatever its run.
    """
    own = overlay.combine_candidates(latest_results(results, ["source", "subject_key", "lookback_window"], "as_of_date"), window)
    event = F.try_element_at("provenance_refs.resolution_event_ids", F.lit(1))
    side = lambda s: own.where(F.col("source") == s).select("subject_key", "label", "score", "confidence", event.alias("event_id"))
    decided = overlay.overlay(side("insider"), side("congress"), events)
    combined = decided.where("eligible").withColumn("lookback_window", F.lit(window))
    return combined, decided.where("not eligible").select("subject_key", "outcome", "reason_code", F.lit(window).alias("lookback_window"))


def import_legislator_store(txns: DataFrame, filings: DataFrame, entities: DataFrame, cutoff: Column) -> DataFrame:
    """Stored transactions from a cutoff date on, with their filing's filer and the issuer resolved anew.

    ``txns``: id, filing_id, bioguide_id, owner_type, asset_name, ticker, company, action, execution_date, disclosure_date, low, high, include,
    exclusion_reason; ``filings``: filing_id, filer_name. The stored include flag stays; its reason is NON_SIGNAL_ASSET where one
    is stored, else LOW_RESOLUTION_CONFIDENCE. Members are bioguide ids, else filer names.
    """
    rows = txns.where(F.col("execution_date") >= cutoff).join(filings.select("filing_id", "filer_name"), "filing_id")
    rows = rows.withColumns({
        "record_id": F.concat(F.lit("congress-txn:"), F.col("id").cast("string")), "source": F.lit("congress"), "cik": F.lit(None).cast("string"), "issuer_name": F.coalesce("company", "asset_name"),
    })
    events = resolve.resolve_entities(rows.select("record_id", "source", "ticker", "cik", "issuer_name"), entities).select("record_id", "event_id", F.col("entity_key").alias("event_key"), F.col("confidence").alias("resolution_confidence"))
    include = F.coalesce(F.col("include").cast("boolean"), F.lit(False))
    reason = F.when(~include, F.when(F.coalesce("exclusion_reason", F.lit("")) != "", "NON_SIGNAL_ASSET").otherwise("LOW_RESOLUTION_CONFIDENCE"))
    return rows.join(events, "record_id").select(
        "source", "record_id", "filing_id", F.col("bioguide_id").alias("actor_id"), F.col("filer_name").alias("actor_name"), F.coalesce("bioguide_id", "filer_name").alias("member_id"), "owner_type",
        F.coalesce("event_key", T.subject_key(F.col("ticker"))).alias("entity_key"), T.subject_key(F.col("ticker")).alias("subject_key"), "ticker", "issuer_name", "action", T.direction(F.col("action")).alias("direction"), "execution_date",
        "disclosure_date", "low", "high", "resolution_confidence", include.alias("included"), reason.alias("reason_code"),
    )


def stored_legislator_results(imported: DataFrame, reference: Column, cfg: Config = V2) -> DataFrame:
    """Signals per stored ticker of an import; trades are scored without a disclosure date."""
    score = N.legislator_txn_score(F.col("action"), F.col("low"), F.col("high"), F.col("owner_type"), F.col("execution_date"), F.lit(None).cast("date"), reference, F.col("resolution_confidence"), F.lit(1.0), cfg)
    scored = imported.where("included and ticker is not null").withColumn("s", score)
    return signals.legislator_entity_signal(scored.select("record_id", "ticker", "subject_key", "member_id", F.col("s.stale").alias("stale"), F.col("s.final").alias("final")), ["subject_key"], cfg)


def import_checks(txns: DataFrame, imported: DataFrame, results: DataFrame, cutoff: Column) -> DataFrame:
    """One row: rows in the window, rows imported, rows for signals, results, and whether the counts fit."""
    window = txns.where(F.col("execution_date") >= cutoff)
    counts = window.agg(F.count("*").alias("window_rows"), F.count_if(F.coalesce(F.col("include").cast("boolean"), F.lit(False)) & F.col("ticker").isNotNull()).alias("signal_rows"))
    both = counts.crossJoin(imported.agg(F.count("*").alias("imported"))).crossJoin(results.agg(F.count("*").alias("results")))
    return both.withColumn("fits", (F.col("window_rows") == F.col("imported")) & (F.col("results") <= F.col("signal_rows")))


def import_insider_store(txns: DataFrame, filings: DataFrame, companies: DataFrame, entities: DataFrame) -> DataFrame:
    """Stored insider transactions with their filing, company and resolved issuer.

    ``txns``: id, filing_id, code, include, value, execution_date; ``filings``: filing_id, cik_issuer, owner_name; ``companies``: cik, ticker,
    company_name. Transactions without a filing are left out, a missing company stays null.
    """
    rows = txns.join(filings, "filing_id").join(resolve.small(companies.select(F.col("cik").alias("cik_issuer"), "ticker", "company_name")), "cik_issuer", "left")
    rows = rows.withColumns({"record_id": F.concat(F.lit("insider-txn:"), F.col("id").cast("string")), "source": F.lit("insider"), "cik": F.col("cik_issuer"), "issuer_name": F.col("company_name")})
    events = resolve.resolve_entities(rows.select("record_id", "source", "ticker", "cik", "issuer_name"), entities).select("record_id", "event_id", "status", F.col("entity_key").alias("event_key"), F.col("confidence").alias("resolution_confidence"))
    return rows.join(events, "record_id").select(
        "source", "record_id", "filing_id", "owner_name", "ticker", "company_name", F.coalesce("event_key", T.subject_key(F.col("ticker"), F.col("cik_issuer"))).alias("entity_key"), "status", "resolution_confidence", "code",
        F.when(F.col("code") == "P", "BUY").when(F.col("code") == "S", "SELL").otherwise("NEUTRAL").alias("direction"), "execution_date", "value", F.coalesce(F.col("include").cast("boolean"), F.lit(False)).alias("included"),
    )


def normalize_legislator_v1(txns: DataFrame, names: DataFrame, ingest_date: Column | None = None) -> DataFrame:
    """The archive's store rows of parsed transactions (filing_id, line, asset_name, ticker, asset_type, kind, owner, trade_date, notification_date, low, high).

    Assets are judged by the archive's categories. ``names``: filing_id, filer. A missing trade or notification date becomes
    ``ingest_date`` where one is given.
    """
    category = assets.asset_category(F.col("asset_name"), F.col("ticker"), F.col("asset_type"), archive=True)
    rows = txns.join(names.select("filing_id", "filer"), "filing_id", "left").withColumn("category", category)
    rows = rows.withColumn("policy", assets.asset_policy(F.col("category"), F.col("ticker"), F.col("asset_type")))
    day = lambda c: F.coalesce(c, ingest_date) if ingest_date is not None else F.col(c)
    return rows.select(
        F.concat_ws(":", "filing_id", F.col("line").cast("string")).alias("txn_id"), "filing_id", F.coalesce("filer", F.lit("Unknown")).alias("filer_name"), "asset_name", "ticker", "category", F.col("kind").alias("action"),
        F.col("owner").alias("owner_type"), day("trade_date").alias("execution_date"), day("notification_date").alias("disclosure_date"), "low", "high", F.col("policy.include").alias("include"), F.col("policy.reason").alias("exclusion_reason"),
    )


SLICE_WINDOW = 90


def trade_level_signals(legislators: DataFrame, insiders: DataFrame, cfg: Config = V2) -> DataFrame:
    """Signals of single trades and filings: source, record_id, subject_key, score, label, confidence, as_of_date, input_count, included_count.

    Every included legislator trade (subject_key, action, low, high, owner_type, execution_date, resolution_confidence, included, ticker) is scored at its
    own date, in dollars, and labelled by its sign. An insider filing (filing_id, subject_key) with included trades makes one result: its trades are scored
    at their own dates and aggregated with the window of ``SLICE_WINDOW`` days, whatever their dates. Its record_id is the filing's, its as_of_date that of
    its last included trade by record_id; input_count counts all of its trades, included_count the buys and sells of the aggregate.
    """
    score = N.legislator_txn_score(F.col("action"), F.col("low"), F.col("high"), F.col("owner_type"), F.col("execution_date"), F.lit(None).cast("date"), F.col("execution_date"), F.coalesce("resolution_confidence", F.lit(0.0)), F.lit(1.0), cfg)
    final = F.col("s.final")
    label = F.when(final > 0, "bullish").when(final < 0, "bearish").otherwise("neutral")
    confidence = F.greatest(F.coalesce("resolution_confidence", F.lit(0.0)), F.when(F.col("ticker").isNotNull(), 0.95).otherwise(0.0))
    single = legislators.where("included and execution_date is not null").withColumn("s", score)
    one = F.lit(1).cast("long")
    single = single.select(F.lit("congress").alias("source"), "record_id", "subject_key", final.alias("score"), label.alias("label"), confidence.alias("confidence"), F.col("execution_date").alias("as_of_date"), one.alias("input_count"), one.alias("included_count"))

    filing = F.to_json(F.struct("filing_id", "subject_key"))
    counts = insiders.groupBy(filing.alias("filing")).agg(
        F.count("*").alias("input_count"), F.max_by(F.when(F.col("included"), F.col("execution_date")), F.when(F.col("included"), F.col("record_id"))).alias("as_of_date"),
        F.first("filing_id").cast("string").alias("record_id"), F.first("subject_key").alias("own_key"),
    )
    scored = normalize.score_insider(insiders.where("included"), F.col("execution_date"), cfg).withColumn("subject_key", filing)
    company = signals.insider_company_signal(scored, F.col("execution_date"), replace(cfg, windows=(SLICE_WINDOW,)))
    per_filing = company.join(counts, company.subject_key == counts.filing).select(
        F.lit("insider").alias("source"), "record_id", F.col("own_key").alias("subject_key"), F.col("score").cast("double").alias("score"), "label", F.col("confidence").cast("double").alias("confidence"),
        "as_of_date", "input_count", (F.col("buy_count") + F.col("sell_count")).alias("included_count"),
    )
    return single.unionByName(per_filing)


def cross_source(combined: DataFrame) -> DataFrame:
    """Combined results by strength: ticker, label of either side by the sign of its score, scores, outcome, tier."""
    side = lambda c: F.when(F.col(c) < 0, "bearish").otherwise("bullish")
    return combined.select(
        T.ticker_of(F.col("subject_key")).alias("ticker"), side("insider_score").alias("insider_label"), side("legislator_score").alias("legislator_label"), "insider_score", "legislator_score", "outcome", "strength_tier",
        F.abs("score").alias("strength"),
    )


def daily_brief(trades: DataFrame, results: DataFrame, combined: DataFrame, calendar: DataFrame, matched: DataFrame, reference: Column, days: int = 30, confidence: float = 0.4, least: int = 2) -> dict[str, DataFrame]:
    """Sections of a day's brief by name.

    ``trades``: normalized insider trades; ``results``: source, ticker, label, score, confidence, window_days, included_count; ``combined``: overlay
    rows; ``calendar``: ticker, earnings_date; ``matched``: legislator trades with their committees.
    """
    buys = trades.where("included and direction = 'BUY'")
    strong = lambda s: alerts.strong_signals(results.where(F.col("source") == s), confidence, least)
    return {
        "cluster_buys": alerts.cluster_buys(trades, reference, days, least), "strong_insider": strong("insider"), "strong_legislator": strong("congress"), "cross_source": cross_source(combined),
        "anomalies": alerts.anomalous_buying(trades, reference, days), "participation": alerts.participation_index(trades, reference), "earnings": alerts.earnings_proximity(buys, calendar, reference),
        "rotations": alerts.committee_rotation(matched, reference), "stats": results.groupBy("source").agg(F.count("*").alias("results"), F.count_if(F.col("label") == "bullish").alias("bullish"), F.count_if(F.col("label") == "bearish").alias("bearish")),
    }


def brief_lines(sections: dict[str, DataFrame]) -> DataFrame:
    """The sections as one table: section, line (a row as JSON with its fields in order of their names)."""
    out = None
    for name, rows in sections.items():
        line = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]))
        part = rows.select(F.lit(name).alias("section"), line.alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


def production_confidence(summary: DataFrame) -> DataFrame:
    """Adds rates, primary_constraint, readiness and recommendation to one-row summaries.

    ``summary``: overlap, combined, blocked, congress_results, missing_counterpart, ambiguous, house_candidates, senate_candidates, insider_candidates,
    house_scored_rate.
    """
    c = F.col
    rate = F.round(F.when(c("overlap") > 0, c("combined") / c("overlap")).otherwise(0.0), 4)
    by_congress = F.round(c("combined") / F.greatest(c("congress_results"), F.lit(1)), 4)
    sparse = (c("missing_counterpart") > 0) & ((c("missing_counterpart") >= F.greatest(F.lit(5), F.floor(c("blocked") * 0.6))) | (c("missing_counterpart") >= c("overlap")))
    unclear = (c("ambiguous") > 0) & (c("ambiguous") >= F.greatest(F.lit(2), F.floor(c("blocked") * 0.25)))
    backlog = F.greatest("house_candidates", "senate_candidates", "insider_candidates") > 2
    constraint = (
        F.when(c("overlap") == 0, "no_cross_source_overlap").when(sparse, "sparse_counterpart_coverage").when(unclear, "entity_resolution_ambiguity").when(backlog, "candidate_backlog")
        .when(c("house_scored_rate") < 0.1, "low_house_signal_extraction_rate").otherwise("combined_layer_ready_for_strategy_evaluation")
    )
    out = summary.withColumns({"yield_of_overlap": rate, "yield_of_congress": by_congress, "primary_constraint": constraint})
    p = c("primary_constraint")
    readiness = (
        F.when(p.isin("no_cross_source_overlap", "sparse_counterpart_coverage"), "pipeline_correct_but_signal_sparse")
        .when(p.isin("entity_resolution_ambiguity", "candidate_backlog", "low_house_signal_extraction_rate"), "pipeline_operational_needs_more_data_quality_work")
        .when((c("combined") > 0) & (c("house_candidates") == 0) & (c("senate_candidates") == 0), "ready_for_broader_live_strategy_validation").otherwise("operationally_ready")
    )
    out = out.withColumn("readiness", readiness)
    return out.withColumn("recommendation", F.when(c("readiness") == "ready_for_broader_live_strategy_validation", "focus_on_strategy_validation").otherwise("focus_on_overlap_and_signal_quality_analysis"))
