"""Queries for normalization, scores, signals, overlay and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.functions import numeric as N
from tradelens.functions.config import V2
from tradelens.operators import alerts, history, normalize, overlay, signals
from tradelens.plans.catalog import query
from tradelens.plans.expressions import _RANK_SQL, _ROLE_SQL, _SIZE, D0, WITH, ref
from tradelens.plans.trades import table, trades

SPINE = [dt.date(1999, m, 1) for m in range(7, 13)]

INSIDER_SQL = f"""{WITH}, {_ROLE_SQL},
ins AS (SELECT r.*, code IN ('P', 'S') AND role <> 'officer_other' AND value >= 10000 AS included,
    CASE WHEN code IN ('P', 'S') AND role = 'officer_other' THEN 'ENTITY_ROLE_EXCLUDED' WHEN code IN ('P', 'S') AND value < 10000 THEN 'BELOW_MINIMUM_VALUE' END AS reason_code,
    CASE code WHEN 'P' THEN 1.0 ELSE 0.0 END * CASE role WHEN 'ceo' THEN 1.0 WHEN 'cfo' THEN 0.95 WHEN 'chair' THEN 0.9 WHEN 'president' THEN 0.85 ELSE 0.5 END * CASE WHEN planned THEN 0.05 ELSE 1.0 END
      * CAST({_SIZE} AS DOUBLE) * CASE WHEN ownership = 'D' THEN 1.0 ELSE 0.6 END * exp(-0.693 * greatest(0, date_diff('day', execution_date, {D0})) / 45.0) AS signal
  FROM roles r WHERE source = 'insider')"""

LEGISLATOR_SQL = f"""{WITH},
leg0 AS (SELECT t.*, CASE WHEN value <= 15000 THEN 1001 WHEN value <= 50000 THEN 15001 WHEN value <= 100000 THEN 50001 ELSE 100001 END AS low,
    CASE WHEN value <= 15000 THEN 15000 WHEN value <= 50000 THEN 50000 WHEN value <= 100000 THEN 100000 ELSE 250000 END AS high FROM trades t WHERE source = 'congress'),
legn AS (SELECT *, CASE WHEN action NOT IN ('purchase', 'sale') THEN 'NON_SIGNAL_ASSET' WHEN high <= 15000 THEN 'BELOW_MINIMUM_VALUE' END AS reason_code FROM leg0),
leg AS (SELECT record_id, ticker, subject_key, sector, chamber, actor_id AS member_id, execution_date,
    CASE WHEN date_diff('day', execution_date, {D0}) < 0 THEN 0.9 ELSE exp(-0.693 * date_diff('day', execution_date, {D0}) / 60.0) END AS stale,
    sqrt(CAST(low AS DOUBLE) * high) * CASE action WHEN 'purchase' THEN 1.0 ELSE -1.0 END * CASE owner_type WHEN 'self' THEN 1.0 WHEN 'spouse' THEN 0.8 WHEN 'joint' THEN 0.9 WHEN 'dependent' THEN 0.5 ELSE 0.0 END
      * CASE WHEN date_diff('day', execution_date, {D0}) < 0 THEN 0.9 ELSE exp(-0.693 * date_diff('day', execution_date, {D0}) / 60.0) END * 0.95
      * CASE WHEN disclosure_date - execution_date <= 30 THEN 1.0 WHEN disclosure_date - execution_date <= 60 THEN 0.85 WHEN disclosure_date - execution_date <= 120 THEN 0.6 ELSE 0.3 END AS final
  FROM legn WHERE reason_code IS NULL)"""


def insiders(spark, sf_dir, cfg=V2):
    t = trades(spark, sf_dir).where("source = 'insider'")
    flags = {"is_officer": F.lit(True), **{c: F.lit(False) for c in ("is_director", "is_ten_pct", "is_other")}}
    out = normalize.normalize_insider(t.withColumns(flags)).drop(*flags)
    # the adapter's SQL gives other codes no reason
    out = out.withColumn("reason_code", F.when(F.col("code").isin("P", "S"), F.col("reason_code")))
    return normalize.score_insider(out, ref(), cfg)


def legislators(spark, sf_dir):
    """The adapter's trades have values, not brackets: they fall into the bracket of their value."""
    t, v = trades(spark, sf_dir).where("source = 'congress'"), F.col("value")
    low = F.when(v <= 15_000, 1_001).when(v <= 50_000, 15_001).when(v <= 100_000, 50_001).otherwise(100_001).cast("long")
    high = F.when(v <= 15_000, 15_000).when(v <= 50_000, 50_000).when(v <= 100_000, 100_000).otherwise(250_000).cast("long")
    return normalize.normalize_legislator(t.withColumns({"low": low, "high": high}))


def legislator_scores(spark, sf_dir):
    return normalize.score_legislator(legislators(spark, sf_dir), ref())


@query("n1_normalize_insider", f"{INSIDER_SQL} SELECT role, included, reason_code, count(*) AS n, round(sum(value), 2) AS value FROM ins GROUP BY ALL")
def n1(spark, sf_dir):
    return insiders(spark, sf_dir).groupBy("role", "included", "reason_code").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query("n2_normalize_legislator", f"{LEGISLATOR_SQL} SELECT chamber, reason_code, low, high, count(*) AS n FROM legn GROUP BY ALL")
def n2(spark, sf_dir):
    return legislators(spark, sf_dir).groupBy("chamber", "reason_code", F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high")).agg(F.count("*").alias("n"))


@query(
    "n3_inclusion_v1",
    f"""{INSIDER_SQL} SELECT reason, count(*) AS n FROM (SELECT CASE WHEN role = 'excluded' THEN 'excluded_role' WHEN filing_id % 11 = 0 THEN 'derivative' WHEN filing_id % 13 = 0 THEN 'equity_swap' WHEN code NOT IN ('P', 'S') THEN 'code:' || code
    WHEN planned THEN 'exercise_and_sell' WHEN ownership = 'I' AND actor_id % 2 = 0 THEN 'indirect_entity' END AS reason FROM ins) GROUP BY ALL""",
)
def n3(spark, sf_dir):
    t = insiders(spark, sf_dir).withColumns({"is_derivative": F.col("filing_id") % 11 == 0, "equity_swap": F.col("filing_id") % 13 == 0, "exercise_and_sell": F.col("planned"), "entity_owner": F.col("actor_id") % 2 == 0})
    return normalize.inclusion_v1(t).groupBy("reason").agg(F.count("*").alias("n"))


@query("n5_in_window", f"{WITH} SELECT source, count(*) FILTER (execution_date >= {D0} - 90) AS open_end, count(*) FILTER (execution_date >= {D0} - 90 AND execution_date <= {D0}) AS strict FROM trades GROUP BY source")
def n5(spark, sf_dir):
    t = trades(spark, sf_dir)
    count = lambda df, name: df.groupBy("source").agg(F.count("*").alias(name))
    return count(normalize.in_window(t, ref(), 90), "open_end").join(count(normalize.in_window(t, ref(), 90, True), "strict"), "source", "left")


@query("n7_excluded_rows", f"{INSIDER_SQL} SELECT record_id, ticker, reason_code FROM ins WHERE NOT included AND execution_date >= {D0} - 60")
def n7(spark, sf_dir):
    return normalize.excluded_rows(insiders(spark, sf_dir), F.date_sub(ref(), 60)).select("record_id", "ticker", "reason_code")


@query("s6_recent_filings", f"SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 2 OR CAST(o_orderdate AS DATE) >= {D0} - 400")
def s6(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    day = F.when(k == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a")
    return normalize.recent_filings(table(spark, sf_dir, "orders").withColumn("filed", day), "filed", ref(), 400).select("o_orderkey")


@query("m4_insider_txn_score", f"{INSIDER_SQL} SELECT record_id, round(signal, 6) AS signal FROM ins")
def m4(spark, sf_dir):
    return insiders(spark, sf_dir).select("record_id", F.round("signal", 6).alias("signal"))


@query("m10_legislator_txn_score", f"{LEGISLATOR_SQL} SELECT record_id, round(final, 4) + 0.0 AS final, round(stale, 6) AS stale FROM leg")
def m10(spark, sf_dir):
    return legislator_scores(spark, sf_dir).select("record_id", (F.round("final", 4) + 0.0).alias("final"), F.round("stale", 6).alias("stale"))


A1_SQL = f"""{INSIDER_SQL},
win AS (SELECT unnest([30, 90, 180]) AS window_days), frame AS (SELECT DISTINCT subject_key, window_days FROM ins, win),
byi AS (SELECT subject_key, window_days, actor_id, sum(signal) AS s, count(*) AS n, count(*) FILTER (code = 'P') AS buys FROM ins, win WHERE included AND execution_date >= {D0} - CAST(window_days AS INTEGER) GROUP BY ALL),
tot AS (SELECT subject_key, window_days, sum(abs(s)) AS total FROM byi GROUP BY ALL),
cap AS (SELECT b.*, CASE WHEN total - abs(s) <= 0 THEN s WHEN abs(s) > (total - abs(s)) * (0.3 / 0.7) THEN sign(s) * (total - abs(s)) * (0.3 / 0.7) ELSE s END AS c FROM byi b JOIN tot USING (subject_key, window_days)),
agg AS (SELECT subject_key, window_days, tanh(sum(c) / count(*)) AS flat, count(*) AS insiders, sum(n) AS n, sum(buys) AS buy_count, count(*) FILTER (buys > 0) AS ub FROM cap GROUP BY ALL),
sc AS (SELECT *, CASE WHEN ub >= 2 AND flat <> 0 THEN tanh(atanh(greatest(-0.999, least(0.999, flat))) * (1 + 0.25 * (ub - 1))) ELSE flat END AS score,
  least(0.9, 0.4 * least(1.0, ln(1 + n) / ln(11)) + 0.6 * least(1.0, ln(1 + insiders) / ln(6))) AS conf FROM agg),
a1 AS (SELECT subject_key, window_days, CASE WHEN coalesce(n, 0) < 2 OR conf < 0.25 THEN 'insufficient' WHEN score > 0.15 THEN 'bullish' WHEN score < -0.15 THEN 'bearish' ELSE 'neutral' END AS label,
  round(CASE WHEN n >= 2 THEN score ELSE 0.0 END, 4) AS score, round(CASE WHEN n >= 2 THEN conf ELSE 0.0 END, 4) AS confidence,
  CASE WHEN coalesce(n, 0) < 2 OR conf < 0.25 THEN 'insufficient' WHEN conf < 0.5 THEN 'low' WHEN conf < 0.75 THEN 'moderate' ELSE 'high' END AS confidence_tier,
  CAST(CASE WHEN n >= 2 THEN buy_count ELSE 0 END AS BIGINT) AS buy_count, CAST(CASE WHEN n >= 2 THEN ub ELSE 0 END AS BIGINT) AS unique_buyers, CAST(coalesce(n, 0) AS BIGINT) AS trade_count
  FROM frame LEFT JOIN sc USING (subject_key, window_days))"""


def insider_results(spark, sf_dir):
    return signals.insider_company_signal(insiders(spark, sf_dir), ref())


@query("a1_insider_company_signal", f"{A1_SQL} SELECT subject_key, window_days, label, score, confidence, confidence_tier, buy_count, unique_buyers, trade_count FROM a1")
def a1(spark, sf_dir):
    return insider_results(spark, sf_dir).select("subject_key", "window_days", "label", "score", "confidence", "confidence_tier", "buy_count", "unique_buyers", "trade_count")


@query("c17_explanation", f"""{A1_SQL} SELECT subject_key, window_days, CASE WHEN label = 'insufficient' THEN 'Insufficient qualifying insider transactions to determine a signal.' ELSE
    printf('Signal: %s (confidence=%.2f/%s). Based on %d buy(s) from %d buyer(s) over the past %d days.', upper(label), confidence, confidence_tier, buy_count, unique_buyers, window_days) END AS explanation FROM a1""")
def c17(spark, sf_dir):
    text = F.format_string("Signal: %s (confidence=%.2f/%s). Based on %d buy(s) from %d buyer(s) over the past %d days.", F.upper("label"), "confidence", "confidence_tier", "buy_count", "unique_buyers", "window_days")
    return insider_results(spark, sf_dir).select("subject_key", "window_days", F.when(F.col("label") == "insufficient", "Insufficient qualifying insider transactions to determine a signal.").otherwise(text).alias("explanation"))


@query("n6_search_results", f"{A1_SQL} SELECT subject_key, window_days, label, score, confidence FROM a1 WHERE label = 'bullish' AND confidence >= 0.4 ORDER BY abs(score) DESC, subject_key, window_days LIMIT 25")
def n6(spark, sf_dir):
    return normalize.search_results(insider_results(spark, sf_dir), "BULLISH", 0.4, 25).select("subject_key", "window_days", "label", "score", "confidence")


def positioning_sql(key: str) -> str:
    """Winsorized, member-capped aggregate per ``key`` as a chain of CTEs ending in ``pos``."""
    return f"""
rk AS (SELECT {key}, abs(final) AS a, row_number() OVER (PARTITION BY {key} ORDER BY abs(final), record_id) - 1 AS k, count(*) OVER (PARTITION BY {key}) AS n FROM leg WHERE final <> 0),
th AS (SELECT {key}, a AS threshold FROM rk WHERE k = least(floor(n * 0.95), n - 1)),
wz AS (SELECT leg.*, CASE WHEN abs(final) > threshold THEN sign(final) * threshold ELSE final END AS w FROM leg LEFT JOIN th USING ({key})),
mem AS (SELECT {key}, member_id, sum(w) AS m, count(*) AS n, sum(stale) AS stale FROM wz GROUP BY ALL),
lim AS (SELECT *, sum(abs(m)) OVER (PARTITION BY {key}) * 0.05 AS lim FROM mem),
capd AS (SELECT *, CASE WHEN abs(m) > lim THEN sign(m) * lim ELSE m END AS c FROM lim),
top AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY abs(c) DESC, member_id) AS place FROM capd),
pos AS (SELECT {key}, count(*) AS unique_members, count(*) FILTER (c > 0) AS buyers, count(*) FILTER (c < 0) AS sellers, sum(c) AS volume_net, sum(greatest(c, 0)) AS volume_buy, sum(greatest(-c, 0)) AS volume_sell,
  CASE WHEN sum(abs(c)) > 0 THEN sum(CASE WHEN place <= 5 THEN abs(c) ELSE 0 END) / sum(abs(c)) ELSE 0 END AS concentration_top5, count(*) FILTER (abs(m) > lim) AS members_capped, sum(stale) / sum(n) AS mean_staleness, CAST(sum(n) AS BIGINT) AS transactions,
  (count(*) FILTER (c > 0) - count(*) FILTER (c < 0)) / count(*) AS breadth FROM top GROUP BY {key}),
comp AS (SELECT *, least(1.0, unique_members / 50) * 0.25 + 0.2 + mean_staleness * 0.2 + (1 - concentration_top5) * 0.15 + least(1.0, transactions / 200) * 0.1 + 0.1 AS composite,
  CASE WHEN volume_buy + volume_sell > 0 THEN volume_net / (volume_buy + volume_sell) ELSE 0 END AS score FROM pos)"""


@query("a3_winsorize", f"{LEGISLATOR_SQL}, {positioning_sql('ticker')} SELECT record_id, round(w, 4) + 0.0 AS final FROM wz")
def a3(spark, sf_dir):
    return signals.winsorize(legislator_scores(spark, sf_dir), ["ticker"]).select("record_id", (F.round("final", 4) + 0.0).alias("final"))


@query(
    "a4_positioning",
    f"{LEGISLATOR_SQL}, {positioning_sql('ticker')} SELECT ticker, unique_members, buyers, sellers, round(volume_net, 2) AS volume_net, round(volume_buy, 2) AS volume_buy, round(volume_sell, 2) AS volume_sell, round(concentration_top5, 6) AS concentration_top5, members_capped, round(mean_staleness, 6) AS mean_staleness, transactions, round(breadth, 6) AS breadth FROM pos",
)
def a4(spark, sf_dir):
    p = signals.positioning(legislator_scores(spark, sf_dir), ["ticker"])
    r = lambda c, n: F.round(c, n).alias(c)
    return p.select("ticker", "unique_members", "buyers", "sellers", r("volume_net", 2), r("volume_buy", 2), r("volume_sell", 2), r("concentration_top5", 6), "members_capped", r("mean_staleness", 6), "transactions", r("breadth", 6))


A6_SQL = f"""{LEGISLATOR_SQL}, {positioning_sql('subject_key')},
a6 AS (SELECT subject_key, round(score, 6) AS score, round(composite, 6) AS confidence, CASE WHEN composite > 0.7 THEN 'HIGH' WHEN composite > 0.4 THEN 'MODERATE' ELSE 'LOW' END AS tier,
  CASE WHEN composite < 0.25 OR transactions < 2 THEN 'insufficient' WHEN score > 0.05 THEN 'bullish' WHEN score < -0.05 THEN 'bearish' ELSE 'neutral' END AS label, transactions FROM comp)"""


def _entity_results(scored):
    s = signals.legislator_entity_signal(scored, ["subject_key"])
    return s.select("subject_key", F.round("score", 6).alias("score"), F.round("composite", 6).alias("confidence"), "tier", "label", "transactions")


def legislator_results(spark, sf_dir):
    return _entity_results(legislator_scores(spark, sf_dir))


@query("a6_legislator_entity_signal", f"{A6_SQL} SELECT * FROM a6")
def a6(spark, sf_dir):
    return legislator_results(spark, sf_dir)


@query(
    "a7_market_positioning",
    f"""{LEGISLATOR_SQL.replace("AS record_id,", "AS record_id, 1 AS one,", 0)}, leg_all AS (SELECT count(*) FILTER (reason_code IS NULL) / count(*) AS rate FROM legn), {positioning_sql('one').replace("FROM leg ", "FROM (SELECT *, 1 AS one FROM leg) leg ")}
    SELECT 'market' AS scope, unique_members, buyers, sellers, round(volume_net, 2) AS volume_net, transactions, round(least(1.0, unique_members / 50) * 0.25 + rate * 0.2 + mean_staleness * 0.2 + (1 - concentration_top5) * 0.15 + least(1.0, transactions / 200) * 0.1 + 0.1, 6) AS composite FROM comp, leg_all""",
)
def a7(spark, sf_dir):
    m = signals.market_positioning(legislators(spark, sf_dir), legislator_scores(spark, sf_dir))
    return m.select("scope", "unique_members", "buyers", "sellers", F.round("volume_net", 2).alias("volume_net"), "transactions", F.round("composite", 6).alias("composite"))


def memberships(spark, sf_dir):
    """Committee seats of customers as members: two seats each, the first primary."""
    from tradelens.plans.trades import SECTORS

    seat = F.explode(F.array(F.lit(0), F.lit(1))).alias("seat")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member_id"), seat)
    k = F.col("member_id") % 7 + F.col("seat") * 3
    return c.select("member_id", F.concat(F.lit("c"), k.cast("string")).alias("committee"), F.element_at(F.array(*map(F.lit, SECTORS)), (k % 5 + 1).cast("int")).alias("sector"), (F.col("seat") == 0).alias("is_primary"))


MEMBERS_SQL = """seats AS (SELECT c_custkey AS member_id, 'c' || (c_custkey % 7 + seat * 3) AS committee, (['Financials', 'Industrials', 'Health Care', 'Energy', 'Technology'])[CAST((c_custkey % 7 + seat * 3) % 5 + 1 AS INTEGER)] AS sector, seat = 0 AS is_primary
  FROM customer, (SELECT unnest([0, 1]) AS seat)),
exposure AS (SELECT member_id, sector, round(w / max(w) OVER (PARTITION BY member_id), 3) AS exposure, committees FROM (SELECT member_id, sector, sum(CASE WHEN is_primary THEN 1.0 ELSE 0.5 END) AS w, string_agg(DISTINCT committee, ',' ORDER BY committee) AS committees FROM seats GROUP BY ALL))"""


@query("a9_member_sector_exposure", f"WITH {MEMBERS_SQL} SELECT * FROM exposure")
def a9(spark, sf_dir):
    return signals.member_sector_exposure(memberships(spark, sf_dir))


@query(
    "a8_sector_positioning",
    f"""{LEGISLATOR_SQL}, {MEMBERS_SQL}, net AS (SELECT member_id, sum(final) AS net FROM leg GROUP BY ALL),
    sp AS (SELECT *, net * exposure / sum(exposure) OVER (PARTITION BY member_id) AS v FROM net JOIN exposure USING (member_id))
    SELECT sector, round(sum(greatest(v, 0)), 2) AS buy_volume, round(sum(greatest(-v, 0)), 2) AS sell_volume, count(DISTINCT member_id) FILTER (v > 0) AS buyers, count(DISTINCT member_id) FILTER (v < 0) AS sellers, count(DISTINCT member_id) AS members, round(sum(exposure), 3) AS exposure FROM sp GROUP BY sector""",
)
def a8(spark, sf_dir):
    s = signals.sector_positioning(legislator_scores(spark, sf_dir), signals.member_sector_exposure(memberships(spark, sf_dir)))
    return s.select("sector", F.round("buy_volume", 2).alias("buy_volume"), F.round("sell_volume", 2).alias("sell_volume"), "buyers", "sellers", "members", F.round("exposure", 3).alias("exposure"))


@query(
    "a11_cluster_buys",
    f"""{INSIDER_SQL} SELECT ticker, count(DISTINCT actor_id) AS actors, string_agg(DISTINCT CAST(actor_id AS VARCHAR), ',' ORDER BY CAST(actor_id AS VARCHAR)) AS actor_list, count(*) AS trades, round(sum(value), 2) AS total_value, min(execution_date) AS first_date, max(execution_date) AS last_date
    FROM ins WHERE included AND direction = 'BUY' AND execution_date BETWEEN {D0} - 30 AND {D0} GROUP BY ticker HAVING count(DISTINCT actor_id) >= 2""",
)
def a11(spark, sf_dir):
    return alerts.cluster_buys(insiders(spark, sf_dir), ref()).withColumn("total_value", F.round("total_value", 2))


@query(
    "a12_anomalous_buying",
    f"""{INSIDER_SQL}, g AS (SELECT ticker, count(*) FILTER (execution_date BETWEEN {D0} - 30 AND {D0}) AS recent_buys, count(*) FILTER (execution_date >= {D0} - 360 AND execution_date < {D0} - 30) AS h, max(execution_date) FILTER (execution_date >= {D0} - 360 AND execution_date < {D0} - 30) AS last_buy
      FROM ins WHERE included AND direction = 'BUY' GROUP BY ticker)
    SELECT ticker, CASE WHEN h = 0 THEN 'first_buy_in_period' ELSE 'elevated_activity' END AS kind, recent_buys, round(h / 12, 6) AS monthly_mean, CAST(floor(date_diff('day', last_buy, {D0}) / 30) AS BIGINT) AS months_since FROM g WHERE recent_buys > 0 AND (h = 0 OR recent_buys > h / 12 * 2)""",
)
def a12(spark, sf_dir):
    return alerts.anomalous_buying(insiders(spark, sf_dir), ref()).withColumn("monthly_mean", F.round("monthly_mean", 6))


@query(
    "a13_participation_index",
    f"""{INSIDER_SQL}, b AS (SELECT * FROM ins WHERE included AND direction = 'BUY') SELECT (SELECT count(DISTINCT ticker) FROM b WHERE execution_date BETWEEN {D0} - 90 AND {D0}) AS count, round((SELECT count(DISTINCT ticker) FROM b WHERE execution_date BETWEEN {D0} - 90 AND {D0}) / 504, 6) AS rate,
    round((SELECT avg(n) FROM (SELECT date_trunc('month', execution_date) AS m, count(DISTINCT ticker) AS n FROM b WHERE execution_date < {D0} - 90 GROUP BY 1)) * 3 / 504, 6) AS historical_rate""",
)
def a13(spark, sf_dir):
    return alerts.participation_index(insiders(spark, sf_dir), ref()).select("count", F.round("rate", 6).alias("rate"), F.round("historical_rate", 6).alias("historical_rate"))


MATCHED_SQL = "matched AS (SELECT l.*, s.committee FROM legn l JOIN seats s ON l.actor_id = s.member_id AND l.sector = s.sector WHERE l.reason_code IS NULL)"


def matched(spark, sf_dir):
    return alerts.committee_trades(legislators(spark, sf_dir), memberships(spark, sf_dir))


@query("a15_committee_trades", f"{LEGISLATOR_SQL}, {MEMBERS_SQL}, {MATCHED_SQL} SELECT record_id, committee, sector FROM matched")
def a15(spark, sf_dir):
    return matched(spark, sf_dir).select("record_id", "committee", "sector")


@query(
    "a14_committee_rotation",
    f"""{LEGISLATOR_SQL}, {MEMBERS_SQL}, {MATCHED_SQL}, g AS (SELECT committee, count(*) FILTER (age BETWEEN 0 AND 30 AND direction = 'BUY') AS rb, count(*) FILTER (age BETWEEN 0 AND 30 AND direction = 'SELL') AS rs, count(*) FILTER (age BETWEEN 31 AND 180 AND direction = 'BUY') AS pb, count(*) FILTER (age BETWEEN 31 AND 180 AND direction = 'SELL') AS ps
      FROM (SELECT *, date_diff('day', execution_date, {D0}) AS age FROM matched) GROUP BY committee),
    h AS (SELECT *, CASE WHEN pb > ps THEN 'BUY' WHEN ps > pb THEN 'SELL' END AS prior_direction, CASE WHEN rb > rs THEN 'BUY' WHEN rs > rb THEN 'SELL' END AS recent_direction FROM g)
    SELECT committee, prior_direction, recent_direction, rb, rs, pb, ps FROM h WHERE prior_direction <> recent_direction""",
)
def a14(spark, sf_dir):
    return alerts.committee_rotation(matched(spark, sf_dir), ref())


@query(
    "j18_earnings_proximity",
    f"""{INSIDER_SQL}, cal AS (SELECT DISTINCT ticker, DATE '1999-11-15' + CAST(ascii(right(ticker, 1)) - 65 AS INTEGER) * 3 AS earnings_date FROM trades),
    m AS (SELECT i.ticker, actor_id, execution_date, earnings_date, earnings_date - execution_date AS distance, row_number() OVER (PARTITION BY i.ticker ORDER BY execution_date, actor_id, record_id) AS k
      FROM ins i JOIN cal USING (ticker) WHERE included AND direction = 'BUY' AND execution_date BETWEEN {D0} - 90 AND {D0} AND earnings_date - execution_date BETWEEN 1 AND 30)
    SELECT ticker, actor_id, execution_date, earnings_date, CAST(distance AS INTEGER) AS distance FROM m WHERE k = 1""",
)
def j18(spark, sf_dir):
    t = trades(spark, sf_dir).select("ticker").distinct()
    calendar = t.withColumn("earnings_date", F.date_add(F.lit(dt.date(1999, 11, 15)), (F.ascii(F.right("ticker", F.lit(1))) - 65) * 3))
    return alerts.earnings_proximity(insiders(spark, sf_dir).where("included and direction = 'BUY'"), calendar, ref())


@query(
    "w2_strong_signals",
    f"""{A1_SQL}, w AS (SELECT upper(replace(subject_key, 'entity:', '')) AS ticker, window_days, score, confidence, buy_count, row_number() OVER (PARTITION BY subject_key ORDER BY confidence DESC, score DESC, window_days) AS k FROM a1 WHERE label = 'bullish' AND confidence >= 0.4 AND buy_count >= 2)
    SELECT ticker, window_days, score, confidence, buy_count FROM w WHERE k = 1""",
)
def w2(spark, sf_dir):
    r = insider_results(spark, sf_dir).withColumn("ticker", F.upper(F.replace("subject_key", F.lit("entity:"), F.lit("")))).withColumn("included_count", F.col("buy_count"))
    return alerts.strong_signals(r).select("ticker", "window_days", "score", "confidence", "buy_count")


@query("w3_enrich_with_rank", f"""{INSIDER_SQL} SELECT ticker, record_id, CAST(CASE WHEN role IN ('ceo', 'cfo') THEN 3 WHEN role IN ('chair', 'president', 'coo') THEN 2 ELSE 1 END + 2 + CASE WHEN ownership = 'D' THEN 2 ELSE 0 END + CASE WHEN greatest(0, date_diff('day', execution_date, {D0})) < 14 THEN 1 ELSE 0 END AS INTEGER) AS rank
    FROM ins WHERE included AND direction = 'BUY' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY execution_date DESC, record_id DESC) = 1""")
def w3(spark, sf_dir):
    from tradelens.functions.text import role_class

    no = F.lit(False)
    latest = alerts.latest_buy_per_ticker(insiders(spark, sf_dir))
    role = role_class(F.col("title"), F.lit("owner"), F.lit(True), no, no, no)["role"]
    return latest.select("ticker", "record_id", N.insider_rank(role, no, F.col("ownership"), F.lit(None).cast("double"), F.col("execution_date"), ref())["rank"].alias("rank"))


@query(
    "a17_sector_summary",
    f"""{A1_SQL}, s AS (SELECT DISTINCT ticker, sector FROM trades), r AS (SELECT upper(replace(subject_key, 'entity:', '')) AS ticker, label, score FROM a1), j AS (SELECT sector, ticker, label, score FROM r JOIN s USING (ticker)),
    b AS (SELECT sector, ticker, max(abs(score)) AS a FROM j GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY a DESC, ticker) AS k FROM b)
    SELECT j.sector, count(*) FILTER (label = 'bullish') AS bullish, count(*) FILTER (label = 'bearish') AS bearish, count(DISTINCT j.ticker) AS tickers, count(*) FILTER (label = 'bullish') - count(*) FILTER (label = 'bearish') AS net, any_value(t.top) AS top_tickers
    FROM j JOIN (SELECT sector, string_agg(ticker, ',' ORDER BY k) AS top FROM k WHERE k <= 5 GROUP BY sector) t ON j.sector = t.sector GROUP BY j.sector""",
)
def a17(spark, sf_dir):
    s = trades(spark, sf_dir).select("ticker", "sector").distinct()
    r = insider_results(spark, sf_dir).withColumn("ticker", F.upper(F.replace("subject_key", F.lit("entity:"), F.lit(""))))
    return alerts.sector_summary(r.join(s, "ticker")).select("sector", "bullish", "bearish", "tickers", "net", "top_tickers")


_INSIDER_COLUMNS = ["source", "record_id", "ticker", "subject_key", "actor_id", "direction", "value", "execution_date", "included", "reason_code", "direction_weight", "signal"]
_LEGISLATOR_COLUMNS = ["source", "record_id", "ticker", "subject_key", "actor_id", "action", "direction", "sector", "chamber", "owner_type", "low", "high", "execution_date", "disclosure_date", "included", "reason_code"]


def staged_sources(spark, sf_dir):
    """Normalized trades of insiders and legislators and the results of both, for queries that read them many times: each is made once."""
    ins = sinks.staged(insiders(spark, sf_dir).select(*_INSIDER_COLUMNS), "insiders")
    legs = sinks.staged(legislators(spark, sf_dir).select(*_LEGISLATOR_COLUMNS), "legislators")
    own = sinks.staged(signals.insider_company_signal(ins, ref()), "insider-results")
    theirs = sinks.staged(_entity_results(normalize.score_legislator(legs, ref())), "legislator-results")
    return ins, legs, own, theirs


def sides(spark, sf_dir, own=None, theirs=None):
    """Both sides of the overlay and the events of their resolution, from the results of both sources where they are given."""
    ins = (insider_results(spark, sf_dir) if own is None else own).where("window_days = 90 and label <> 'insufficient'")
    leg = (legislator_results(spark, sf_dir) if theirs is None else theirs).where("label <> 'insufficient'")
    # every seventh ticker resolves with low confidence, every eleventh is ambiguous
    k = lambda c: F.ascii(F.right(c, F.lit(1))) - F.ascii(F.lit("a")) + (F.ascii(F.substring(c, 9, 1)) - F.ascii(F.lit("a"))) * 10
    event = F.when(k("subject_key") % 7 == 0, F.concat(F.lit("e:"), "subject_key")).when(k("subject_key") % 11 == 0, F.concat(F.lit("x:"), "subject_key"))
    # both are read more than once: as sides, and the legislators' for the events
    ins = sinks.staged(ins.withColumn("event_id", F.lit(None).cast("string")), "insider-results")
    leg = sinks.staged(leg.withColumn("event_id", event), "legislator-results")
    events = leg.where("event_id is not null").select(
        "event_id", F.when(F.startswith("event_id", F.lit("x")), "AMBIGUOUS").otherwise("RESOLVED").alias("status"), F.col("subject_key").alias("entity_key"), F.lit(None).cast("string").alias("instrument_key"),
        F.when(F.startswith("event_id", F.lit("e")), 0.7).otherwise(0.4).alias("resolution_confidence"),
    )
    return ins, leg, events


OVERLAY_SQL = f"""{A1_SQL}, {A6_SQL.split(WITH + ",", 1)[1]},
i AS (SELECT subject_key, label AS il, score AS isc, confidence AS ic FROM a1 WHERE window_days = 90 AND label <> 'insufficient'),
l AS (SELECT subject_key, label AS ll, score AS ls, confidence AS lc, ascii(right(subject_key, 1)) - 97 + (ascii(subject_key[9]) - 97) * 10 AS k FROM a6 WHERE label <> 'insufficient'),
d AS (SELECT l.*, i.* EXCLUDE (subject_key), least(ic, lc) AS mc,
  CASE WHEN il IS NULL THEN 'SINGLE_SOURCE_ONLY' WHEN k % 7 = 0 THEN 'BLOCKED_LOW_CONFIDENCE' WHEN k % 11 = 0 THEN 'BLOCKED_AMBIGUOUS' WHEN il = ll AND ll = 'bullish' AND least(ic, lc) >= 0.5 THEN 'ALIGNED_BULLISH'
    WHEN il = ll AND ll = 'bearish' AND least(ic, lc) >= 0.5 THEN 'ALIGNED_BEARISH' WHEN il IN ('bullish', 'bearish') AND ll IN ('bullish', 'bearish') AND il <> ll AND least(ic, lc) >= 0.5 THEN 'TRUE_CONFLICT' ELSE 'LOW_CONFIDENCE_ALIGNMENT' END AS outcome
  FROM l LEFT JOIN i USING (subject_key)),
o AS (SELECT *, NOT (outcome LIKE 'BLOCKED%' OR outcome = 'SINGLE_SOURCE_ONLY') AS eligible FROM d)"""


@query(
    "j6_overlay",
    f"""{OVERLAY_SQL} SELECT subject_key, eligible, outcome, CASE outcome WHEN 'SINGLE_SOURCE_ONLY' THEN 'MISSING_COUNTERPART' WHEN 'BLOCKED_LOW_CONFIDENCE' THEN 'LOW_RESOLUTION_CONFIDENCE' WHEN 'BLOCKED_AMBIGUOUS' THEN 'AMBIGUOUS_ENTITY_MATCH' END AS reason_code,
    round(CASE WHEN outcome = 'TRUE_CONFLICT' THEN least(1.0, abs(isc - ls) / 2 * mc) ELSE 0.0 END, 4) AS conflict_score, CASE WHEN eligible THEN round((isc + ls) / 2, 4) END AS score,
    CASE WHEN NOT eligible THEN NULL WHEN outcome = 'ALIGNED_BULLISH' THEN 'bullish' WHEN outcome = 'ALIGNED_BEARISH' THEN 'bearish' ELSE 'mixed' END AS label,
    CASE WHEN NOT eligible THEN NULL WHEN ic >= 0.7 AND lc >= 0.7 AND abs((isc + ls) / 2) > 0.3 THEN 'strong' WHEN ic >= 0.4 AND lc >= 0.4 THEN 'moderate' ELSE 'weak' END AS strength_tier FROM o""",
)
def j6(spark, sf_dir):
    return overlay.overlay(*sides(spark, sf_dir)).select("subject_key", "eligible", "outcome", "reason_code", F.round("conflict_score", 4).alias("conflict_score"), F.round("score", 4).alias("score"), "label", "strength_tier")


@query(
    "j8_overlap_diagnostics",
    f"""{OVERLAY_SQL}, p AS (SELECT coalesce(i.subject_key, l.subject_key) AS s, CASE WHEN i.subject_key IS NULL THEN 'legislator_only' WHEN l.subject_key IS NULL THEN 'insider_only' ELSE 'overlap' END AS part FROM i FULL JOIN l ON i.subject_key = l.subject_key),
    q AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY s) AS k FROM p) SELECT part, count(*) AS subjects, string_agg(s, ',' ORDER BY s) FILTER (k <= 20) AS sample FROM q GROUP BY part""",
)
def j8(spark, sf_dir):
    ins, leg, _ = sides(spark, sf_dir)
    return overlay.overlap_diagnostics(ins, leg)


@query(
    "j9_overlap_opportunities",
    f"""{OVERLAY_SQL}, b AS (SELECT subject_key, CASE WHEN eligible AND outcome = 'TRUE_CONFLICT' THEN 'conflict' WHEN eligible AND outcome LIKE 'ALIGNED%' THEN 'aligned' WHEN eligible THEN 'low_confidence' WHEN outcome = 'BLOCKED_AMBIGUOUS' THEN 'blocked_ambiguous' WHEN il = 'neutral' OR ll = 'neutral' THEN 'neutral' ELSE 'low_confidence' END AS bucket FROM o WHERE il IS NOT NULL)
    SELECT subject_key, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY subject_key) AS INTEGER) AS place FROM b QUALIFY place <= 20""",
)
def j9(spark, sf_dir):
    ins, leg, events = sides(spark, sf_dir)
    return overlay.overlap_opportunities(overlay.overlay(ins, leg, events), ins, leg)


@query("w1_latest_by_key", f"{WITH} SELECT short_id, record_id, value FROM trades QUALIFY row_number() OVER (PARTITION BY short_id ORDER BY record_id DESC) = 1")
def w1(spark, sf_dir):
    return overlay.latest_by_key(trades(spark, sf_dir), ["short_id"], "record_id").select("short_id", "record_id", "value")


def monthly_history(spark, sf_dir):
    """Labels of tickers at month ends from the share of buys among a month's insider trades."""
    t = trades(spark, sf_dir).where("source = 'insider' and execution_date between date'1999-01-01' and date'1999-12-31'")
    g = t.groupBy("ticker", "subject_key", F.trunc("execution_date", "month").alias("as_of_date")).agg((F.count_if(F.col("code") == "P") - F.count_if(F.col("code") == "S")).alias("net"))
    return g.withColumn("label", F.when(F.col("net") > 0, "bullish").when(F.col("net") < 0, "bearish").otherwise("neutral"))


HISTORY_SQL = f"""{WITH}, h AS (SELECT ticker, subject_key, CAST(date_trunc('month', execution_date) AS DATE) AS as_of_date, CASE WHEN count(*) FILTER (code = 'P') > count(*) FILTER (code = 'S') THEN 'bullish' WHEN count(*) FILTER (code = 'P') < count(*) FILTER (code = 'S') THEN 'bearish' ELSE 'neutral' END AS label
  FROM trades WHERE source = 'insider' AND execution_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY ALL)"""


@query(
    "w4_label_stability",
    f"""{HISTORY_SQL}, l AS (SELECT *, lag(label) OVER (PARTITION BY ticker ORDER BY as_of_date) AS b FROM h), d AS (SELECT count(DISTINCT as_of_date) AS dates FROM h),
    m AS (SELECT ticker, label FROM (SELECT ticker, label, row_number() OVER (PARTITION BY ticker ORDER BY count(*) DESC, label) AS k FROM h GROUP BY ticker, label) WHERE k = 1)
    SELECT l.ticker, count(*) AS present, round(count(*) FILTER (l.label IN ('bullish', 'bearish')) / any_value(dates), 4) AS active_share, round(CASE WHEN count(b) > 0 THEN count(*) FILTER (b <> l.label) / count(b) ELSE 0 END, 4) AS flip_rate, any_value(m.label) AS dominant_label FROM l JOIN m USING (ticker), d GROUP BY l.ticker""",
)
def w4(spark, sf_dir):
    return history.label_stability(monthly_history(spark, sf_dir)).withColumns({"active_share": F.round("active_share", 4), "flip_rate": F.round("flip_rate", 4)})


@query(
    "w7_signal_turnover",
    f"""{HISTORY_SQL}, d AS (SELECT as_of_date, row_number() OVER (ORDER BY as_of_date) AS i FROM (SELECT DISTINCT as_of_date FROM h)), p AS (SELECT i, subject_key || ':' || label AS s FROM h JOIN d USING (as_of_date)),
    s AS (SELECT i, list(s) AS x FROM p GROUP BY i) SELECT d.as_of_date, round(1 - len(list_intersect(b.x, a.x)) / len(list_distinct(list_concat(b.x, a.x))), 4) AS turnover FROM s a JOIN s b ON b.i = a.i - 1 JOIN d ON d.i = a.i""",
)
def w7(spark, sf_dir):
    return history.signal_turnover(monthly_history(spark, sf_dir))


@query(
    "w8_overlap_sets",
    f"{WITH}, a AS (SELECT DISTINCT actor_id FROM trades WHERE source = 'insider' AND planned), b AS (SELECT DISTINCT actor_id FROM trades WHERE source = 'congress' AND planned) SELECT 'both' AS part, actor_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only_a', actor_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only_b', actor_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
)
def w8(spark, sf_dir):
    t = trades(spark, sf_dir).where("planned")
    a, b = (t.where(F.col("source") == s).select("actor_id").distinct() for s in ("insider", "congress"))
    tag = lambda df, part: df.select(F.lit(part).alias("part"), "actor_id")
    return tag(a.intersect(b), "both").unionByName(tag(a.exceptAll(b), "only_a")).unionByName(tag(b.join(a, "actor_id", "left_anti"), "only_b"))


@query("a23_run_observability", f"{INSIDER_SQL} SELECT coalesce(reason_code, 'none') AS reason, code, count(*) AS n FROM ins WHERE NOT included GROUP BY ALL")
def a23(spark, sf_dir):
    t = insiders(spark, sf_dir).where("not included")
    return t.groupBy(F.coalesce("reason_code", F.lit("none")).alias("reason"), "code").agg(F.count("*").alias("n"))


_ = _RANK_SQL
