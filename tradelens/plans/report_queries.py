"""Queries for histories, indices, reports and the archive's scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradelens.functions.config import V1
from tradelens.operators import matching, overlay, reports, signals
from tradelens.plans.catalog import ORACLES, query
from tradelens.plans.expressions import D0, WITH, ref
from tradelens.plans.signal_queries import A1_SQL, LEGISLATOR_SQL, insider_results, insiders, legislator_scores, legislators, positioning_sql
from tradelens.plans.study_queries import _congress, _issuers, _vendor
from tradelens.plans.trades import BENCHMARK_SQL, PRICES_SQL, benchmark_prices, table, trades
from tradelens.sinks import staged

A2_SQL = (
    A1_SQL.replace("CASE code WHEN 'P' THEN 1.0 ELSE 0.0 END *", "CASE code WHEN 'P' THEN 1.0 WHEN 'S' THEN -0.5 ELSE 0.0 END *").replace("CASE WHEN planned THEN 0.05 ELSE 1.0 END", "CASE WHEN planned THEN 0.25 ELSE 1.0 END")
    .replace("count(*) FILTER (code = 'P') AS buys", "count(*) FILTER (code = 'P') AS buys, count(*) FILTER (code = 'S') AS sells").replace("sum(buys) AS buy_count,", "sum(buys) AS buy_count, sum(sells) AS sell_count,")
    .replace("least(0.9, 0.4 * least(1.0, ln(1 + n) / ln(11)) + 0.6 * least(1.0, ln(1 + insiders) / ln(6)))", "least(0.9, (0.4 * least(1.0, ln(1 + n) / ln(11)) + 0.6 * least(1.0, ln(1 + insiders) / ln(6))) * CASE WHEN buy_count > 0 AND sell_count > 0 THEN 1.1 ELSE 1.0 END)")
)


@query("a2_company_score_v1", f"{A2_SQL} SELECT subject_key, window_days, label, score, confidence, buy_count FROM a1")
def a2(spark, sf_dir):
    return signals.insider_company_signal(insiders(spark, sf_dir, V1), ref(), V1).select("subject_key", "window_days", "label", "score", "confidence", "buy_count")


@query("n4_combine_candidate", f"{A1_SQL} SELECT subject_key, score FROM a1 WHERE window_days = 90 AND label <> 'insufficient' AND trade_count > 0 AND buy_count > 0")
def n4(spark, sf_dir):
    r = insider_results(spark, sf_dir).withColumns({"scope": F.lit("entity"), "lookback_window": F.col("window_days"), "input_count": F.col("trade_count"), "included_count": F.col("buy_count")})
    return overlay.combine_candidates(r, 90).select("subject_key", "score")


@query(
    "a10_risk_appetite_index",
    f"""{A1_SQL}, s AS (SELECT a1.*, sector FROM a1 JOIN (SELECT DISTINCT subject_key, sector FROM trades) USING (subject_key)), e AS (SELECT window_days, avg(m) AS e FROM (SELECT window_days, sector, avg(score) AS m FROM s WHERE label <> 'insufficient' GROUP BY ALL) GROUP BY 1)
    SELECT window_days, round(avg(score) FILTER (label <> 'insufficient'), 6) AS mean_score, round(any_value(e), 6) AS sector_equal_mean, round(avg(score) FILTER (label <> 'insufficient' AND sector IN ('Industrials', 'Technology')), 6) AS cyclical_mean,
    round(count(*) FILTER (label = 'bullish') / nullif(count(*) FILTER (label <> 'insufficient'), 0), 6) AS bullish_breadth, round(count(*) FILTER (label = 'insufficient') / count(*), 6) AS insufficient_share FROM s LEFT JOIN e USING (window_days) GROUP BY window_days""",
)
def a10(spark, sf_dir):
    sectors = trades(spark, sf_dir).select("subject_key", "sector").distinct()
    r = reports.risk_appetite_index(insider_results(spark, sf_dir).join(sectors, "subject_key"), ["Industrials", "Technology"], ["Health Care"])
    return r.select("window_days", *[F.round(c, 6).alias(c) for c in ("mean_score", "sector_equal_mean", "cyclical_mean", "bullish_breadth", "insufficient_share")])


def _spine(spark, sf_dir):
    months = F.explode(F.sequence(F.lit(dt.date(1999, 7, 1)), F.lit(dt.date(1999, 12, 1)), F.expr("interval 1 month"))).alias("as_of_date")
    return table(spark, sf_dir, "region").limit(1).select(months)


_SPINE_SQL = "spine AS (SELECT unnest(CAST(generate_series(DATE '1999-07-01', DATE '1999-12-01', INTERVAL 1 MONTH) AS DATE[])) AS as_of_date)"


@query(
    "a32_positioning_history",
    f"""{LEGISLATOR_SQL}, {_SPINE_SQL}, legw AS (SELECT leg.*, as_of_date FROM leg JOIN spine ON execution_date BETWEEN as_of_date - 90 AND as_of_date), {positioning_sql('as_of_date').replace('FROM leg ', 'FROM legw leg ')}
    SELECT as_of_date, unique_members, round(breadth, 6) AS breadth, round(volume_net, 2) AS volume_net, transactions FROM pos WHERE transactions >= 5""",
)
def a32(spark, sf_dir):
    h = reports.positioning_history(legislator_scores(spark, sf_dir), _spine(spark, sf_dir), 90)
    return h.select("as_of_date", "unique_members", F.round("breadth", 6).alias("breadth"), F.round("volume_net", 2).alias("volume_net"), "transactions")


_POINTS_SQL = (
    f"{LEGISLATOR_SQL}, {PRICES_SQL}, {BENCHMARK_SQL}, " + _SPINE_SQL.replace("1999-07-01", "1999-01-04").replace("1999-12-01", "1999-12-27").replace("INTERVAL 1 MONTH", "INTERVAL 7 DAY")
    + f", legw AS (SELECT leg.*, as_of_date FROM leg JOIN spine ON execution_date BETWEEN as_of_date - 90 AND as_of_date), {positioning_sql('as_of_date').replace('FROM leg ', 'FROM legw leg ')},"
    """ fwd AS (SELECT b.date, (n.close - b.close) / b.close AS forward_return FROM bench b ASOF JOIN bench n ON b.date + 30 <= n.date WHERE b.close > 0),
    pts AS (SELECT as_of_date, breadth, volume_net / greatest(volume_buy + volume_sell, 1.0) AS net, CASE WHEN mean_staleness < 1 THEN 1 - mean_staleness ELSE 0.5 END AS confidence, transactions, forward_return FROM pos LEFT JOIN fwd ON date = as_of_date WHERE transactions >= 5)"""
)


def _points(spark, sf_dir):
    weeks = F.explode(F.sequence(F.lit(dt.date(1999, 1, 4)), F.lit(dt.date(1999, 12, 27)), F.expr("interval 7 days"))).alias("as_of_date")
    history = reports.positioning_history(legislator_scores(spark, sf_dir), table(spark, sf_dir, "region").limit(1).select(weeks), 90)
    return reports.backtest_points(history, benchmark_prices(spark, sf_dir), 30)


@query("a32b_backtest_points", f"{_POINTS_SQL} SELECT as_of_date, round(breadth, 6) AS breadth, round(net, 6) AS net, round(confidence, 6) AS confidence, transactions, round(forward_return, 6) AS forward_return FROM pts")
def a32b(spark, sf_dir):
    rounded = [F.round(c, 6).alias(c) for c in ("breadth", "net", "confidence", "forward_return")]
    return _points(spark, sf_dir).select("as_of_date", *rounded, "transactions")


@query(
    "a32c_backtest_summary",
    f"""{_POINTS_SQL} SELECT (SELECT count(*) FROM pts) AS points, count(*) AS valid_points, round(corr(breadth, forward_return), 6) AS corr_breadth, round(corr(net, forward_return), 6) AS corr_net, round(corr(confidence, forward_return), 6) AS corr_confidence,
    round(count(*) FILTER (net > 0 AND forward_return > 0) / nullif(count(*) FILTER (net > 0), 0), 6) AS positive_hit_rate, round(count(*) FILTER (net < 0 AND forward_return < 0) / nullif(count(*) FILTER (net < 0), 0), 6) AS negative_hit_rate,
    round(avg(forward_return), 6) AS mean_return, (SELECT round((arg_max(close, date) - arg_min(close, date)) / arg_min(close, date), 6) FROM bench) AS benchmark_total FROM pts WHERE forward_return IS NOT NULL""",
)
def a32c(spark, sf_dir):
    summary = reports.backtest_summary(_points(spark, sf_dir), benchmark_prices(spark, sf_dir))
    return summary.select("points", "valid_points", *[F.round(c, 6).alias(c) for c in summary.columns if c not in ("points", "valid_points")])


@query(
    "a33_signal_history",
    f"""{LEGISLATOR_SQL}, {_SPINE_SQL}, legw AS (SELECT leg.*, subject_key || '@' || as_of_date AS sk FROM leg JOIN spine ON execution_date BETWEEN as_of_date - 180 AND as_of_date), {positioning_sql('sk').replace('FROM leg ', 'FROM legw leg ')}
    SELECT string_split(sk, '@')[1] AS subject_key, CAST(string_split(sk, '@')[2] AS DATE) AS as_of_date, round(score, 6) AS score, transactions FROM comp""",
)
def a33(spark, sf_dir):
    out = reports.signal_history(lambda df: signals.legislator_entity_signal(df, ["subject_key"]), legislator_scores(spark, sf_dir), _spine(spark, sf_dir), 180)
    return out.select("subject_key", "as_of_date", F.round("score", 6).alias("score"), "transactions")


@query(
    "a25_candidate_issuers",
    """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey AS k FROM lineitem WHERE l_orderkey % 5 = 2), u AS (SELECT 'n' || k % 30 AS name, 'r' || l_linenumber AS reason, concat_ws(':', l_orderkey, l_linenumber, k) AS record_id FROM r),
    h AS (SELECT name, string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM (SELECT name, reason, count(*) AS n FROM u GROUP BY ALL) GROUP BY name), x AS (SELECT name, string_agg(record_id, ',' ORDER BY record_id) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY record_id) AS k FROM u) WHERE k <= 3 GROUP BY name)
    SELECT name, n, reasons, examples FROM (SELECT name, count(*) AS n FROM u GROUP BY name ORDER BY n DESC, name LIMIT 10) JOIN h USING (name) JOIN x USING (name)""",
)
def a25(spark, sf_dir):
    i = _issuers(spark, sf_dir).where("_m = 2")
    u = i.select(F.concat(F.lit("n"), (F.col("_k") % 30).cast("string")).alias("name"), F.concat(F.lit("r"), F.split("record_id", ":")[1]).alias("reason"), "record_id")
    return reports.candidate_issuers(u)


@query("a25c_candidate_issuers_all", ORACLES["a25_candidate_issuers"].replace(" WHERE l_orderkey % 5 = 2", ""))
def a25c(spark, sf_dir):
    u = _issuers(spark, sf_dir).select(F.concat(F.lit("n"), (F.col("_k") % 30).cast("string")).alias("name"), F.concat(F.lit("r"), F.split("record_id", ":")[1]).alias("reason"), "record_id")
    return reports.candidate_issuers(u)


@query("a28_vendor_match_report")
def a28(spark, sf_dir):
    ours, theirs = _vendor(_congress(spark, sf_dir))
    return reports.vendor_match_report(matching.match_trades(ours, theirs), ours, theirs)


_PAIRED = f"""{WITH}, a AS (SELECT record_id AS id, ticker, action, execution_date AS date, value AS amount, filing_id AS k FROM trades WHERE source = 'congress'),
b AS (SELECT 'v:' || id AS id, CASE WHEN k % 5 = 0 THEN 'OTHER' ELSE ticker END AS ticker, date + CAST(k % 9 AS INTEGER) AS date, k FROM a WHERE k % 3 <> 0),
m AS (SELECT a.id AS a_id, a.ticker = b.ticker AS same, [CASE WHEN a.ticker <> b.ticker THEN 'ticker' END, CASE WHEN abs(a.date - b.date) > 7 THEN 'date' END] AS kinds FROM a JOIN b ON b.id = 'v:' || a.id WHERE a.k % 7 <> 0),
d AS (SELECT a_id, unnest(list_filter(kinds, lambda x: x IS NOT NULL)) AS kind FROM m),
n AS (SELECT (SELECT count(*) FROM a) AS ours, (SELECT count(*) FROM b) AS theirs, (SELECT count(*) FROM m) AS matched, (SELECT count(*) FROM m WHERE same) AS same)"""


def _paired(spark, sf_dir):
    """Both sides, and the vendor's copies of most of our trades as matches."""
    base = staged(_congress(spark, sf_dir), "congress")
    ours, theirs = _vendor(base)
    ids = base.where("k % 7 <> 0").select(F.col("id").alias("a_id"))
    return ids.join(theirs.select(F.col("id").alias("b_id")), F.col("b_id") == F.concat(F.lit("v:"), "a_id")), ours, theirs


@query(
    "a28b_vendor_validation",
    f"""{_PAIRED}, r AS (SELECT unnest(['ours', 'theirs', 'matched', 'unmatched_ours', 'unmatched_theirs', 'match_rate', 'ticker_rate', 'amount_rate']) AS name,
      unnest([ours, theirs, matched, ours - matched, theirs - matched, matched / ours, same / matched, 1]::DOUBLE[]) AS value FROM n)
    SELECT 'metric' AS part, name, round(value, 6) AS value, NULL AS detail FROM r UNION ALL SELECT 'discrepancy', kind, count(*)::DOUBLE, NULL FROM d GROUP BY kind
    UNION ALL SELECT 'sample', a_id, NULL, string_agg(kind, ',' ORDER BY kind) FROM d WHERE a_id IN (SELECT DISTINCT a_id FROM d ORDER BY a_id LIMIT 10) GROUP BY a_id""",
)
def a28b(spark, sf_dir):
    return reports.vendor_validation(*_paired(spark, sf_dir))


@query("a28c_vendor_discrepancies", f"{_PAIRED} SELECT a_id, 'v:' || a_id AS b_id, kind FROM d")
def a28c(spark, sf_dir):
    return reports.vendor_discrepancies(*_paired(spark, sf_dir))


@query("a28d_vendor_unmatched", f"{_PAIRED} SELECT 'ours' AS side, id FROM a WHERE id NOT IN (SELECT a_id FROM m) UNION ALL SELECT 'theirs', id FROM b WHERE id NOT IN (SELECT 'v:' || a_id FROM m)")
def a28d(spark, sf_dir):
    return reports.unmatched(*_paired(spark, sf_dir))


@query("a35_positioning_report", f"{LEGISLATOR_SQL} SELECT count(*) FILTER (reason_code IS NULL) AS included, count(*) FILTER (reason_code = 'NON_SIGNAL_ASSET') AS excluded_asset, count(*) FILTER (reason_code = 'BELOW_MINIMUM_VALUE') AS excluded_other, count(*) AS resolved FROM legn")
def a35(spark, sf_dir):
    return reports.positioning_report(legislators(spark, sf_dir))


@query(
    "j19_member_diagnostics",
    f"""{LEGISLATOR_SQL}, o AS (SELECT * FROM legn WHERE actor_id % 25 = 0), t AS (SELECT actor_id, ticker, row_number() OVER (PARTITION BY actor_id ORDER BY count(*) DESC, ticker) AS k FROM o GROUP BY actor_id, ticker),
    x AS (SELECT actor_id, string_agg(ticker, ',' ORDER BY k) AS top_tickers FROM t WHERE k <= 10 GROUP BY actor_id)
    SELECT actor_id, count(*) AS n, min(execution_date) AS first_date, max(execution_date) AS last_date, round(sum(CASE WHEN direction = 'BUY' THEN (low + high) / 2 ELSE 0 END), 1) AS buy_volume, round(sum(CASE WHEN direction = 'SELL' THEN (low + high) / 2 ELSE 0 END), 1) AS sell_volume, any_value(top_tickers) AS top_tickers FROM o JOIN x USING (actor_id) GROUP BY actor_id""",
)
def j19(spark, sf_dir):
    d = reports.member_diagnostics(legislators(spark, sf_dir), F.col("actor_id") % 25 == 0)
    return d.withColumns({c: F.round(c, 1) for c in ("buy_volume", "sell_volume")}).select("actor_id", "n", "first_date", "last_date", "buy_volume", "sell_volume", "top_tickers")


@query("j19b_member_diagnostics_all", ORACLES["j19_member_diagnostics"].replace(" WHERE actor_id % 25 = 0", ""))
def j19b(spark, sf_dir):
    d = reports.member_diagnostics(legislators(spark, sf_dir), F.lit(True))
    return d.withColumns({c: F.round(c, 1) for c in ("buy_volume", "sell_volume")}).select("actor_id", "n", "first_date", "last_date", "buy_volume", "sell_volume", "top_tickers")


@query("s21_import_insider_store", "SELECT 'insider-txn:' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS source_record_id, o_orderdate AS filed, c_name AS company FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0 WHERE l_orderkey % 2 = 0")
def s21(spark, sf_dir):
    t, f = table(spark, sf_dir, "lineitem").where("l_orderkey % 2 = 0"), table(spark, sf_dir, "orders")
    companies = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select("c_custkey", "c_name")
    joined = t.join(f, t.l_orderkey == f.o_orderkey).join(companies, f.o_custkey == companies.c_custkey, "left")
    return joined.select(F.concat(F.lit("insider-txn:"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")).alias("source_record_id"), F.col("o_orderdate").alias("filed"), F.col("c_name").alias("company"))


@query("s23_load_results", f"{A1_SQL} SELECT subject_key, label FROM a1 WHERE window_days IN (30, 180) AND label <> 'insufficient'")
def s23(spark, sf_dir):
    return insider_results(spark, sf_dir).where(F.col("window_days").isin(30, 180) & (F.col("label") != "insufficient")).select("subject_key", "label")


@query("w6_top_k", f"{WITH} SELECT ticker, actor_id, n, CAST(row_number() OVER (PARTITION BY ticker ORDER BY n DESC, actor_id) AS INTEGER) AS place FROM (SELECT ticker, actor_id, count(*) AS n FROM trades WHERE execution_date >= {D0} - 365 GROUP BY ALL) QUALIFY place <= 5")
def w6(spark, sf_dir):
    from pyspark.sql import Window as W

    n = insiders(spark, sf_dir).select("ticker", "actor_id", "execution_date").unionByName(legislators(spark, sf_dir).select("ticker", "actor_id", "execution_date"))
    c = n.where(F.col("execution_date") >= F.date_sub(ref(), 365)).groupBy("ticker", "actor_id").agg(F.count("*").alias("n"))
    return c.withColumn("place", F.row_number().over(W.partitionBy("ticker").orderBy(F.desc("n"), "actor_id"))).where("place <= 5")
