"""Queries for studies, matching, sinks and stores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.operators import history, matching, resolve, signals, studies
from tradelens.plans.catalog import query
from tradelens.plans.expressions import D0, WITH, ref
from tradelens.plans.signal_queries import INSIDER_SQL, LEGISLATOR_SQL, insiders, legislator_scores, legislators, positioning_sql
from tradelens.plans.trades import BENCHMARK_SQL, PRICES_SQL, SECTORS, benchmark_prices, prices, table, trades

DAYS = [5, 20, 60]
EVENTS_SQL = f"""{INSIDER_SQL}, {PRICES_SQL}, {BENCHMARK_SQL},
ev AS (SELECT record_id, ticker, direction, sector, execution_date AS event_date FROM ins WHERE included AND execution_date BETWEEN DATE '1999-01-01' AND {D0}),
b AS (SELECT ev.*, p.date AS base_date, p.close AS base_close FROM ev ASOF LEFT JOIN prices p ON ev.ticker = p.ticker AND p.date >= ev.event_date),
f AS (SELECT b.*, forward_days, event_date + forward_days AS target FROM b, (SELECT unnest([5, 20, 60])::INTEGER AS forward_days)),
ret AS (SELECT f.*, CASE WHEN base_close > 0 THEN (p.close - base_close) / base_close END AS r FROM f ASOF LEFT JOIN prices p ON f.ticker = p.ticker AND p.date >= f.target)"""


def closes(spark, sf_dir):
    """Prices, which are few next to the trades they are means of and are read several times."""
    return sinks.staged(prices(spark, sf_dir), "closes")


def study_returns(spark, sf_dir):
    ev = insiders(spark, sf_dir).where(F.col("included") & F.col("execution_date").between(F.lit(dt.date(1999, 1, 1)), ref()))
    ev = ev.select("record_id", "ticker", "direction", "sector", F.col("execution_date").alias("event_date"))
    return studies.forward_returns(ev, closes(spark, sf_dir), DAYS)


@query("j10_forward_returns", f"{EVENTS_SQL} SELECT record_id, forward_days, base_date, round(r, 6) AS forward_return FROM ret")
def j10(spark, sf_dir):
    return study_returns(spark, sf_dir).select("record_id", "forward_days", "base_date", F.round("forward_return", 6).alias("forward_return"))


@query("j11_price_returns", f"{WITH}, {PRICES_SQL} SELECT a.ticker, a.date, round((p.close - a.close) / a.close, 6) AS forward_return FROM prices a ASOF JOIN prices p ON a.ticker = p.ticker AND p.date >= a.date + 20")
def j11(spark, sf_dir):
    return studies.price_returns(closes(spark, sf_dir), 20).withColumn("forward_return", F.round("forward_return", 6))


_REGIME_SQL = f"""{WITH}, {PRICES_SQL}, {BENCHMARK_SQL}, d AS (SELECT unnest(CAST(generate_series(DATE '1999-01-01', DATE '1999-12-01', INTERVAL 1 MONTH) AS DATE[])) AS reference_date),
g AS (SELECT reference_date, count(date) AS n, arg_min(close, date) AS a, arg_max(close, date) AS b FROM d LEFT JOIN bench ON date BETWEEN reference_date - 61 AND reference_date - 1 GROUP BY ALL),
c AS (SELECT reference_date, CASE WHEN n >= 2 THEN (b - a) / a END AS change FROM g)"""


@query("j12_trailing_regime", f"{_REGIME_SQL} SELECT reference_date, round(change, 6) AS change, CASE WHEN change IS NULL THEN 'unknown' WHEN change <= -0.02 THEN 'bear' WHEN change >= 0.08 THEN 'bull' ELSE 'neutral' END AS regime, CAST(CASE WHEN change <= -0.02 THEN 1.1 WHEN change >= 0.08 THEN 0.95 ELSE 1.0 END AS DOUBLE) AS weight FROM c")
def j12(spark, sf_dir):
    dates = table(spark, sf_dir, "region").limit(1).select(F.explode(F.sequence(F.lit(dt.date(1999, 1, 1)), F.lit(dt.date(1999, 12, 1)), F.expr("interval 1 month"))).alias("reference_date"))
    return studies.trailing_regime(dates, benchmark_prices(spark, sf_dir)).withColumn("change", F.round("change", 6))


@query(
    "a19_trade_event_study",
    f"""{EVENTS_SQL} SELECT forward_days, direction, count(*) AS n, round(avg(CASE WHEN direction = 'BUY' THEN (r > 0)::INT ELSE (r < 0)::INT END), 6) AS accuracy, round(avg(r), 6) AS mean_return FROM ret WHERE r IS NOT NULL GROUP BY GROUPING SETS ((forward_days), (forward_days, direction))""",
)
def a19(spark, sf_dir):
    s = studies.directional_study(study_returns(spark, sf_dir), [[], ["direction"]], F.col("direction") == "BUY")
    return s.select("forward_days", "direction", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_return", 6).alias("mean_return"))


@query(
    "a18_signal_event_study",
    f"""{EVENTS_SQL} SELECT forward_days, direction, sector, count(*) AS n, round(avg(CASE WHEN direction = 'BUY' THEN (r > 0)::INT ELSE (r < 0)::INT END), 6) AS accuracy, round(avg(r), 6) AS mean_return FROM ret WHERE r IS NOT NULL GROUP BY GROUPING SETS ((forward_days), (forward_days, direction), (forward_days, sector))""",
)
def a18(spark, sf_dir):
    s = studies.directional_study(study_returns(spark, sf_dir), [[], ["direction"], ["sector"]], F.col("direction") == "BUY")
    return s.select("forward_days", "direction", "sector", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_return", 6).alias("mean_return"))


@query("a20_baseline_study", f"{EVENTS_SQL} SELECT forward_days, count(*) AS n, round(avg((r > 0)::INT), 6) AS accuracy, round(avg(r), 6) AS mean_return FROM ret WHERE r IS NOT NULL AND direction = 'BUY' GROUP BY forward_days")
def a20(spark, sf_dir):
    s = studies.directional_study(study_returns(spark, sf_dir).where("direction = 'BUY'"), [[]], F.lit(True))
    return s.select("forward_days", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_return", 6).alias("mean_return"))


@query(
    "a21_regime_study",
    f"""{EVENTS_SQL}, s AS (SELECT DISTINCT event_date, event_date - 60 AS back FROM ev), x AS (SELECT s.event_date, s.back, p.date AS d1, p.close AS c1 FROM s ASOF LEFT JOIN bench p ON p.date >= s.event_date),
    y AS (SELECT x.*, p.date AS d0, p.close AS c0 FROM x ASOF LEFT JOIN bench p ON p.date >= x.back), z AS (SELECT event_date, CASE WHEN d0 IS NULL OR d1 IS NULL OR d0 = d1 THEN NULL WHEN c1 > c0 THEN 'bull' ELSE 'bear' END AS regime FROM y)
    SELECT forward_days, regime, count(*) AS n, round(avg((r > 0)::INT), 6) AS accuracy, round(avg(r), 6) AS mean_return FROM ret JOIN z USING (event_date) WHERE r IS NOT NULL AND direction = 'BUY' AND regime IS NOT NULL GROUP BY ALL""",
)
def a21(spark, sf_dir):
    returns = study_returns(spark, sf_dir).where("direction = 'BUY'")
    bench = sinks.staged(benchmark_prices(spark, sf_dir), "benchmark").withColumn("ticker", F.lit("benchmark"))
    dates = returns.select("event_date").distinct().withColumns({"ticker": F.lit("benchmark"), "back": F.date_sub("event_date", 60)})
    now = studies.asof_forward(dates, bench, "ticker", "event_date").withColumnsRenamed({"found_date": "d1", "found_close": "c1"})
    both = studies.asof_forward(now, bench, "ticker", "back")
    regime = F.when(F.col("found_date").isNull() | F.col("d1").isNull() | (F.col("found_date") == F.col("d1")), None).when(F.col("c1") > F.col("found_close"), "bull").otherwise("bear")
    joined = returns.join(both.select("event_date", regime.alias("regime")), "event_date").where("regime is not null")
    s = studies.directional_study(joined, [["regime"]], F.lit(True))
    return s.select("forward_days", "regime", "n", F.round("accuracy", 6).alias("accuracy"), F.round("mean_return", 6).alias("mean_return"))


@query(
    "a22_sector_relative_study",
    f"""{EVENTS_SQL}, sp AS (SELECT sector, date, round(avg(close), 6) AS close FROM prices JOIN (SELECT DISTINCT ticker, sector FROM trades) USING (ticker) GROUP BY ALL),
    sb AS (SELECT r.*, p.close AS sbase FROM ret r ASOF LEFT JOIN sp p ON r.sector = p.sector AND p.date >= r.event_date), sr AS (SELECT sb.*, CASE WHEN sbase > 0 THEN (p.close - sbase) / sbase END AS er FROM sb ASOF LEFT JOIN sp p ON sb.sector = p.sector AND p.date >= sb.target)
    SELECT forward_days, count(*) AS n, round(avg((r - er > 0)::INT), 6) AS outperform, round(avg(r - er), 6) AS mean_excess, avg((r - er > 0)::INT) > 0.55 AS alpha FROM sr WHERE r IS NOT NULL AND er IS NOT NULL AND direction = 'BUY' GROUP BY forward_days""",
)
def a22(spark, sf_dir):
    stock = study_returns(spark, sf_dir).where("direction = 'BUY'")
    sectors = trades(spark, sf_dir).select("ticker", "sector").distinct()
    index = sinks.staged(prices(spark, sf_dir).join(sectors, "ticker").groupBy("sector", "date").agg(F.round(F.avg("close"), 6).alias("close")), "index")
    base = studies.asof_forward(stock.withColumn("target", F.expr("date_add(event_date, forward_days)")), index, "sector", "event_date").withColumnsRenamed({"found_date": "sd", "found_close": "sbase"})
    both = studies.asof_forward(base, index, "sector", "target")
    excess = F.col("forward_return") - F.when(F.col("sbase") > 0, (F.col("found_close") - F.col("sbase")) / F.col("sbase"))
    known = both.withColumn("excess", excess).where("excess is not null")
    ahead = F.avg((F.col("excess") > 0).cast("double"))
    return known.groupBy("forward_days").agg(F.count("*").alias("n"), F.round(ahead, 6).alias("outperform"), F.round(F.avg("excess"), 6).alias("mean_excess"), (ahead > 0.55).alias("alpha"))


@query("a31_pearson", f"{WITH} SELECT ticker, count(*) AS n, round(CASE WHEN count(*) >= 3 AND stddev_pop(shares) > 0 AND stddev_pop(price) > 0 THEN corr(shares, price) END, 6) AS correlation FROM trades GROUP BY ticker")
def a31(spark, sf_dir):
    return studies.pearson(trades(spark, sf_dir), ["ticker"], "shares", "price").withColumn("correlation", F.round("correlation", 6))


_GRID = [0.03, 0.06, 0.09, 0.12, 0.15]


@query(
    "a29_sensitivity_sweep",
    f"""{LEGISLATOR_SQL}, leg1 AS (SELECT leg.*, cap FROM leg, (SELECT unnest([0.03, 0.06, 0.09, 0.12, 0.15]::DOUBLE[]) AS cap)), {positioning_sql('cap').replace('FROM leg ', 'FROM leg1 leg ').replace('* 0.05 AS lim', '* cap AS lim')}
    SELECT round(cap, 2) AS cap, round(breadth, 6) AS breadth, round(volume_net, 2) AS volume_net, members_capped FROM pos""",
)
def a29(spark, sf_dir):
    p = signals.cap_sweep(legislator_scores(spark, sf_dir), _GRID)
    return p.select("cap", F.round("breadth", 6).alias("breadth"), F.round("volume_net", 2).alias("volume_net"), "members_capped")


@query(
    "a30_breadth_vs_volume",
    f"""{LEGISLATOR_SQL}, {positioning_sql('ticker')}, v AS (SELECT ticker, breadth AS b, CASE WHEN volume_buy + volume_sell > 0 THEN volume_net / (volume_buy + volume_sell) ELSE 0 END AS s FROM pos),
    d AS (SELECT *, CASE WHEN b > 0.1 THEN 'bullish' WHEN b < -0.1 THEN 'bearish' ELSE 'neutral' END AS bd, CASE WHEN s > 0.1 THEN 'bullish' WHEN s < -0.1 THEN 'bearish' ELSE 'neutral' END AS vd FROM v)
    SELECT ticker, round(s, 6) AS volume_share, bd AS breadth_direction, vd AS volume_direction, (bd <> vd AND bd <> 'neutral' AND vd <> 'neutral') OR abs(b - s) > 0.3 AS diverging FROM d""",
)
def a30(spark, sf_dir):
    b = history.breadth_vs_volume(signals.positioning(legislator_scores(spark, sf_dir), ["ticker"]))
    return b.select("ticker", F.round("volume_share", 6).alias("volume_share"), "breadth_direction", "volume_direction", "diverging")


@query(
    "w5_divergence_periods",
    f"""{WITH}, s AS (SELECT execution_date AS date, (count(*) FILTER (code = 'P') - count(*) FILTER (code = 'S')) / count(*) AS b, sum(CASE code WHEN 'P' THEN value WHEN 'S' THEN -value ELSE 0 END) / sum(value) AS v FROM trades WHERE execution_date BETWEEN DATE '1999-01-01' AND {D0} GROUP BY 1),
    r AS (SELECT *, b * v < 0 OR abs(b - v) > 0.3 AS apart, row_number() OVER (ORDER BY date) AS i, max(date) OVER () AS last FROM s), q AS (SELECT *, i - row_number() OVER (ORDER BY date) AS island FROM r WHERE apart)
    SELECT min(date) AS start_date, max(date) AS end_date, CAST(max(date) - min(date) AS INTEGER) AS days, round(max(abs(b - v)), 6) AS max_gap, max(date) = any_value(last) AS ongoing FROM q GROUP BY island""",
)
def w5(spark, sf_dir):
    t = trades(spark, sf_dir).where(F.col("execution_date").between(F.lit(dt.date(1999, 1, 1)), ref()))
    signed = F.sum(F.when(F.col("code") == "P", F.col("value")).when(F.col("code") == "S", -F.col("value")).otherwise(0))
    s = t.groupBy(F.col("execution_date").alias("date")).agg(((F.count_if(F.col("code") == "P") - F.count_if(F.col("code") == "S")) / F.count("*")).alias("breadth"), (signed / F.sum("value")).alias("volume"))
    return history.divergence_periods(s).withColumn("max_gap", F.round("max_gap", 6))


def _entities(spark, sf_dir):
    """Suppliers as canonical entities; two share an alias."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("entity:s"), k.cast("string")).alias("entity_key"), F.lit(None).cast("string").alias("instrument_key"), F.when(k % 3 == 0, F.concat(F.lit("T"), k.cast("string"))).alias("ticker"),
        F.when(k % 3 == 1, F.lpad(k.cast("string"), 10, "0")).alias("cik"), F.array(F.concat(F.lit("Supplier "), F.translate(k.cast("string"), "0123456789", "ABCDEFGHIJ"), F.lit(" Company")), F.when(k % 10 == 0, "Shared Name Holding").otherwise("x")).alias("aliases"),
    )


def _issuers(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").distinct()
    k, m = F.col("l_suppkey"), F.col("l_orderkey") % 5
    return line.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_suppkey").alias("record_id"), F.lit("insider").alias("source"), F.when(m == 0, F.concat(F.lit("T"), k.cast("string"))).when(m == 4, F.concat(F.lit("Z"), k.cast("string"))).alias("ticker"),
        F.when(m == 1, F.lpad(k.cast("string"), 10, "0")).alias("cik"), F.when(m == 2, F.concat(F.lit("supplier "), F.translate(k.cast("string"), "0123456789", "ABCDEFGHIJ"), F.lit(" Company Common Stock"))).when(m == 3, F.when(k % 2 == 0, "shared name holding")).alias("issuer_name"),
        k.alias("_k"), m.alias("_m"),
    )


@query(
    "j1_resolve_entities",
    """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey AS k, l_orderkey % 5 AS m FROM lineitem),
    c AS (SELECT concat_ws(':', l_orderkey, l_linenumber, k) AS record_id, k, CASE WHEN m = 0 AND k % 3 = 0 THEN 'ticker' WHEN m = 1 AND k % 3 = 1 THEN 'cik' WHEN m = 2 THEN 'alias' WHEN m = 3 AND k % 2 = 0 THEN CASE WHEN (SELECT count(*) FROM supplier WHERE s_suppkey % 10 = 0) > 1 THEN 'aliases' ELSE 'alias1' END
      WHEN m IN (0, 4) THEN 'passthrough' ELSE 'none' END AS evidence, m FROM r)
    SELECT record_id, evidence_ AS evidence, CASE evidence WHEN 'aliases' THEN 'AMBIGUOUS' WHEN 'none' THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS status, CASE evidence WHEN 'ticker' THEN 'entity:s' || k WHEN 'cik' THEN 'entity:s' || k WHEN 'alias' THEN 'entity:s' || k WHEN 'alias1' THEN (SELECT 'entity:s' || min(s_suppkey) FROM supplier WHERE s_suppkey % 10 = 0)
      WHEN 'passthrough' THEN CASE m WHEN 0 THEN 'entity:t' || k ELSE 'entity:z' || k END END AS entity_key, CAST(CASE evidence_ WHEN 'ticker' THEN 0.99 WHEN 'cik' THEN 0.97 WHEN 'alias' THEN 0.9 WHEN 'aliases' THEN 0.4 WHEN 'passthrough' THEN 0.95 ELSE 0 END AS DOUBLE) AS confidence,
      sha256('insider|' || record_id || '|v2') AS event_id FROM (SELECT *, CASE evidence WHEN 'alias1' THEN 'alias' ELSE evidence END AS evidence_ FROM c)""",
)
def j1(spark, sf_dir):
    return resolve.resolve_entities(_issuers(spark, sf_dir), _entities(spark, sf_dir)).select("record_id", "evidence", "status", "entity_key", "confidence", "event_id")


@query("j2_resolve_cik", "SELECT 'S' || s_suppkey || CASE s_suppkey % 4 WHEN 0 THEN '.A' WHEN 1 THEN '-A' ELSE '' END AS ticker, CASE WHEN s_suppkey % 4 IN (0, 1) THEN lpad(CAST(s_suppkey AS VARCHAR), 10, '0') WHEN s_suppkey % 4 = 2 THEN lpad(CAST(s_suppkey AS VARCHAR), 10, '1') END AS cik FROM supplier")
def j2(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    name = F.concat(F.lit("S"), k.cast("string"))
    tickers = s.select(F.concat(name, F.when(k % 4 == 0, ".A").when(k % 4 == 1, "-A").otherwise("")).alias("ticker"))
    known = s.where(k % 4 != 3).select(F.concat(name, F.when(k % 4 == 0, "-A").when(k % 4 == 1, "A").otherwise("")).alias("ticker"), F.lpad(k.cast("string"), 10, "0").alias("cik"), k.alias("k"))
    known = known.withColumn("cik", F.when(F.col("k") % 4 == 2, F.lpad(F.col("k").cast("string"), 10, "1")).otherwise(F.col("cik"))).drop("k")
    return resolve.resolve_cik(tickers, known)


@query(
    "j3_resolve_filers",
    """WITH m AS (SELECT c_custkey AS id, 'name' || c_custkey % 40 || ' last' || c_custkey % 60 AS norm, 'last' || c_custkey % 60 AS last, 's' || c_nationkey AS state FROM customer),
    n AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 2 WHEN 0 THEN 'name' || o_custkey % 40 || ' last' || o_custkey % 60 ELSE 'other last' || o_custkey % 60 END AS norm, 'last' || o_custkey % 60 AS last, 's' || c_nationkey AS state FROM orders JOIN customer ON c_custkey = o_custkey),
    e AS (SELECT norm, min(id) AS eid FROM m GROUP BY norm), l AS (SELECT last, count(*) AS c, min(id) AS lid FROM m GROUP BY last), s AS (SELECT last, state, count(*) AS c, min(id) AS sid FROM m GROUP BY ALL)
    SELECT o_orderkey, coalesce(eid, CASE WHEN l.c = 1 THEN lid END, CASE WHEN s.c = 1 THEN sid END) AS member_id FROM n LEFT JOIN e USING (norm) LEFT JOIN l USING (last) LEFT JOIN s ON s.last = n.last AND s.state = n.state""",
)
def j3(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    last = lambda c: F.concat(F.lit(" last"), (F.col(c) % 60).cast("string"))
    full = lambda c: F.concat(F.lit("name"), (F.col(c) % 40).cast("string"), last(c))
    state = F.concat(F.lit("s"), F.col("c_nationkey").cast("string"))
    members = customer.select(F.col("c_custkey").alias("member_id"), full("c_custkey").alias("norm"), state.alias("state"), F.col("c_custkey").alias("position"))
    names = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, full("o_custkey")).otherwise(F.concat(F.lit("other"), last("o_custkey"))).alias("norm"), state.alias("state"))
    return resolve.resolve_filers(names, members).select("o_orderkey", "member_id")


@query("j5_sector_lookup", f"{WITH} SELECT record_id, CASE WHEN ticker LIKE '%A' THEN 'Unknown' ELSE sector END AS sector FROM trades")
def j5(spark, sf_dir):
    t = trades(spark, sf_dir)
    sectors = t.where(~F.endswith("ticker", F.lit("A"))).select("ticker", "sector").distinct().withColumn("industry", F.lit("any"))
    return resolve.sector_lookup(t.select("record_id", "ticker"), sectors).select("record_id", "sector")


@query(
    "j13_exercise_and_sell",
    f"""{WITH} SELECT s.record_id FROM trades s WHERE s.code = 'S' AND EXISTS (SELECT 1 FROM trades m WHERE m.code = 'M' AND m.actor_id = s.actor_id AND abs(m.execution_date - s.execution_date) <= 3 AND abs(s.shares - m.shares) <= m.shares * CAST(0.1 AS DOUBLE))""",
)
def j13(spark, sf_dir):
    return resolve.exercise_and_sell(trades(spark, sf_dir)).select("record_id")


@query(
    "j14_supersede_amendments",
    """WITH f AS (SELECT o_orderkey AS filing_id, o_custkey % 50 AS issuer, o_custkey AS owner, date_trunc('year', o_orderdate) AS period, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 = 0 AS am FROM orders),
    m AS (SELECT issuer, owner, period, max((d, filing_id)) AS top FROM f WHERE am GROUP BY ALL) SELECT filing_id, am AS is_amendment FROM f LEFT JOIN m USING (issuer, owner, period) WHERE top IS NULL OR (d, filing_id) >= top""",
)
def j14(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filing_id"), (F.col("o_custkey") % 50).alias("issuer"), F.col("o_custkey").alias("owner"), F.trunc("o_orderdate", "year").alias("period"), F.col("o_orderdate").cast("date").alias("filing_date"), (F.col("o_orderkey") % 4 == 0).alias("is_amendment"))
    return resolve.supersede_amendments(o).select("filing_id", "is_amendment")


@query(
    "j15_crossref",
    f"""{WITH}, s AS (SELECT ticker, source, sum(CASE code WHEN 'P' THEN value ELSE 0 END) AS b, sum(CASE code WHEN 'S' THEN value ELSE 0 END) AS s FROM trades WHERE execution_date >= {D0} - 365 GROUP BY ALL),
    l AS (SELECT * FROM s WHERE source = 'congress' ORDER BY b + s DESC, ticker LIMIT 20), n AS (SELECT l.ticker, l.b - l.s AS ln, i.b - i.s AS inn FROM l JOIN s i ON i.ticker = l.ticker AND i.source = 'insider')
    SELECT ticker, round(ln, 2) AS legislator_net, round(inn, 2) AS insider_net, CASE WHEN ln > 0 AND inn > 0 THEN 'BOTH_BULLISH' WHEN ln < 0 AND inn < 0 THEN 'BOTH_BEARISH' WHEN ln * inn < 0 THEN 'DIVERGENT' ELSE 'MIXED' END AS agreement FROM n""",
)
def j15(spark, sf_dir):
    t = trades(spark, sf_dir).where(F.col("execution_date") >= F.date_sub(ref(), 365))
    x = resolve.crossref(t.where("source = 'congress'"), t.where("source = 'insider'"), 20)
    return x.select("ticker", F.round("legislator_net", 2).alias("legislator_net"), F.round("insider_net", 2).alias("insider_net"), "agreement")


def _congress(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    return t.select(F.col("record_id").alias("id"), "ticker", "action", F.col("execution_date").alias("date"), F.col("value").alias("amount"), F.col("filing_id").alias("k"))


def _vendor(base):
    """Congress trades and a vendor's view of them."""
    theirs = base.where("k % 3 <> 0").withColumns({"id": F.concat(F.lit("v:"), "id"), "date": F.date_add("date", (F.col("k") % 9).cast("int")), "ticker": F.when(F.col("k") % 5 == 0, "OTHER").otherwise(F.col("ticker"))})
    return base.drop("k"), theirs.drop("k")


VENDOR_SQL = f"""{WITH}, a AS (SELECT record_id AS id, ticker, action, execution_date AS date, value AS amount, filing_id AS k FROM trades WHERE source = 'congress' AND execution_date BETWEEN DATE '1999-10-01' AND DATE '1999-12-31'),
b AS (SELECT 'v:' || id AS id, CASE WHEN k % 5 = 0 THEN 'OTHER' ELSE ticker END AS ticker, action, date + CAST(k % 9 AS INTEGER) AS date, amount FROM a WHERE k % 3 <> 0),
p AS (SELECT a.id AS a_id, b.id AS b_id, round((a.ticker = b.ticker)::INT * 0.5::DOUBLE + (a.action = b.action)::INT * 0.2::DOUBLE + (abs(a.date - b.date) <= 7)::INT * 0.2::DOUBLE + (abs(a.amount - b.amount) <= 0.1 * greatest(a.amount, b.amount))::INT * 0.1::DOUBLE, 4) AS score FROM a, b)"""


@query("j16_vendor_pair_scores", f"{VENDOR_SQL} SELECT a_id, b_id, score FROM p WHERE score >= 0.5")
def j16(spark, sf_dir):
    return resolve.vendor_pair_scores(*_vendor(_congress(spark, sf_dir).where("date between date'1999-10-01' and date'1999-12-31'")))


@query("j16c_vendor_pair_scores_all")
def j16c(spark, sf_dir):
    return resolve.vendor_pair_scores(*_vendor(_congress(spark, sf_dir)))


@query("j16b_match_vendor_trades")
def j16b(spark, sf_dir):
    return matching.match_trades(*_vendor(_congress(spark, sf_dir)))


@query("j17_companies_with_new_filings", f"{WITH} SELECT DISTINCT ticker FROM trades WHERE filing_id IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")
def j17(spark, sf_dir):
    new = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).select(F.col("o_orderkey").alias("filing_id"))
    return trades(spark, sf_dir).join(new, "filing_id", "left_semi").select("ticker").distinct()


@query(
    "j20_reconcile_senators",
    f"""{WITH}, a AS (SELECT actor_id, count(*) AS ours FROM trades WHERE source = 'congress' AND actor_id % 10 < 9 GROUP BY 1), b AS (SELECT actor_id, count(*) AS theirs FROM trades WHERE source = 'congress' AND actor_id % 10 > 0 AND NOT planned GROUP BY 1),
    j AS (SELECT actor_id, coalesce(ours, 0) AS ours, coalesce(theirs, 0) AS theirs FROM a FULL JOIN b USING (actor_id)) SELECT actor_id, ours, theirs, CASE WHEN theirs = 0 THEN 'only_ours' WHEN ours = 0 THEN 'only_theirs' ELSE 'both' END AS status, abs(ours - theirs) > 5 OR abs(ours - theirs) / greatest(ours, theirs) > 0.2 AS flagged FROM j""",
)
def j20(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    return resolve.reconcile_counts(t.where("actor_id % 10 < 9"), t.where("actor_id % 10 > 0 and not planned"), "actor_id")


@query("j21_new_filings_only", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j21(spark, sf_dir):
    known = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(known, "o_orderkey", "left_anti")


@query("a36_compare_to_golden", f"""{WITH}, a AS (SELECT actor_id, count(*) AS n, sum(shares) AS s FROM trades WHERE actor_id % 7 > 0 GROUP BY 1), b AS (SELECT actor_id, count(*) AS n, sum(shares) + CASE WHEN actor_id % 5 = 0 THEN 1 ELSE 0 END AS s FROM trades WHERE actor_id % 11 > 0 GROUP BY 1)
    SELECT coalesce(a.actor_id, b.actor_id) AS actor_id, CASE WHEN a.n IS NULL THEN 'missing' WHEN b.n IS NULL THEN 'extra' WHEN abs(a.s - b.s) > 1e-6 THEN 'score' END AS kind FROM a FULL JOIN b ON a.actor_id = b.actor_id WHERE a.n IS NULL OR b.n IS NULL OR abs(a.s - b.s) > 1e-6""")
def a36(spark, sf_dir):
    g = trades(spark, sf_dir).groupBy("actor_id").agg(F.count("*").cast("string").alias("label"), F.sum("shares").alias("score"))
    return resolve.compare_to_golden(g.where("actor_id % 7 > 0"), g.where("actor_id % 11 > 0").withColumn("score", F.col("score") + F.when(F.col("actor_id") % 5 == 0, 1.0).otherwise(0.0)), "actor_id")


@query("k1_upsert", f"{WITH} SELECT short_id, any_value(record_id ORDER BY code = 'P' DESC, record_id DESC) AS record_id FROM trades WHERE TRUE GROUP BY short_id".replace("any_value(record_id ORDER BY", "first(record_id ORDER BY"))
def k1(spark, sf_dir):
    t = trades(spark, sf_dir).select("short_id", "record_id", "code")
    path = sinks.staging_path(spark, "upsert")
    sinks.upsert(t.where("code <> 'P'"), path, ["short_id"], "record_id")
    return sinks.upsert(t.where("code = 'P'"), path, ["short_id"], "record_id").select("short_id", "record_id")


@query("k4_replace_filing_rows", f"{WITH} SELECT filing_id, record_id, CASE WHEN filing_id % 5 = 0 THEN shares * 2 ELSE shares END AS shares FROM trades WHERE filing_id % 5 <> 0 OR code = 'P' OR filing_id NOT IN (SELECT filing_id FROM trades WHERE filing_id % 5 = 0 AND code = 'P')".replace("THEN shares * 2", "AND code = 'P' THEN shares * 2"))
def k4(spark, sf_dir):
    t = trades(spark, sf_dir).select("filing_id", "record_id", "shares", "code")
    new = t.where("filing_id % 5 = 0 and code = 'P'").withColumn("shares", F.col("shares") * 2)
    return sinks.replaced_filing_rows(t, new).select("filing_id", "record_id", "shares")


@query("k7_render_report", f"""{WITH}, g AS (SELECT ticker, sum(CASE code WHEN 'P' THEN value WHEN 'S' THEN -value ELSE 0 END) AS net, count(*) AS n FROM trades GROUP BY ticker)
    SELECT 'positions' AS section, CAST(row_number() OVER (ORDER BY ticker) AS INTEGER) AS position, ticker || ': ' || CASE WHEN net < 0 THEN '-' ELSE '+' END || '$' || CASE WHEN abs(net) >= 1e9 THEN printf('%.1fB', abs(net) / 1e9) WHEN abs(net) >= 1e6 THEN printf('%.1fM', abs(net) / 1e6) WHEN abs(net) >= 1e3 THEN printf('%.1fK', abs(net) / 1e3) ELSE printf('%.0f', abs(net)) END || ' in ' || n || ' trades' AS line FROM g""")
def k7(spark, sf_dir):
    signed = F.sum(F.when(F.col("code") == "P", F.col("value")).when(F.col("code") == "S", -F.col("value")).otherwise(0))
    g = trades(spark, sf_dir).groupBy("ticker").agg(signed.alias("net"), F.count("*").alias("n"))
    return sinks.render_report(g, F.concat("ticker", F.lit(": "), sinks.money(F.col("net")), F.lit(" in "), F.col("n").cast("string"), F.lit(" trades")), "positions", ["ticker"])


@query("a27_resolution_metrics", f"{LEGISLATOR_SQL} SELECT chamber, action, count(*) AS n, round(count(*) FILTER (reason_code IS NULL) / count(*), 6) AS rate, round(sum(value) FILTER (reason_code IS NULL) / sum(value), 6) AS value_rate FROM legn GROUP BY ROLLUP (chamber, action)")
def a27(spark, sf_dir):
    t = legislators(spark, sf_dir)
    ok = F.col("included")
    return t.rollup("chamber", "action").agg(F.count("*").alias("n"), F.round(F.count_if(ok) / F.count("*"), 6).alias("rate"), F.round(F.sum(F.when(ok, F.col("value"))) / F.sum("value"), 6).alias("value_rate"))


@query("a34_store_status", f"{WITH} SELECT source, count(*) AS n, count(DISTINCT filing_id) AS filings, min(execution_date) AS first_date, max(execution_date) AS last_date, max(execution_date) < DATE '2001-12-31' - 90 AS stale FROM trades GROUP BY source")
def a34(spark, sf_dir):
    last = F.max("execution_date")
    return trades(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("filing_id").alias("filings"), F.min("execution_date").alias("first_date"), last.alias("last_date"), (last < F.date_sub(F.lit(dt.date(2001, 12, 31)), 90)).alias("stale"))


@query("a24_parse_quality", f"{LEGISLATOR_SQL}, g AS (SELECT coalesce(reason_code, 'included') AS reason, ticker, count(*) AS n FROM legn GROUP BY ALL) SELECT reason, ticker, n, CAST(row_number() OVER (PARTITION BY reason ORDER BY n DESC, ticker) AS INTEGER) AS place FROM g QUALIFY place <= 10")
def a24(spark, sf_dir):
    from pyspark.sql import Window as W

    g = legislators(spark, sf_dir).groupBy(F.coalesce("reason_code", F.lit("included")).alias("reason"), "ticker").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(W.partitionBy("reason").orderBy(F.desc("n"), "ticker"))).where("place <= 10")


@query("a38_ingest_summary", "SELECT o_orderstatus AS chamber, CASE WHEN o_orderkey % 3 = 0 THEN 'paper' ELSE 'electronic' END AS format, count(*) AS without_trades FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') GROUP BY ALL")
def a38(spark, sf_dir):
    with_trades = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    empty = table(spark, sf_dir, "orders").join(with_trades, "o_orderkey", "left_anti")
    return empty.groupBy(F.col("o_orderstatus").alias("chamber"), F.when(F.col("o_orderkey") % 3 == 0, "paper").otherwise("electronic").alias("format")).agg(F.count("*").alias("without_trades"))


_ = SECTORS
