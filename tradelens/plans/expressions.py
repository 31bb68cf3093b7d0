"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions import assets
from tradelens.functions import numeric as N
from tradelens.functions import text as T
from tradelens.functions.config import COMMITTEE_SECTORS, V1
from tradelens.plans.catalog import query
from tradelens.plans.trades import REFERENCE_DATE, TRADES_SQL, table, trades

def ref():
    """The reference date as a literal column."""
    return F.lit(REFERENCE_DATE)


WITH = f"WITH {TRADES_SQL}"
D0 = "DATE '2000-01-01'"


@query(
    "c1_entity_name_norm",
    r"""WITH a AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN p_name || ' Common Stock' WHEN 1 THEN 'A ' || p_name || ' CMN Class A' WHEN 2 THEN p_name || ', Inc. - Class B x'
      WHEN 3 THEN p_name || ' sponsored ADR' WHEN 4 THEN '--' ELSE p_brand || ' ' || p_name || ' CMIN' END AS name FROM part),
    b AS (SELECT id, name, replace(replace(lower(name), 'cmn class a', ' '), 'common stock', ' ') AS s FROM a),
    c AS (SELECT id, name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '\bcm[i|l]?n\b', ' ', 'g'), '\bclass\s+[a-z]\b', ' ', 'g'), '\bsponsored\s+adr\b', ' ', 'g'), '\badr\b', ' ', 'g') AS s FROM b),
    d AS (SELECT id, name, list_filter(string_split(trim(regexp_replace(regexp_replace(s, '\boc\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS t FROM c),
    e AS (SELECT id, name, t, len(t) AS n, coalesce(list_position(list_transform(t, lambda x: len(x) > 2), true), len(t) + 1) - 1 AS f FROM d),
    g AS (SELECT id, name, t[CAST(least(f, greatest(n - 2, 0)) AS BIGINT) + 1:] AS t FROM e),
    h AS (SELECT id, name, t, len(t) AS n, coalesce(list_position(list_reverse(list_transform(t, lambda x: len(x) > 1)), true), len(t) + 1) - 1 AS f FROM g)
    SELECT id, name, nullif(array_to_string(t[1:n - CAST(least(f, greatest(n - 2, 0)) AS BIGINT)], ' '), '') AS norm FROM h""",
)
def c1(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 6
    name = (
        F.when(k == 0, F.concat("p_name", F.lit(" Common Stock"))).when(k == 1, F.concat(F.lit("A "), "p_name", F.lit(" CMN Class A"))).when(k == 2, F.concat("p_name", F.lit(", Inc. - Class B x")))
        .when(k == 3, F.concat("p_name", F.lit(" sponsored ADR"))).when(k == 4, "--").otherwise(F.concat("p_brand", F.lit(" "), "p_name", F.lit(" CMIN")))
    )
    return p.select(F.col("p_partkey").alias("id"), name.alias("name")).withColumn("norm", T.entity_name_norm(F.col("name")))


@query(
    "c2_filer_name_norm",
    r"""WITH a AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'Hon. ' || c_name || ' Ann' WHEN 1 THEN 'Smith, Dr. ' || c_name WHEN 2 THEN 'Senator O''Neil  ' || c_mktsegment ELSE 'Mrs ' || c_name END AS name FROM customer),
    b AS (SELECT id, name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '\bhon\.?\s*', '', 'g'), '\bhonorable\.?\s*', '', 'g'), '\brep\.?\s*', '', 'g'),
      '\brepresentative\.?\s*', '', 'g'), '\bsen\.?\s*', '', 'g'), '\bsenator\.?\s*', '', 'g'), '\bmr\.?\s*', '', 'g'), '\bmrs\.?\s*', '', 'g'), '\bms\.?\s*', '', 'g'), '\bdr\.?\s*', '', 'g') AS s FROM a),
    c AS (SELECT id, name, CASE WHEN contains(s, ',') THEN trim(substr(s, strpos(s, ',') + 1)) || ' ' || trim(string_split(s, ',')[1]) ELSE s END AS s FROM b)
    SELECT id, name, nullif(trim(regexp_replace(regexp_replace(s, '[^a-z\s]', '', 'g'), '\s+', ' ', 'g')), '') AS norm FROM c""",
)
def c2(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit("Hon. "), "c_name", F.lit(" Ann"))).when(k == 1, F.concat(F.lit("Smith, Dr. "), "c_name")).when(k == 2, F.concat(F.lit("Senator O'Neil  "), "c_mktsegment")).otherwise(F.concat(F.lit("Mrs "), "c_name"))
    return c.select(F.col("c_custkey").alias("id"), name.alias("name")).withColumn("norm", T.filer_name_norm(F.col("name")))


@query(
    "c3_senator_name_norm",
    r"""WITH a AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'Senator ' || c_name || ' Jr.' WHEN 1 THEN 'hon. Ann   ' || c_mktsegment || ' III' ELSE c_name END AS name FROM customer),
    b AS (SELECT id, name, regexp_replace(regexp_replace(regexp_replace(upper(trim(name)), '^SENATOR ', ''), '^SEN\. ', ''), '^HON\. ', '') AS s FROM a)
    SELECT id, name, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, ' JR\.$', ''), ' JR$', ''), ' III$', ''), ' II$', ''), ' IV$', ''), '\s+', ' ', 'g')) AS norm FROM b""",
)
def c3(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat(F.lit("Senator "), "c_name", F.lit(" Jr."))).when(k == 1, F.concat(F.lit("hon. Ann   "), "c_mktsegment", F.lit(" III"))).otherwise(F.col("c_name"))
    return c.select(F.col("c_custkey").alias("id"), name.alias("name")).withColumn("norm", T.senator_name_norm(F.col("name")))


@query(
    "c4_ticker_canonical",
    """SELECT s_suppkey AS id, CASE t WHEN 'GOOG' THEN 'GOOGL' WHEN 'BRK.A' THEN 'BRK-B' WHEN 'BRK/A' THEN 'BRK-B' WHEN 'BF.B' THEN 'BF-B' WHEN 'BF/B' THEN 'BF-B' ELSE t END AS ticker
    FROM (SELECT s_suppkey, upper(trim((['goog ', 'brk.a', 'BRK/A', 'Bf.b', 'bf/b', 'aapl'])[CAST(s_suppkey % 6 + 1 AS INTEGER)])) AS t FROM supplier)""",
)
def c4(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, ["goog ", "brk.a", "BRK/A", "Bf.b", "bf/b", "aapl"])), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), T.ticker_canonical(raw).alias("ticker"))


_TYPES = ["Purchase", "Sale (Partial)", "Sale (Full)", "EXCHANGE", "gift", "Partial purchase"]


@query(
    "c5_txn_type_norm",
    f"""SELECT l_returnflag, raw, CASE WHEN contains(s, 'purchase') THEN 'purchase' WHEN contains(s, 'sale') AND contains(s, 'partial') THEN 'sale_partial' WHEN contains(s, 'sale') THEN 'sale' WHEN contains(s, 'exchange') THEN 'exchange' ELSE 'unknown' END AS kind, count(*) AS n
    FROM (SELECT l_returnflag, raw, lower(raw) AS s FROM (SELECT l_returnflag, ({_TYPES!r})[CAST(l_partkey % 6 + 1 AS INTEGER)] AS raw FROM lineitem)) GROUP BY ALL""",
)
def c5(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("l_partkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", raw.alias("raw")).agg(F.count("*").alias("n")).withColumn("kind", T.txn_type_norm(F.col("raw")))


_OWNERS = ["Self", " SPOUSE", "Dependent Child", "child", "Joint", "", "Trust"]


@query(
    "c6_owner_norm",
    f"""SELECT o_orderkey, CASE WHEN s = '' THEN 'self' WHEN s IN ('dependent child', 'child') THEN 'dependent' ELSE s END AS owner
    FROM (SELECT o_orderkey, lower(trim(({_OWNERS!r})[CAST(o_orderkey % 7 + 1 AS INTEGER)])) AS s FROM orders)""",
)
def c6(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, _OWNERS)), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.owner_norm(raw).alias("owner"))


@query("c7_direction", f"{WITH} SELECT code, action, direction, count(*) AS n FROM trades GROUP BY ALL")
def c7(spark, sf_dir):
    return trades(spark, sf_dir).groupBy("code", "action").agg(F.count("*").alias("n")).withColumn("direction", F.when(F.col("code") == "M", T.direction(F.col("action"))).otherwise(T.direction(F.col("code"))))


_AMOUNTS = ["$1,001 - $15,000", "x $15,001 - $50,000 y", "$12 - $3,400", "Over $50,000,000", "over $1,000,000", "none"]


@query(
    "c8_amount_bracket",
    f"""SELECT c_custkey AS id, CAST(CASE k WHEN 0 THEN 1001 WHEN 1 THEN 15001 WHEN 2 THEN 12 WHEN 3 THEN 50000001 WHEN 4 THEN 1000001 END AS BIGINT) AS low,
    CAST(CASE k WHEN 0 THEN 15000 WHEN 1 THEN 50000 WHEN 2 THEN 3400 WHEN 3 THEN 100000000 WHEN 4 THEN 2000002 END AS BIGINT) AS high FROM (SELECT c_custkey, c_custkey % 6 AS k FROM customer)""",
)
def c8(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, _AMOUNTS)), (F.col("c_custkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), T.amount_bracket(raw).alias("b")).select("id", "b.low", "b.high")


@query(
    "c9_txn_class",
    f"{WITH} SELECT code, CASE code WHEN 'P' THEN 'open_market_buy' WHEN 'S' THEN 'open_market_sell' WHEN 'M' THEN 'option_exercise' END AS class, CASE WHEN code = 'P' THEN 'other' ELSE 'unknown' END AS odd, count(*) AS n FROM trades GROUP BY ALL",
)
def c9(spark, sf_dir):
    grouped = trades(spark, sf_dir).groupBy("code").agg(F.count("*").alias("n"))
    return grouped.select("code", T.txn_class(F.lower("code")).alias("class"), T.txn_class(F.when(F.col("code") == "P", "Z").otherwise("")).alias("odd"), "n")


_ROLE_SQL = """
roles AS (SELECT t.*, CASE WHEN regexp_matches(lower(title), '\\bceo\\b|\\bchief executive officer\\b') THEN 'ceo' WHEN regexp_matches(lower(title), '\\bcfo\\b|\\bchief financial officer\\b') THEN 'cfo'
  WHEN regexp_matches(lower(title), '\\bchairman\\b') THEN 'chair' WHEN regexp_matches(regexp_replace(lower(title), 'vice ?president', '', 'g'), '\\bpresident\\b') THEN 'president' ELSE 'officer_other' END AS role FROM trades t)"""


@query("c10_role_class", f"{WITH}, {_ROLE_SQL} SELECT title, role, CASE WHEN role = 'officer_other' THEN 'officer_not_top_leadership: ' || title END AS reason, count(*) AS n FROM roles GROUP BY ALL")
def c10(spark, sf_dir):
    yes, no = F.lit(True), F.lit(False)
    r = T.role_class(F.col("title"), F.col("actor_name"), yes, no, no, no)
    return trades(spark, sf_dir).select("title", r.alias("r")).groupBy("title", "r.role", "r.reason").agg(F.count("*").alias("n"))


@query(
    "c11_planned_trade",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_discount >= CAST(0.09 AS DOUBLE) AS by_note, l_discount >= CAST(0.09 AS DOUBLE) OR l_linestatus = 'F' AS with_flag FROM lineitem",
)
def c11(spark, sf_dir):
    note = F.when(F.col("l_discount") >= 0.09, F.concat(F.lit("Sold under a Rule 10b5-1 plan "), F.col("l_partkey").cast("string"))).otherwise("gift to family")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.planned_trade(note).alias("by_note"), T.planned_trade(note, F.col("l_linestatus") == "F").alias("with_flag"))


_ASSETS = [
    ("Apple Inc Series A", "AAPL", None), ("US Treasury Bill", None, None), ("City and County GO", None, None), ("Vanguard Fund", "VFIAX", None), ("SPDR trust", "SPY", None), ("Bitcoin", None, None),
    ("Acme, LLC", None, None), ("Ford senior note", "F", None), ("Apple Inc", "AAPL", "ST"), ("Energy select", "XLE", "EF"), ("Dow Jones Industrial", "DIA", None), ("Something", None, None), ("Acme stock", "ACME", "OP"), ("Tesla 2x", "TSLL", None),
]
_CATEGORY = ["preferred_stock", "treasury", "municipal_bond", "mutual_fund", "broad_index_etf", "crypto", "private_placement", "corporate_bond", "common_stock", "sector_etf", "broad_index_etf", "unknown", "option", "single_stock_etf"]
_CONFIDENCE = [0.5, 0.0, 0.0, 0.5, 0.7, 0.0, 0.0, 0.5, 0.8, 0.9, 0.7, 0.0, 0.7, 0.7]
_WEIGHT = [0.6, 0, 0, 0, 0, 0, 0, 0, 1.0, 0.8, 0, 0, 0.7, 1.0]


def _assets(spark, sf_dir):
    k = (F.col("p_partkey") % len(_ASSETS) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(a[i]).cast("string") for a in _ASSETS]), k)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), pick(0).alias("name"), pick(1).alias("ticker"), pick(2).alias("type_code"))


@query("c12_asset_category", f"SELECT p_partkey AS id, ({_CATEGORY!r})[CAST(p_partkey % 14 + 1 AS INTEGER)] AS category FROM part")
def c12(spark, sf_dir):
    a = _assets(spark, sf_dir)
    return a.select("id", assets.asset_category(F.col("name"), F.col("ticker"), F.col("type_code")).alias("category"))


@query(
    "c13_asset_policy",
    f"""SELECT id, category, w > 0 AS include, CASE WHEN category = 'unknown' THEN 'asset_excluded:unresolved' WHEN w = 0 THEN 'asset_excluded:' || category END AS reason, c AS confidence, w AS weight
    FROM (SELECT p_partkey AS id, ({_CATEGORY!r})[CAST(p_partkey % 14 + 1 AS INTEGER)] AS category, CAST(({_CONFIDENCE!r})[CAST(p_partkey % 14 + 1 AS INTEGER)] AS DOUBLE) AS c, CAST(({_WEIGHT!r})[CAST(p_partkey % 14 + 1 AS INTEGER)] AS DOUBLE) AS w FROM part)""",
)
def c13(spark, sf_dir):
    a = _assets(spark, sf_dir).withColumn("category", assets.asset_category(F.col("name"), F.col("ticker"), F.col("type_code")))
    p = assets.asset_policy(F.col("category"), F.col("ticker"), F.col("type_code"))
    return a.withColumn("p", p).select("id", "category", "p.include", "p.reason", "p.confidence", "p.weight")


@query("c14_subject_key", f"{WITH} SELECT DISTINCT ticker, subject_key, ticker AS back FROM trades")
def c14(spark, sf_dir):
    return trades(spark, sf_dir).select("ticker", T.subject_key(F.col("ticker")).alias("subject_key")).distinct().withColumn("back", T.ticker_of(F.col("subject_key")))


@query("c15_fingerprint", f"{WITH} SELECT filing_id, sha256(string_agg(record_id, '|' ORDER BY record_id) || '|v2|2000-01-01|90') AS fingerprint FROM trades GROUP BY filing_id")
def c15(spark, sf_dir):
    ids = trades(spark, sf_dir).groupBy("filing_id").agg(F.collect_list("record_id").alias("ids"))
    return ids.select("filing_id", T.fingerprint(F.col("ids"), F.lit("v2"), F.lit("2000-01-01"), F.lit("90")).alias("fingerprint"))


_COMMITTEES = sorted(COMMITTEE_SECTORS)
_MAP_SQL = "MAP {" + ", ".join(f"'{k}': {v!r}" for k, v in COMMITTEE_SECTORS.items()) + "}"


@query(
    "c16_committee_sectors",
    f"""WITH a AS (SELECT c_custkey AS id, [({_COMMITTEES!r})[CAST(c_custkey % 21 + 1 AS INTEGER)], ({_COMMITTEES!r})[CAST(c_custkey % 5 + 1 AS INTEGER)] || '12', 'zzzz'] AS codes FROM customer)
    SELECT id, array_to_string(list_sort(list_distinct(flatten(list_transform(codes, lambda c: coalesce(({_MAP_SQL})[c[1:4]], []))))), ',') AS sectors FROM a""",
)
def c16(spark, sf_dir):
    names = F.array(*map(F.lit, _COMMITTEES))
    codes = F.array(F.element_at(names, (F.col("c_custkey") % 21 + 1).cast("int")), F.concat(F.element_at(names, (F.col("c_custkey") % 5 + 1).cast("int")), F.lit("12")), F.lit("zzzz"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.array_join(T.committee_sectors(codes), ",").alias("sectors"))


@query("c18_filing_format", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'paper' ELSE 'electronic' END AS format FROM orders")
def c18(spark, sf_dir):
    doc = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "822").otherwise("200"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.filing_format(doc).alias("format"))


@query("s11_asset_name_plausible", r"""SELECT p_partkey, len(p_name) >= 3 AND NOT regexp_matches(p_name, '^[\d|\s]+$') AND len(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) >= 4 AND len(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) / len(p_name) >= 0.45 AND regexp_matches(p_name, '[A-Za-z]{3,}') AS plausible FROM part""")
def s11(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.asset_name_plausible(F.col("p_name")).alias("plausible"))


_DAYS = f"greatest(0, date_diff('day', execution_date, {D0}))"
_SIZE = "CASE WHEN shares / (shares_after + shares) <= 0.01 THEN 0.5 WHEN shares / (shares_after + shares) <= 0.05 THEN 0.8 WHEN shares / (shares_after + shares) <= 0.20 THEN 1.0 ELSE 1.2 END"


@query(
    "m2_insider_weights",
    f"{WITH} SELECT record_id, round(shares / (shares_after + shares), 6) AS pct, CAST({_SIZE} AS DOUBLE) AS size, round(exp(-0.693 * {_DAYS} / 45.0), 6) AS recency FROM trades",
)
def m2(spark, sf_dir):
    t = trades(spark, sf_dir).withColumn("p", N.pct_holdings(F.col("shares"), F.col("shares_after")))
    return t.select("record_id", F.round("p", 6).alias("pct"), N.size_signal(F.col("p")).alias("size"), F.round(N.recency(F.col("execution_date"), ref()), 6).alias("recency"))


_RANK_SQL = f"""(CASE WHEN role IN ('ceo', 'cfo') THEN 3 WHEN role IN ('chair', 'president', 'coo') THEN 2 ELSE 1 END + CASE WHEN planned THEN 0 ELSE 2 END + CASE WHEN ownership = 'D' THEN 2 ELSE 0 END
 + CASE WHEN shares / (shares_after + shares) > 0.05 THEN 1 ELSE 0 END + CASE WHEN {_DAYS} < 14 THEN 1 ELSE 0 END)"""


@query("m5_insider_rank", f"{WITH}, {_ROLE_SQL} SELECT record_id, {_RANK_SQL} AS rank, CAST(5 AS INTEGER) AS entries FROM roles")
def m5(spark, sf_dir):
    no = F.lit(False)
    t = trades(spark, sf_dir).withColumn("role", T.role_class(F.col("title"), F.col("actor_name"), F.lit(True), no, no, no)["role"])
    r = N.insider_rank(F.col("role"), F.col("planned"), F.col("ownership"), N.pct_holdings(F.col("shares"), F.col("shares_after")), F.col("execution_date"), ref())
    return t.select("record_id", r.alias("r")).select("record_id", "r.rank", (F.size("r.factors") + F.size("r.missing")).alias("entries"))


@query(
    "m6_amount_estimate",
    f"{WITH} SELECT record_id, round(sqrt(value * value * 2), 4) AS geometric, round(value * 1.5, 4) AS midpoint, round(value / ln(2), 2) AS log_uniform FROM trades",
)
def m6(spark, sf_dir):
    low, high = F.col("value"), F.col("value") * 2
    return trades(spark, sf_dir).select("record_id", *[F.round(N.amount_estimate(low, high, m), 2 if m == "log_uniform" else 4).alias(a) for m, a in (("geometric_mean", "geometric"), ("midpoint", "midpoint"), ("log_uniform", "log_uniform"))])


_LAG = f"date_diff('day', execution_date, {D0})"


@query(
    "m7_staleness",
    f"""{WITH} SELECT record_id, round(CASE WHEN {_LAG} < 0 THEN 0.9 ELSE exp(-0.693 * {_LAG} / 60.0) END, 6) AS current, CAST(CASE WHEN {_LAG} <= 45 THEN 1.0 WHEN {_LAG} <= 60 THEN 0.9 WHEN {_LAG} <= 90 THEN 0.7 WHEN {_LAG} <= 180 THEN 0.4 ELSE 0.2 END AS DOUBLE) AS archive,
    CAST(CASE WHEN disclosure_date - execution_date <= 30 THEN 1.0 WHEN disclosure_date - execution_date <= 60 THEN 0.85 WHEN disclosure_date - execution_date <= 120 THEN 0.6 ELSE 0.3 END AS DOUBLE) AS lag_weight,
    CAST(CASE owner_type WHEN 'self' THEN 1.0 WHEN 'spouse' THEN 0.8 WHEN 'joint' THEN 0.9 WHEN 'dependent' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS owner FROM trades""",
)
def m7(spark, sf_dir):
    d = F.col("execution_date")
    return trades(spark, sf_dir).select("record_id", F.round(N.staleness(d, ref()), 6).alias("current"), N.staleness(d, ref(), V1).alias("archive"), N.disclosure_lag_weight(d, F.col("disclosure_date")).alias("lag_weight"), N.owner_weight(F.col("owner_type")).alias("owner"))


@query("m16_date_spine", "SELECT c_custkey AS id, unnest(CAST(generate_series(DATE '1999-01-01', DATE '1999-04-15', INTERVAL 1 MONTH) AS DATE[])) AS day FROM customer")
def m16(spark, sf_dir):
    import datetime as dt

    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.explode(N.date_spine(F.lit(dt.date(1999, 1, 20)), F.lit(dt.date(1999, 4, 15)))).alias("day"))


@query("m17_sweep_values", "SELECT s_suppkey AS id, unnest([0.03, 0.06, 0.09, 0.12, 0.15]) AS value FROM supplier")
def m17(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.explode(N.sweep_values(0.03, 0.15, 5)).alias("v")).select("id", F.round("v", 6).alias("value"))


@query(
    "s12_text_quality_gate",
    r"""SELECT doc_id, len(coalesce(text, '')) >= 50 AND len(regexp_replace(text, '[A-Za-z0-9\s]', '', 'g')) / len(text) <= 0.3 AND (regexp_matches(text, '\d{1,2}/\d{1,2}/\d{2,4}') OR regexp_matches(text, '\$[\d,]+')) AS passes FROM documents""",
)
def s12(spark, sf_dir):
    from tradelens.sources.text import text_quality_gate

    return table(spark, sf_dir, "documents").select("doc_id", text_quality_gate(F.col("text")).alias("passes"))
