"""Queries for rosters, stores, enrichment, briefs and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.functions import numeric as N
from tradelens.operators import alerts, overlay, reports, resolve, store
from tradelens.plans.catalog import ORACLES, query
from tradelens.plans.expressions import D0, WITH, ref
from tradelens.plans.signal_queries import A1_SQL, INSIDER_SQL, LEGISLATOR_SQL, OVERLAY_SQL, insider_results, insiders, legislators, memberships, sides, staged_sources
from tradelens.plans.source_queries import file_of, tag
from tradelens.plans.trades import table, trades
from tradelens.sources import forms, rosters

ROLE_SQL = """CASE actor_id % 4 WHEN 3 THEN 'excluded' WHEN 2 THEN 'excluded' ELSE CASE title WHEN 'Chief Executive Officer' THEN 'ceo' WHEN 'Chief Financial Officer' THEN 'cfo' WHEN 'Chairman' THEN 'chair' WHEN 'President' THEN 'president'
  ELSE CASE WHEN actor_id % 4 = 0 THEN 'officer_other' ELSE 'excluded' END END END"""


def spelled(column):
    """A number as a word of letters."""
    return F.translate(column.cast("string"), "0123456789", "abcdefghij")


def entities(spark, sf_dir) -> DataFrame:
    """Issuers of the adapter, every second of them, as canonical entities."""
    t = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 50).alias("k")).distinct().where("k % 2 = 0")
    ticker = F.concat(F.lit("T"), F.upper(F.translate(F.lpad(F.col("k").cast("string"), 2, "0"), "0123456789", "abcdefghij")))
    rows = t.select(
        ticker.alias("ticker"), F.when(F.col("k") % 4 == 0, F.lpad(F.col("k").cast("string"), 10, "0")).otherwise("").alias("cik"), F.concat(F.lit("entity:"), F.lower(ticker)).alias("entity_key"),
        F.concat(F.lit("instrument:"), F.lower(ticker), F.lit(":common")).alias("instrument_key"), F.concat(ticker, F.lit(" Company Inc.")).alias("issuer_name"), F.concat(F.lower(ticker), F.lit(" company|shared name")).alias("name_aliases"),
    )
    return rosters.read_canonical_entities(rows)


ENTITY_SQL = "e AS (SELECT DISTINCT s_suppkey % 50 AS k, 't' || translate(lpad(CAST(s_suppkey % 50 AS VARCHAR), 2, '0'), '0123456789', 'abcdefghij') AS t FROM supplier WHERE s_suppkey % 50 % 2 = 0)"


@query(
    "s16_read_canonical_entities",
    f"""WITH {ENTITY_SQL}, a AS (SELECT 'entity:' || t AS entity_key, unnest([t || ' company inc', t || ' company', 'shared name']) AS alias FROM e)
    SELECT alias, string_agg(entity_key, ',' ORDER BY entity_key) AS entity_keys FROM a GROUP BY alias""",
)
def s16(spark, sf_dir):
    return rosters.entities_by_alias(entities(spark, sf_dir)).select("alias", F.array_join("entity_keys", ",").alias("entity_keys"))


@query("s3_read_filing_sidecar", "SELECT 'f' || o_orderkey || '.html' AS file, CASE WHEN o_orderkey % 3 = 1 THEN 'Ann ' || o_custkey END AS filer_name, CASE WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS filing_date, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey % 2 = 0 AS VARCHAR) END AS is_paper FROM orders")
def s3(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    name = F.concat(F.lit("f"), k.cast("string"))
    body = F.to_json(F.struct(k.cast("string").alias("filing_id"), F.concat(F.lit("Ann "), F.col("o_custkey").cast("string")).alias("filer_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"), (k % 2 == 0).alias("is_paper")))
    side = o.where("o_orderkey % 3 > 0").select(F.concat(F.lit("cache/"), name, F.lit(".json")).alias("file"), F.when(k % 3 == 1, body).otherwise("{broken").alias("content"))
    out = rosters.read_filing_sidecar(o.select(F.concat(name, F.lit(".html")).alias("file")), side)
    return out.withColumns({"is_paper": F.col("is_paper").cast("string"), "filing_date": F.col("filing_date").cast("string")})


def members(spark, sf_dir, every: int = 3) -> DataFrame:
    """Every third customer (or ``every``-th) as a member with committees, written as roster responses and read back."""
    c, k = table(spark, sf_dir, "customer").where(F.col("c_custkey") % every == 0), F.col("c_custkey")
    member = F.struct(
        F.concat(F.lit("B"), k.cast("string")).alias("bioguideId"), F.concat(F.lit("Ann "), spelled(k)).alias("name"), F.lit("Independent").alias("partyName"), F.lit("Ohio").alias("state"),
        F.struct(F.array(F.struct(F.lit("Senate").alias("chamber")), F.struct(F.when(k % 2 == 0, "Senate").otherwise("House of Representatives").alias("chamber"))).alias("item")).alias("terms"),
    )
    bodies = c.groupBy(file_of(k).alias("file")).agg(F.to_json(F.struct(F.collect_list(member).alias("members"))).alias("body"))
    codes = F.when(k % 2 == 0, F.array(F.lit("SSBA"), F.lit("hsif01"))).otherwise(F.array(F.lit("hssy")))
    seats = c.where("c_custkey % 9 > 0").select(F.concat(F.lit("B"), k.cast("string")).alias("bioguide"), F.explode(codes).alias("code"), F.lit(None).cast("string").alias("title"))
    return rosters.read_members(bodies, seats)


@query(
    "s18_read_members",
    """SELECT 'B' || c_custkey AS bioguide, 'Ann ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') AS name, CASE WHEN c_custkey % 2 = 0 THEN 'Senate' ELSE 'House of Representatives' END AS chamber,
    CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'hsif01,ssba' ELSE 'hssy' END AS committees FROM customer WHERE c_custkey % 3 = 0""",
)
def s18(spark, sf_dir):
    return members(spark, sf_dir).select("bioguide", "name", "chamber", F.array_join(F.transform("committees", lambda c: c["code"]), ",").alias("committees"))


@query("s18b_read_members_all", ORACLES["s18_read_members"].replace(" WHERE c_custkey % 3 = 0", ""))
def s18b(spark, sf_dir):
    return members(spark, sf_dir, 1).select("bioguide", "name", "chamber", F.array_join(F.transform("committees", lambda c: c["code"]), ",").alias("committees"))


@query(
    "j4_enrich_committees",
    f"""{WITH} SELECT record_id, 'B' || actor_id AS bioguide, CASE WHEN actor_id % 9 = 0 THEN '' WHEN actor_id % 2 = 0 THEN 'ssba' ELSE 'hssy' END AS committees,
    CAST(CASE WHEN actor_id % 9 = 0 THEN FALSE WHEN actor_id % 2 = 0 THEN sector IN ('Communication Services', 'Energy', 'Financials', 'Health Care') ELSE sector IN ('Industrials', 'Technology') END AS VARCHAR) AS committee_sector_match
    FROM trades WHERE source = 'congress' AND actor_id % 3 = 0 UNION ALL SELECT record_id, NULL, NULL, NULL FROM trades WHERE source = 'congress' AND actor_id % 3 > 0""",
)
def j4(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    named = t.select("record_id", "ticker", F.concat(F.lit("Hon. Ann "), spelled(F.col("actor_id"))).alias("actor_name"))
    out = store.enrich_committees(named, members(spark, sf_dir), t.select("ticker", "sector").distinct())
    return out.select("record_id", "bioguide", F.array_join("committees", ",").alias("committees"), F.col("committee_sector_match").cast("string").alias("committee_sector_match"))


@query("s19b_read_price_file", f"{WITH} SELECT ticker, execution_date AS date, max(price) AS close FROM trades GROUP BY ALL")
def s19b(spark, sf_dir):
    path = sinks.staging_path(spark, "prices")
    trades(spark, sf_dir).select(F.lower("ticker").alias("ticker"), F.col("execution_date").alias("date"), F.col("price").alias("close")).write.parquet(path)
    return rosters.read_prices(spark, path)


@query(
    "s20b_read_vendor_json",
    f"""{WITH} SELECT upper(actor_name) AS name, ticker, action, execution_date AS date, CAST(CASE WHEN filing_id % 4 = 1 THEN 1001 ELSE 500 END AS DOUBLE) AS low, CAST(CASE WHEN filing_id % 4 = 1 THEN 15000 ELSE 500 END AS DOUBLE) AS high
    FROM trades WHERE source = 'congress'""",
)
def s20b(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    vendor = F.struct(
        F.col("actor_name").alias("Representative"), F.lower("ticker").alias("Ticker"), F.initcap("action").alias("Transaction"), F.date_format("execution_date", "MM/dd/yyyy").alias("TransactionDate"),
        F.when(F.col("filing_id") % 4 == 1, "$1,001 - $15,000").otherwise("$500").alias("Range"),
    )
    bodies = t.groupBy(F.col("filing_id").alias("file")).agg(F.to_json(F.collect_list(vendor)).alias("body"))
    return rosters.read_vendor_trades(bodies)


@query(
    "s24_read_filing_index",
    """SELECT 'atom' AS kind, 'a' || o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS filed, o_orderkey % 5 = 0 AS amended FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') >= '1997-01-01'
    UNION ALL SELECT 'search', 'h' || o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey % 5 = 0 FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL SELECT 'house', CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), FALSE FROM orders UNION ALL SELECT 'senate', printf('%08x-0', o_orderkey), strftime(o_orderdate, '%Y-%m-%d'), o_orderkey % 2 = 0 FROM orders""",
)
def s24(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day, text = F.date_format("o_orderdate", "yyyy-MM-dd"), k.cast("string")
    form = F.when(k % 5 == 0, "4/A").otherwise("4")
    entry = tag("entry", tag("content", F.concat(tag("accession-number", F.concat(F.lit("a"), text)), tag("filing-date", day), tag("filing-href", F.lit("x")), tag("filing-type", form))))
    feeds = o.groupBy(file_of(k).alias("file")).agg(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.collect_list(entry), ""), F.lit("</feed>")).alias("content"))
    atom = rosters.parse_atom_feed(feeds.select(F.lit("320193").alias("issuer_cik"), "content"), start="1997-01-01")
    hit = F.struct(F.struct(F.concat(F.lit("h"), text).alias("adsh"), F.array(F.when(k % 3 == 0, "0000000009").otherwise("0000320193")).alias("ciks"), form.alias("root_form"), day.alias("file_date")).alias("_source"))
    bodies = o.groupBy(file_of(k).alias("file")).agg(F.to_json(F.struct(F.struct(F.collect_list(hit).alias("hits")).alias("hits"))).alias("body"))
    search = rosters.parse_search_hits(bodies.select(F.lit("320193").alias("issuer_cik"), "body"))
    listed = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("accession").alias("id"), F.col("filing_date").alias("filed"), F.col("is_amendment").alias("amended"))
    cell = lambda c: tag("td", c)
    us_day = F.date_format("o_orderdate", "MM/dd/yyyy")
    house_row = tag("tr", F.concat(cell(F.concat(F.lit('<a href="/p/'), text, F.lit('.pdf">Ann</a>'))), cell(F.lit("OH-07")), cell(us_day)))
    senate_row = tag("tr", F.concat(cell(F.concat(F.lit("<a href='/view/"), F.when(k % 2 == 0, "paper").otherwise("ptr"), F.format_string("/%08x-0/'>Ann</a>", k))), cell(F.lit("OH")), cell(us_day)))
    page = lambda row: o.groupBy(file_of(k).alias("file")).agg(F.concat(F.lit("<table><tr><th>n</th></tr>"), F.array_join(F.collect_list(row), ""), F.lit("</table>")).alias("content"))
    result = lambda row, chamber: rosters.parse_result_table(page(row), chamber).select(F.lit(chamber).alias("kind"), F.col("filing_id").alias("id"), F.date_format("filing_date", "yyyy-MM-dd").alias("filed"), F.col("is_paper").alias("amended"))
    return listed(atom, "atom").unionByName(listed(search, "search")).unionByName(result(house_row, "house")).unionByName(result(senate_row, "senate"))


@query(
    "s25_filer_names",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS filing_id, CASE WHEN o_orderkey % 4 = 0 THEN 'Index ' || o_orderkey WHEN o_orderkey % 4 = 1 THEN 'Meta ' || (o_orderkey // 100) WHEN o_orderkey % 4 = 2 THEN 'Parsed' ELSE 'Unknown' END AS filer
    FROM orders""",
)
def s25(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = F.lpad(k.cast("string"), 10, "0")
    # ids with a letter behind share their first eight characters with none of the other kinds
    key = F.concat(F.lpad(F.floor(k / 100).cast("string"), 8, "0"), F.lpad((k % 100).cast("string"), 2, "0"))
    filings = o.select(key.alias("filing_id"), F.when(k % 4 == 2, "Parsed").alias("parsed_name"), (k % 4).alias("kind"))
    index = o.where("o_orderkey % 4 = 0").select(text.alias("doc_id"), F.concat(F.lit("Index "), k.cast("string")).alias("name"))
    meta = o.where("o_orderkey % 4 = 1").select(key.alias("filing_id"), F.concat(F.lit("Meta "), F.floor(k / 100).cast("string")).alias("name"))
    own = rosters.filer_names(filings.where("kind <> 2 and kind <> 3"), index, meta).unionByName(rosters.filer_names(filings.where("kind >= 2"), index, meta.limit(0)))
    return own.select("filing_id", "filer")


@query("m15_is_discretionary", f"{WITH} SELECT record_id, code IN ('P', 'S') AND NOT planned AS discretionary FROM trades WHERE source = 'insider'")
def m15(spark, sf_dir):
    return trades(spark, sf_dir).where("source = 'insider'").select("record_id", N.is_discretionary(F.col("code"), F.col("planned")).alias("discretionary"))


def form4_documents(t: DataFrame) -> DataFrame:
    """Insider trades as ownership documents; the owner's flags go by actor: officer, director, 10 % holder, a trust."""
    value = lambda name, column: tag(name, tag("value", column))
    text = lambda c: F.col(c).cast("string")
    same = ("filing_id", "ticker", "actor_id", "title")

    def txn(r: Column) -> Column:
        note = F.when(r["planned"], F.lit('<footnoteId id="F1"/>')).otherwise("")
        number = lambda c: r[c].cast("string")
        return tag("nonDerivativeTransaction", F.concat(
            value("securityTitle", F.lit("Common Stock")), value("transactionDate", F.date_format(r["execution_date"], "yyyy-MM-dd")), tag("transactionCoding", F.concat(tag("transactionCode", r["code"]), note)),
            tag("transactionAmounts", F.concat(value("transactionShares", number("shares")), value("transactionPricePerShare", number("price")))),
            tag("postTransactionAmounts", value("sharesOwnedFollowingTransaction", number("shares_after"))), tag("ownershipNature", value("directOrIndirectOwnership", r["ownership"])),
        ))

    # the fields are grouped and written as text afterwards, so the text is not shuffled
    fields = F.struct("record_id", "planned", "execution_date", "code", "shares", "price", "shares_after", "ownership")
    f = t.groupBy(*same).agg(F.array_join(F.transform(F.array_sort(F.collect_list(fields)), txn), "").alias("txns"))
    kind = F.col("actor_id") % 4
    flag = lambda name, k: tag(name, F.when(kind == k, "1").otherwise("0"))
    owner = tag("reportingOwner", F.concat(
        tag("reportingOwnerId", F.concat(tag("rptOwnerCik", text("actor_id")), tag("rptOwnerName", F.when(kind == 3, "Lee Family Trust").otherwise("LEE ANN")))),
        tag("reportingOwnerRelationship", F.concat(flag("isOfficer", 0), flag("isDirector", 1), flag("isTenPercentOwner", 2), tag("officerTitle", F.col("title")))),
    ))
    issuer = tag("issuer", F.concat(tag("issuerCik", F.lit("77")), tag("issuerName", F.lit("Some Issuer")), tag("issuerTradingSymbol", F.col("ticker"))))
    doc = tag("ownershipDocument", F.concat(tag("periodOfReport", F.lit("1999-12-31")), issuer, owner, tag("nonDerivativeTable", F.col("txns")), tag("footnotes", F.lit('<footnote id="F1">Rule 10b5-1 plan</footnote>'))))
    return f.select(F.concat_ws("-", text("filing_id"), "ticker", text("actor_id")).alias("file"), F.concat(F.lit(""), doc).alias("content"))


@query(
    "n1b_normalize_form4",
    f"""{WITH}, r AS (SELECT *, {ROLE_SQL} AS role FROM trades WHERE source = 'insider')
    SELECT role, code IN ('P', 'S') AND role NOT IN ('excluded', 'officer_other') AND value >= 10000 AS included,
    CASE WHEN role IN ('excluded', 'officer_other') THEN 'ENTITY_ROLE_EXCLUDED' WHEN code IN ('P', 'S') AND value < 10000 THEN 'BELOW_MINIMUM_VALUE' END AS reason_code, ticker, planned, owner_type, direction,
    count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value FROM (SELECT * EXCLUDE (owner_type), CASE WHEN ownership = 'D' THEN 'direct' ELSE 'indirect' END AS owner_type FROM r) GROUP BY ALL""",
)
def n1b(spark, sf_dir):
    parsed = forms.parse_form4(form4_documents(trades(spark, sf_dir).where("source = 'insider'")))
    out = store.normalize_form4(parsed, entities(spark, sf_dir))
    keys = ["role", "included", "reason_code", "ticker", "planned", "owner_type", "direction"]
    return out.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))


def filed_transactions(spark, sf_dir) -> DataFrame:
    """Congress trades as parsed transactions: every fifth filing lists treasuries, others lack the ticker or the asset type."""
    t, k, v = trades(spark, sf_dir).where("source = 'congress'"), F.col("filing_id") % 5, F.col("value")
    return t.select(
        "record_id", F.col("filing_id").cast("string").alias("filing_id"), F.col("actor_name").alias("filer_name"), F.when(~k.isin(1, 2), F.col("ticker")).alias("ticker"), F.lit("Some Company").alias("asset_name"),
        F.when(k == 0, "GS").when(k != 2, "ST").alias("asset_type"), "action", "owner_type", "execution_date", F.col("disclosure_date").alias("notification_date"), F.when(F.col("filing_id") % 3 > 0, F.col("disclosure_date")).alias("filing_date"), "chamber",
        F.when(v <= 15_000, 1_001).otherwise(15_001).cast("long").alias("low"), F.when(v <= 15_000, 15_000).otherwise(50_000).cast("long").alias("high"),
    )


@query(
    "n2b_normalize_legislator_filings",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 AS k FROM trades WHERE source = 'congress'), g AS (SELECT *, k NOT IN (0, 1, 2) AND action IN ('purchase', 'sale') AS ok FROM f),
    h AS (SELECT chamber, ok AND value > 15000 AS included, CASE WHEN ok AND value <= 15000 THEN 'BELOW_MINIMUM_VALUE' WHEN ok THEN NULL WHEN k IN (0, 2) THEN 'NON_SIGNAL_ASSET' WHEN k = 1 THEN 'MISSING_TICKER'
      WHEN chamber = 'house' THEN 'NON_SIGNAL_ASSET' ELSE 'LOW_RESOLUTION_CONFIDENCE' END AS reason_code, CASE WHEN chamber = 'house' OR filing_id % 3 > 0 THEN disclosure_date ELSE {D0} END AS d,
      CASE WHEN value <= 15000 THEN 8000.5 ELSE 32500.5 END AS estimate FROM g)
    SELECT chamber, included, reason_code, count(*) AS n, round(sum(estimate), 1)::DOUBLE AS estimate, min(d) AS first_disclosed, max(d) AS last_disclosed FROM h GROUP BY ALL""",
)
def n2b(spark, sf_dir):
    t, known = filed_transactions(spark, sf_dir), entities(spark, sf_dir)
    both = store.normalize_legislator_filings(t.where("chamber = 'house'"), known, "house").unionByName(store.normalize_legislator_filings(t.where("chamber = 'senate'"), known, "senate", ref()))
    return both.groupBy("chamber", "included", "reason_code").agg(F.count("*").alias("n"), F.round(F.sum("estimate"), 1).alias("estimate"), F.min("disclosure_date").alias("first_disclosed"), F.max("disclosure_date").alias("last_disclosed"))


@query(
    "n8_normalize_legislator_v1",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 AS k FROM trades WHERE source = 'congress')
    SELECT CASE WHEN filing_id % 2 = 1 AND filing_id % 7 > 0 THEN 'known' ELSE 'Unknown' END AS filer_name, CASE k WHEN 0 THEN 'treasury' WHEN 2 THEN 'unknown' ELSE 'common_stock' END AS category, k NOT IN (0, 2) AS include,
    count(*) AS n, count(*) FILTER (filing_id % 3 = 0) AS ingested FROM f GROUP BY ALL""",
)
def n8(spark, sf_dir):
    t = filed_transactions(spark, sf_dir)
    rows = t.select("filing_id", F.col("record_id").alias("line"), "asset_name", "ticker", "asset_type", F.col("action").alias("kind"), F.col("owner_type").alias("owner"), F.col("execution_date").alias("trade_date"), F.col("filing_date").alias("notification_date"), "low", "high")
    names = t.where("cast(filing_id as long) % 7 > 0").select("filing_id", F.lit("known").alias("filer")).distinct()
    out = store.normalize_legislator_v1(rows, names, F.lit("2099-01-01").cast("date"))
    return out.groupBy("filer_name", "category", "include").agg(F.count("*").alias("n"), F.count_if(F.col("disclosure_date") == F.lit("2099-01-01").cast("date")).alias("ingested"))


def stored_transactions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    t = filed_transactions(spark, sf_dir)
    txns = t.select(
        F.col("record_id").alias("id"), "filing_id", F.when(F.col("filing_id").cast("long") % 3 > 0, F.concat(F.lit("B"), "filer_name")).alias("bioguide_id"), "owner_type", "asset_name", "ticker", F.lit(None).cast("string").alias("company"), "action",
        "execution_date", F.col("notification_date").alias("disclosure_date"), "low", "high", (F.col("action") != "exchange").cast("int").alias("include"), F.when(F.col("action") == "exchange", "exchange").alias("exclusion_reason"),
    )
    return txns, t.select("filing_id", "filer_name").distinct()


@query(
    "s22_import_legislator_store",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 IN (1, 2) AS bare FROM trades WHERE source = 'congress' AND execution_date >= {D0} - 180)
    SELECT CASE WHEN filing_id % 3 > 0 THEN 'B' || actor_name ELSE actor_name END AS member_id, action <> 'exchange' AS included, CASE WHEN action = 'exchange' THEN 'NON_SIGNAL_ASSET' END AS reason_code, CASE WHEN NOT bare THEN subject_key END AS subject_key,
    count(*) AS n FROM f GROUP BY ALL""",
)
def s22(spark, sf_dir):
    txns, filings = stored_transactions(spark, sf_dir)
    imported = store.import_legislator_store(txns, filings, entities(spark, sf_dir), F.date_sub(ref(), 180))
    return imported.groupBy("member_id", "included", "reason_code", "subject_key").agg(F.count("*").alias("n"))


@query(
    "s22b_import_checks",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 IN (1, 2) AS bare FROM trades WHERE source = 'congress' AND execution_date >= {D0} - 180)
    SELECT count(*) AS window_rows, count(*) AS imported, count(*) FILTER (action <> 'exchange' AND NOT bare) AS signal_rows, count(DISTINCT ticker) FILTER (action <> 'exchange' AND NOT bare) AS results, TRUE AS fits FROM f""",
)
def s22b(spark, sf_dir):
    txns, filings = stored_transactions(spark, sf_dir)
    cutoff = F.date_sub(ref(), 180)
    imported = store.import_legislator_store(txns, filings, entities(spark, sf_dir), cutoff)
    return store.import_checks(txns, imported, store.stored_legislator_results(imported, ref()), cutoff)


@query(
    "s21b_import_insider_store_all",
    f"""{WITH} SELECT 'insider-txn:' || record_id AS record_id, CASE WHEN actor_id % 2 = 0 THEN ticker END AS ticker, CASE WHEN actor_id % 2 = 0 THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS status, direction, planned AS included FROM trades WHERE source = 'insider'""",
)
def s21b(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'insider'")
    issuer = F.concat_ws("-", "ticker", (F.col("actor_id") % 2).cast("string"))
    txns = t.select(F.col("record_id").alias("id"), F.concat_ws("-", "filing_id", issuer).alias("filing_id"), "code", F.col("planned").alias("include"), "value", "execution_date")
    filings = t.select(F.concat_ws("-", "filing_id", issuer).alias("filing_id"), issuer.alias("cik_issuer"), F.col("actor_name").alias("owner_name")).distinct()
    companies = t.where("actor_id % 2 = 0").select(issuer.alias("cik"), "ticker", F.lit(None).cast("string").alias("company_name")).distinct()
    return store.import_insider_store(txns, filings, companies, entities(spark, sf_dir)).select("record_id", "ticker", "status", "direction", "included")


def stored_results(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Results of both sources as a store with an older run of neutral rows."""
    ins, leg, events = sides(spark, sf_dir)
    refs = lambda df: F.to_json(F.struct(F.array().cast("array<string>").alias("normalized_row_ids"), F.when(F.col("event_id").isNotNull(), F.array("event_id")).otherwise(F.array().cast("array<string>")).alias("resolution_event_ids")))
    row = lambda df, source: df.select(
        F.lit(source).alias("source"), F.lit("entity").alias("scope"), "subject_key", F.lit(90).alias("lookback_window"), "label", F.col("score").cast("double").alias("score"), F.col("confidence").cast("double").alias("confidence"), F.lit(2).alias("input_count"),
        F.lit(2).alias("included_count"), F.lit("2000-01-01").alias("as_of_date"), F.lit("run-2").alias("run_id"), refs(df).alias("provenance_refs"),
    )
    new = row(ins, "insider").unionByName(row(leg, "congress"))
    old = new.withColumns({"label": F.lit("neutral"), "score": F.lit(0.0), "as_of_date": F.lit("1999-12-01"), "run_id": F.lit("run-1")})
    return old.unionByName(new), events


@query("j7_build_overlay_from_store", f"{OVERLAY_SQL} SELECT subject_key, outcome, eligible FROM o")
def j7(spark, sf_dir):
    results, events = stored_results(spark, sf_dir)
    combined, blocked = store.overlay_from_store(rosters.load_results(results), events)
    return combined.select("subject_key", "outcome", F.lit(True).alias("eligible")).unionByName(blocked.select("subject_key", "outcome", F.lit(False).alias("eligible")))


@query("s23b_load_stored_results", f"{OVERLAY_SQL} SELECT 'congress' AS source, subject_key, ll AS label FROM l UNION ALL SELECT 'insider', subject_key, il FROM i")
def s23b(spark, sf_dir):
    results, _ = stored_results(spark, sf_dir)
    own = rosters.load_results(results, "congress", run_id="run-2").unionByName(rosters.load_results(results, "insider", run_ids=["run-2", "run-3"]))
    return own.where(F.size("provenance_refs.normalized_row_ids") == 0).select("source", "subject_key", "label")


@query(
    "a37_trade_level_signal",
    f"""{LEGISLATOR_SQL}, s AS (SELECT record_id, sqrt(CAST(low AS DOUBLE) * high) * CASE action WHEN 'purchase' THEN 1.0 ELSE -1.0 END * CASE owner_type WHEN 'self' THEN 1.0 WHEN 'spouse' THEN 0.8 WHEN 'joint' THEN 0.9 WHEN 'dependent' THEN 0.5 ELSE 0.0 END * 0.95 * 0.7 AS score
      FROM legn WHERE reason_code IS NULL)
    SELECT record_id, round(score, 4) + 0.0 AS score, CASE WHEN score > 0 THEN 'bullish' WHEN score < 0 THEN 'bearish' ELSE 'neutral' END AS label FROM s""",
)
def a37(spark, sf_dir):
    legs = legislators(spark, sf_dir).withColumn("resolution_confidence", F.lit(0.95))
    out = store.trade_level_signals(legs, insiders(spark, sf_dir))
    return out.where("source = 'congress'").select("record_id", (F.round("score", 4) + 0.0).alias("score"), "label")


_FILING_SQL = (
    INSIDER_SQL.replace("ins AS (SELECT", "ins0 AS (SELECT").replace(f" * exp(-0.693 * greatest(0, date_diff('day', execution_date, {D0})) / 45.0)", "")
    + ", ins AS (SELECT * REPLACE (concat_ws('|', filing_id, subject_key) AS subject_key) FROM ins0 WHERE included)"
    + A1_SQL[len(INSIDER_SQL) :].replace("unnest([30, 90, 180])", "unnest([90])").replace(f" AND execution_date >= {D0} - CAST(window_days AS INTEGER)", "")
)


@query(
    "a37b_filing_signal",
    f"""{_FILING_SQL}, c AS (SELECT concat_ws('|', filing_id, subject_key) AS k, CAST(filing_id AS VARCHAR) AS record_id, subject_key, count(*) AS input_count, arg_max(execution_date, record_id) FILTER (included) AS as_of_date FROM ins0 GROUP BY ALL)
    SELECT record_id, c.subject_key, score, label, confidence, as_of_date, input_count, buy_count AS buys FROM a1 JOIN c ON k = a1.subject_key""",
)
def a37b(spark, sf_dir):
    """The insider half; sells weigh nothing in the current generation, so buys are all that is included."""
    out = store.trade_level_signals(legislators(spark, sf_dir).withColumn("resolution_confidence", F.lit(0.95)), insiders(spark, sf_dir)).where("source = 'insider'")
    return out.select("record_id", "subject_key", "score", "label", "confidence", "as_of_date", "input_count", F.col("included_count").alias("buys"))


@query(
    "a26_production_confidence",
    f"""{OVERLAY_SQL}, s AS (SELECT count(*) FILTER (il IS NOT NULL) AS overlap, count(*) FILTER (eligible) AS combined, count(*) FILTER (NOT eligible) AS blocked, count(*) AS congress_results,
      count(*) FILTER (outcome = 'SINGLE_SOURCE_ONLY') AS missing, count(*) FILTER (outcome = 'BLOCKED_AMBIGUOUS') AS ambiguous FROM o),
    p AS (SELECT *, CASE WHEN overlap = 0 THEN 'no_cross_source_overlap' WHEN missing > 0 AND (missing >= greatest(5, floor(blocked * 0.6)) OR missing >= overlap) THEN 'sparse_counterpart_coverage'
      WHEN ambiguous > 0 AND ambiguous >= greatest(2, floor(blocked * 0.25)) THEN 'entity_resolution_ambiguity' ELSE 'combined_layer_ready_for_strategy_evaluation' END AS primary_constraint FROM s)
    SELECT overlap, combined, blocked, round(CASE WHEN overlap > 0 THEN combined / overlap ELSE 0.0 END, 4) AS yield_of_overlap, primary_constraint,
    CASE WHEN primary_constraint IN ('no_cross_source_overlap', 'sparse_counterpart_coverage') THEN 'pipeline_correct_but_signal_sparse' WHEN primary_constraint = 'entity_resolution_ambiguity' THEN 'pipeline_operational_needs_more_data_quality_work'
      WHEN combined > 0 THEN 'ready_for_broader_live_strategy_validation' ELSE 'operationally_ready' END AS readiness FROM p""",
)
def a26(spark, sf_dir):

    ins, leg, events = sides(spark, sf_dir)
    o = overlay.overlay(ins, leg, events)
    n = lambda c: F.count_if(c)
    summary = o.agg(
        n(F.col("insider_score").isNotNull()).alias("overlap"), n(F.col("eligible")).alias("combined"), n(~F.col("eligible")).alias("blocked"), F.count("*").alias("congress_results"),
        n(F.col("reason_code") == "MISSING_COUNTERPART").alias("missing_counterpart"), n(F.col("outcome") == "BLOCKED_AMBIGUOUS").alias("ambiguous"), F.lit(0).alias("house_candidates"), F.lit(0).alias("senate_candidates"),
        F.lit(0).alias("insider_candidates"), F.lit(1.0).alias("house_scored_rate"),
    )
    return store.production_confidence(summary).select("overlap", "combined", "blocked", "yield_of_overlap", "primary_constraint", "readiness")


_COUNTED = {"cluster_buys": "a11_cluster_buys", "strong_insider": "w2_strong_signals", "anomalies": "a12_anomalous_buying", "participation": "a13_participation_index", "earnings": "j18_earnings_proximity", "rotations": "a14_committee_rotation"}
BRIEF_SQL = " UNION ALL ".join(
    [f"SELECT '{section}' AS section, count(*) AS lines FROM ({ORACLES[name]})" for section, name in _COUNTED.items()]
    + [f"SELECT 'cross_source', count(*) FROM ({OVERLAY_SQL} SELECT * FROM o WHERE eligible)", "SELECT 'stats', 1"]
)


@query("a16_daily_brief", f"SELECT section, lines FROM ({BRIEF_SQL}) WHERE lines > 0")
def a16(spark, sf_dir):
    from tradelens.plans.signal_queries import dt

    trades_in, legs, own, theirs = staged_sources(spark, sf_dir)
    ins, leg, events = sides(spark, sf_dir, own, theirs)
    ticker = F.upper(F.replace("subject_key", F.lit("entity:"), F.lit("")))
    results = own.select(F.lit("insider").alias("source"), ticker.alias("ticker"), "label", "score", "confidence", "window_days", F.col("buy_count").alias("included_count"))
    t = trades_in.select("ticker").unionByName(legs.select("ticker")).distinct()
    calendar = t.withColumn("earnings_date", F.date_add(F.lit(dt.date(1999, 11, 15)), (F.ascii(F.right("ticker", F.lit(1))) - 65) * 3))
    sections = store.daily_brief(trades_in, results, overlay.overlay(ins, leg, events).where("eligible"), calendar, alerts.committee_trades(legs, memberships(spark, sf_dir)), ref())
    return store.brief_lines(sections).groupBy("section").agg(F.count("*").alias("lines"))


@query(
    "a16b_brief_contents",
    f"""{OVERLAY_SQL}, w AS (SELECT 'insider' AS source, subject_key, label, score, confidence, window_days, buy_count AS n FROM a1 UNION ALL SELECT 'congress', subject_key, label, score, confidence, 0, transactions FROM a6),
    s AS (SELECT *, row_number() OVER (PARTITION BY source, subject_key ORDER BY confidence DESC, score DESC, window_days) AS k FROM w WHERE label = 'bullish' AND confidence >= 0.4 AND n >= 2)
    SELECT CASE source WHEN 'insider' THEN 'strong_insider' ELSE 'strong_legislator' END AS section, upper(replace(subject_key, 'entity:', '')) AS name, round(score, 4) AS first, round(confidence, 4) AS second FROM s WHERE k = 1
    UNION ALL SELECT 'stats', source, count(*) FILTER (label = 'bullish')::DOUBLE, count(*) FILTER (label = 'bearish')::DOUBLE FROM w GROUP BY source
    UNION ALL SELECT 'cross_source', upper(replace(subject_key, 'entity:', '')), round(isc, 4), round(ls, 4) FROM o WHERE eligible""",
)
def a16b(spark, sf_dir):
    """What the brief says on results of both sources, not only how much of it there is."""
    trades_in, legs, own, theirs = staged_sources(spark, sf_dir)
    ins, leg, events = sides(spark, sf_dir, own, theirs)
    ticker = F.upper(F.replace("subject_key", F.lit("entity:"), F.lit("")))
    own = own.select(F.lit("insider").alias("source"), ticker.alias("ticker"), "label", F.col("score").cast("double").alias("score"), F.col("confidence").cast("double").alias("confidence"), "window_days", F.col("buy_count").alias("included_count"))
    theirs = theirs.select(F.lit("congress").alias("source"), ticker.alias("ticker"), "label", "score", "confidence", F.lit(0).alias("window_days"), F.col("transactions").alias("included_count"))
    calendar = own.select("ticker", F.lit(None).cast("date").alias("earnings_date")).limit(0)
    brief = store.daily_brief(trades_in, own.unionByName(theirs), overlay.overlay(ins, leg, events).where("eligible"), calendar, alerts.committee_trades(legs, memberships(spark, sf_dir)), ref())
    row = lambda section, name, first, second: brief[section].select(F.lit(section).alias("section"), F.col(name).alias("name"), *[F.round(F.col(c).cast("double"), 4).alias(k) for c, k in ((first, "first"), (second, "second"))])
    strong = [row(s, "ticker", "score", "confidence") for s in ("strong_insider", "strong_legislator")]
    return strong[0].unionByName(strong[1]).unionByName(row("stats", "source", "bullish", "bearish")).unionByName(row("cross_source", "ticker", "insider_score", "legislator_score"))


_OBSERVED_SQL = f"""{OVERLAY_SQL}, q AS (SELECT subject_key, eligible, outcome, 'run-' || ascii(right(subject_key, 1)) % 3 AS run_id,
  CASE outcome WHEN 'SINGLE_SOURCE_ONLY' THEN 'MISSING_COUNTERPART' WHEN 'BLOCKED_LOW_CONFIDENCE' THEN 'LOW_RESOLUTION_CONFIDENCE' WHEN 'BLOCKED_AMBIGUOUS' THEN 'AMBIGUOUS_ENTITY_MATCH' END AS reason_code FROM o)"""


def _overlaid(spark, sf_dir, own=None, theirs=None) -> DataFrame:
    """Overlay decisions of three runs, with their references and reasons as JSON texts."""
    rows = overlay.overlay(*sides(spark, sf_dir, own, theirs))
    run = F.concat(F.lit("run-"), (F.ascii(F.right("subject_key", F.lit(1))) % 3).cast("string"))
    refs = F.to_json(F.struct(F.concat(F.lit("i:"), "subject_key").alias("insider"), F.concat(F.lit("c:"), "subject_key").alias("congress")))
    return rows.withColumns({"run_id": run, "refs": refs, "payload": F.to_json(F.create_map(F.lit("outcome"), "outcome"))})


@query("s23c_load_combined", f"{_OBSERVED_SQL} SELECT subject_key, run_id, 'i:' || subject_key AS insider_ref FROM q WHERE eligible AND run_id IN ('run-0', 'run-2')")
def s23c(spark, sf_dir):
    combined = _overlaid(spark, sf_dir).where("eligible").drop("payload")
    return rosters.load_combined(combined, run_ids=["run-0", "run-2"]).select("subject_key", "run_id", F.col("refs.insider").alias("insider_ref"))


@query("s23d_load_blocks", f"{_OBSERVED_SQL} SELECT subject_key, reason_code, outcome FROM q WHERE NOT eligible AND run_id = 'run-1'")
def s23d(spark, sf_dir):
    blocks = _overlaid(spark, sf_dir).where("not eligible").drop("outcome", "refs")
    return rosters.load_blocks(blocks, "run-1").select("subject_key", "reason_code", F.col("payload")["outcome"].alias("outcome"))


@query(
    "a23b_run_observability",
    f"""{_OBSERVED_SQL}, z AS (SELECT 'insider' AS source, included, reason_code FROM ins UNION ALL SELECT 'congress', reason_code IS NULL, reason_code FROM legn)
    SELECT 'exclusion' AS part, coalesce(reason_code, 'none') AS name, count(*) AS n FROM z WHERE NOT included GROUP BY ALL UNION ALL SELECT 'block', reason_code, count(*) FROM q WHERE NOT eligible GROUP BY ALL
    UNION ALL SELECT 'source', source, count(*) FROM z GROUP BY ALL UNION ALL SELECT DISTINCT 'failed_run', 'run-' || o_orderstatus, 1 FROM orders WHERE o_orderstatus = 'P'""",
)
def a23b(spark, sf_dir):
    """A run per order status, of which those with partial orders failed."""
    ledger = sinks.RunLedger(spark, sinks.staging_path(spark, "runs"))
    for status in sorted(r[0] for r in table(spark, sf_dir, "orders").select("o_orderstatus").distinct().collect()):
        ledger.start(f"run-{status}", {"status": status})
        ledger.finish(f"run-{status}", {}, failed=status == "P")
    columns = ["source", "included", "reason_code", "ticker"]
    ins, legs, own, theirs = staged_sources(spark, sf_dir)
    normalized = ins.select(columns).unionByName(legs.select(columns))
    return reports.run_observability(normalized, _overlaid(spark, sf_dir, own, theirs).where("not eligible"), ledger.runs())


@query("k2_append_blocks", f"{WITH} SELECT filing_id, 2 * count(*) AS n, min('{{\"ticker\":\"' || ticker || '\"}}') AS first_ref FROM trades WHERE planned GROUP BY filing_id")
def k2(spark, sf_dir):
    path = sinks.staging_path(spark, "blocks")
    blocks = trades(spark, sf_dir).where("planned").select("filing_id", F.struct("ticker").alias("refs"))
    sinks.append_blocks(blocks, path)
    sinks.append_blocks(blocks, path)
    return spark.read.parquet(path).groupBy("filing_id").agg(F.count("*").alias("n"), F.min("refs").alias("first_ref"))


@query("k3_run_ledger", f"{WITH} SELECT 'run-' || source AS run_id, CASE WHEN source = 'insider' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, '{{\"rows\": ' || count(*) || '}}' AS summary FROM trades GROUP BY source")
def k3(spark, sf_dir):
    path = sinks.staging_path(spark, "runs")
    for source, n in sorted((r.source, r["count"]) for r in trades(spark, sf_dir).groupBy("source").count().collect()):
        ledger = sinks.RunLedger(spark, path)
        ledger.start(f"run-{source}", {"source": source})
        ledger.finish(f"run-{source}", {"rows": n}, failed=source != "insider")
    return sinks.RunLedger(spark, path).runs().select("run_id", "status", "summary")


@query("k5_write_with_new_columns", f"{WITH} SELECT source, sector, count(*) AS n FROM (SELECT source, NULL AS sector FROM trades WHERE planned UNION ALL SELECT source, sector FROM trades WHERE NOT planned) GROUP BY ALL")
def k5(spark, sf_dir):
    path, t = sinks.staging_path(spark, "evolving"), trades(spark, sf_dir)
    sinks.write_with_new_columns(t.where("planned").select("record_id", "source"), path)
    sinks.write_with_new_columns(t.where("not planned").select("sector", "record_id", "source"), path)
    return sinks.read_with_new_columns(spark, path).groupBy("source", "sector").agg(F.count("*").alias("n"))


@query("k6_write_artifacts", f"{INSIDER_SQL} SELECT 'exclusions' AS artifact, coalesce(reason_code, 'none') AS name, count(*) AS n FROM ins WHERE NOT included GROUP BY ALL UNION ALL SELECT 'sources', source, count(*) FROM trades GROUP BY source")
def k6(spark, sf_dir):
    folder = sinks.staging_path(spark, "artifacts")
    excluded = insiders(spark, sf_dir).where("not included").groupBy(F.coalesce("reason_code", F.lit("none")).alias("name")).agg(F.count("*").alias("n"))
    sources = trades(spark, sf_dir).groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"))
    sinks.write_artifacts({"exclusions": excluded, "sources": sources}, folder)
    read = lambda name: spark.read.schema("name string, n long").json(f"{folder}/{name}").withColumn("artifact", F.lit(name))
    return read("exclusions").unionByName(read("sources")).select("artifact", "name", "n")



@query("t1_stream_filings", f"{WITH} SELECT lpad(CAST(actor_id AS VARCHAR), 10, '0') AS owner_cik, ticker, code, count(*) AS n FROM trades WHERE source = 'insider' GROUP BY ALL")
def t1(spark, sf_dir):
    from tradelens.streaming import streams

    landed, out, checkpoint = (sinks.staging_path(spark, name) for name in ("landed", "streamed", "checkpoint"))
    form4_documents(trades(spark, sf_dir).where("source = 'insider'")).select("content").write.text(landed, compression="gzip")
    stream = streams.stream_form4(spark, landed, whole=False)
    stream.select("owner_cik", "ticker", "code").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).groupBy("owner_cik", "ticker", "code").agg(F.count("*").alias("n"))


@query(
    "t5_stream_supersede",
    f"""{WITH}, f AS (SELECT DISTINCT filing_id, actor_id, ticker, min(execution_date) OVER (PARTITION BY filing_id) AS filing_date, filing_id % 4 = 0 AS amends FROM trades WHERE source = 'insider'),
    a AS (SELECT *, max(CASE WHEN amends THEN strftime(filing_date, '%Y-%m-%d') || '|' || lpad(CAST(filing_id AS VARCHAR), 12, '0') END) OVER (PARTITION BY ticker, actor_id % 20) AS newest FROM f)
    SELECT ticker AS issuer, actor_id % 20 AS owner, filing_id FROM a WHERE newest IS NULL OR strftime(filing_date, '%Y-%m-%d') || '|' || lpad(CAST(filing_id AS VARCHAR), 12, '0') >= newest""",
)
def t5(spark, sf_dir):
    from tradelens.streaming import streams

    landed, out, checkpoint = (sinks.staging_path(spark, name) for name in ("filings", "superseded", "checkpoint"))
    t = trades(spark, sf_dir).where("source = 'insider'")
    # a filing has one row per issuer, all with its first date; both groupings are by filing, as trades are already
    rows = t.groupBy("filing_id", F.col("ticker").alias("issuer"), (F.col("actor_id") % 20).cast("string").alias("owner")).agg(F.min("execution_date").alias("first"))
    rows = rows.withColumn("filing_date", F.min("first").over(Window.partitionBy("filing_id")))
    filings = rows.select("filing_id", "issuer", "owner", F.lit("all").alias("period"), (F.col("filing_id") % 4 == 0).alias("is_amendment"), "filing_date")
    filings.write.parquet(landed)
    stream = spark.readStream.schema(filings.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    with streams.rocksdb(spark):
        streams.stream_supersede(stream, "3650 days").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return streams.standing(spark.read.parquet(out)).select("issuer", F.col("owner").cast("long").alias("owner"), "filing_id")


@query(
    "a24b_parse_quality_rates",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 IN (1, 2) AS bare, filing_id % 5 NOT IN (0, 1, 2) AND action IN ('purchase', 'sale') AND value > 15000 AS ok FROM trades WHERE source = 'congress')
    SELECT count(*) AS trades, count(*) FILTER (NOT bare) AS resolved, count(*) FILTER (NOT bare) AS with_ticker, count(*) FILTER (ok) AS included, round(count(*) FILTER (NOT bare) / count(*), 4) AS resolved_rate,
    round(count(*) FILTER (NOT bare) / count(*), 4) AS ticker_rate, round(count(*) FILTER (ok) / count(*), 4) AS included_rate FROM f""",
)
def a24b(spark, sf_dir):
    return reports.parse_quality(store.normalize_legislator_filings(filed_transactions(spark, sf_dir), entities(spark, sf_dir), "house"))


@query(
    "a24d_parse_quality_lists",
    f"""{WITH}, f AS (SELECT 'Issuer ' || filing_id % 40 AS issuer, filing_id % 5 AS k, filing_id % 5 NOT IN (0, 1, 2) AND action IN ('purchase', 'sale') AND value > 15000 AS ok FROM trades WHERE source = 'congress'),
    p AS (SELECT 'unresolved' AS part, issuer FROM f WHERE k IN (1, 2) UNION ALL SELECT 'signal_like', issuer FROM f WHERE k = 1 UNION ALL SELECT 'non_signal', issuer FROM f WHERE k = 2 UNION ALL SELECT 'recovered', issuer FROM f WHERE ok),
    n AS (SELECT part, issuer, count(*) AS n FROM p GROUP BY ALL)
    SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY n DESC, issuer) AS INTEGER) AS place, issuer, n FROM n QUALIFY place <= 10""",
)
def a24d(spark, sf_dir):
    t = filed_transactions(spark, sf_dir)
    issuer = F.concat(F.lit("Issuer "), (F.col("filing_id").cast("long") % 40).cast("string"))
    normalized = store.normalize_legislator_filings(t, entities(spark, sf_dir), "house")
    return reports.quality_lists(normalized.withColumn("asset_name", issuer))


@query("a24e_first_subjects", f"{A1_SQL} SELECT subject_key, label, score, confidence, trade_count AS input_count, CAST(row_number() OVER (ORDER BY subject_key) AS INTEGER) AS place FROM a1 WHERE window_days = 90 ORDER BY subject_key LIMIT 10")
def a24e(spark, sf_dir):
    return reports.first_subjects(insider_results(spark, sf_dir).where("window_days = 90").withColumn("input_count", F.col("trade_count")))


@query(
    "a24c_parse_quality_histograms",
    f"""{WITH}, f AS (SELECT *, filing_id % 5 AS k FROM trades WHERE source = 'congress') SELECT 'category' AS histogram, CASE k WHEN 0 THEN 'treasury' WHEN 2 THEN 'unknown' ELSE 'common_stock' END AS value, count(*) AS n FROM f GROUP BY ALL
    UNION ALL SELECT 'reason', CASE WHEN k IN (0, 2) THEN 'NON_SIGNAL_ASSET' WHEN k = 1 THEN 'MISSING_TICKER' WHEN action = 'exchange' THEN 'NON_SIGNAL_ASSET' WHEN value <= 15000 THEN 'BELOW_MINIMUM_VALUE' ELSE 'none' END, count(*) FROM f GROUP BY ALL""",
)
def a24c(spark, sf_dir):
    rows = store.normalize_legislator_filings(filed_transactions(spark, sf_dir), entities(spark, sf_dir), "house")
    return reports.histogram(rows, "category", "category").unionByName(reports.histogram(rows, "reason_code", "reason"))


@query(
    "a25b_candidate_details",
    """WITH u AS (SELECT 'n' || l_suppkey % 30 AS name, l_returnflag AS category, 'r' || l_linenumber AS reason, l_linestatus AS instrument, concat_ws(':', l_orderkey, l_linenumber, l_suppkey, l_partkey) AS record_id FROM lineitem),
    t AS (SELECT name, count(*) AS n FROM u GROUP BY name ORDER BY n DESC, name LIMIT 10),
    c AS (SELECT name, string_agg(category || '=' || c, ',' ORDER BY category) AS category_counts FROM (SELECT name, category, count(*) AS c FROM u GROUP BY ALL) GROUP BY name),
    r AS (SELECT name, string_agg(reason || '=' || c, ',' ORDER BY reason) AS reason_counts FROM (SELECT name, reason, count(*) AS c FROM u GROUP BY ALL) GROUP BY name),
    i AS (SELECT name, string_agg(instrument || '=' || c, ',' ORDER BY instrument) AS instrument_counts FROM (SELECT name, instrument, count(*) AS c FROM u GROUP BY ALL) GROUP BY name),
    e AS (SELECT name, string_agg(record_id, ',' ORDER BY record_id) AS examples FROM (SELECT name, record_id, row_number() OVER (PARTITION BY name ORDER BY record_id) AS k FROM u) WHERE k <= 3 GROUP BY name)
    SELECT name, n, category_counts, reason_counts, instrument_counts, examples FROM t JOIN c USING (name) JOIN r USING (name) JOIN i USING (name) JOIN e USING (name)""",
)
def a25b(spark, sf_dir):
    u = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("n"), (F.col("l_suppkey") % 30).cast("string")).alias("name"), F.col("l_returnflag").alias("category"), F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("reason"), F.col("l_linestatus").alias("instrument"),
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("record_id"),
    )
    return reports.candidate_details(u)


@query("a34b_store_status_by_source", f"{WITH} SELECT source, count(*) AS rows, count(*) FILTER (planned) AS included, min(execution_date) AS first_date, max(execution_date) AS last_date, {D0} - max(execution_date) > 30 AS stale FROM trades GROUP BY source")
def a34b(spark, sf_dir):
    return reports.store_status(trades(spark, sf_dir).withColumn("included", F.col("planned")), ref(), 30)


@query(
    "a38b_ingest_summary",
    f"""{WITH}, f AS (SELECT DISTINCT filing_id, chamber FROM trades WHERE source = 'congress'), g AS (SELECT filing_id, chamber, CASE WHEN filing_id % 4 = 1 THEN 'paper' ELSE 'electronic' END AS format FROM f),
    t AS (SELECT filing_id, planned FROM trades WHERE source = 'congress' AND filing_id % 3 > 0), m AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0)
    SELECT 'filings_without_trades' AS metric, chamber || '/' || format AS key, count(*) AS n FROM g WHERE filing_id % 3 = 0 GROUP BY ALL UNION ALL SELECT 'trades', CASE WHEN planned THEN 'included' ELSE 'excluded' END, count(*) FROM t GROUP BY ALL
    UNION ALL SELECT 'members', CASE WHEN k % 2 = 0 THEN 'Senate' ELSE 'House of Representatives' END, count(*) FROM m GROUP BY ALL
    UNION ALL SELECT 'members_with_committees', CASE WHEN k % 2 = 0 THEN 'Senate' ELSE 'House of Representatives' END, count(*) FILTER (k % 9 > 0) FROM m GROUP BY ALL""",
)
def a38b(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    filings = t.select("filing_id", "chamber", F.when(F.col("filing_id") % 4 == 1, "paper").otherwise("electronic").alias("format")).distinct()
    return reports.ingest_summary(filings, t.where("filing_id % 3 > 0").select("filing_id", F.col("planned").alias("included")), members(spark, sf_dir))


@query(
    "j15b_crossref_summary",
    f"""{WITH}, v AS (SELECT ticker, source, sum(CASE code WHEN 'P' THEN value WHEN 'S' THEN -value ELSE 0 END) AS net FROM trades WHERE source = 'congress' OR ticker NOT LIKE '%A' GROUP BY ALL),
    j AS (SELECT a.net AS l, b.net AS i FROM v a JOIN v b ON a.ticker = b.ticker AND a.source = 'congress' AND b.source = 'insider')
    SELECT count(*) AS crossed, round(count(*) FILTER (l > 0 AND i > 0 OR l < 0 AND i < 0) / count(*), 4) AS agreement_rate, (SELECT count(DISTINCT ticker) FROM trades WHERE source = 'congress' AND ticker LIKE '%A') AS legislator_only FROM j""",
)
def j15b(spark, sf_dir):
    t = trades(spark, sf_dir).select("ticker", "code", "value", "source")
    legs, ins = t.where("source = 'congress'"), t.where("source = 'insider' and ticker not like '%A'")
    return reports.crossref_summary(legs, ins, resolve.crossref(legs, ins))


@query("w6b_top_issuers", f"{WITH} SELECT ticker, n, CAST(row_number() OVER (ORDER BY n DESC, ticker) AS INTEGER) AS place FROM (SELECT ticker, count(*) AS n FROM trades GROUP BY ticker) QUALIFY place <= 10")
def w6b(spark, sf_dir):
    return reports.top_k(trades(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n")), 10, [F.desc("n"), F.col("ticker")])
