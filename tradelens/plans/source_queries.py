"""Queries for readers (round trips through generated text) and streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.operators import signals
from tradelens.plans.catalog import query
from tradelens.plans.expressions import WITH, ref
from tradelens.plans.signal_queries import A1_SQL, insiders
from tradelens.plans.trades import table, trades
from tradelens.sources import forms
from tradelens.streaming import streams


def tag(name: str, value: Column) -> Column:
    """``<name>value</name>`` around a column."""
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


#: Keys of the rows that share a generated file: files grow in number with the table, not in size.
FILE_KEYS = 1000


def file_of(key: Column) -> Column:
    """Number of the generated file a row goes to."""
    return F.floor(key / FILE_KEYS)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


@query(
    "s1_read_form4_xml",
    f"""{WITH}, o AS (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY record_id) - 1 AS line FROM trades WHERE source = 'insider')
    SELECT CAST(filing_id AS VARCHAR) AS file, CAST(line AS INTEGER) AS line, ticker, lpad(CAST(actor_id AS VARCHAR), 10, '0') AS owner_cik, title, TRUE AS is_officer, execution_date AS transaction_date, code, shares, round(shares * 2, 2) AS total_value, CASE WHEN planned THEN 'Rule 10b5-1 plan' END AS footnotes FROM o""",
)
def s1(spark, sf_dir):
    value = lambda name, column: tag(name, tag("value", column))
    t = trades(spark, sf_dir).where("source = 'insider'")

    def txn(r: Column) -> Column:
        note = F.when(r["planned"], F.lit('<footnoteId id="F1"/>')).otherwise("")
        return tag("nonDerivativeTransaction", F.concat(
            value("transactionDate", F.date_format(r["execution_date"], "yyyy-MM-dd")), tag("transactionCoding", F.concat(tag("transactionCode", r["code"]), note)),
            tag("transactionAmounts", F.concat(value("transactionShares", r["shares"].cast("string")), value("transactionPricePerShare", F.lit("2")))),
        ))

    # the fields are grouped and written as text afterwards, so the text is not shuffled
    fields = F.struct("record_id", "planned", "execution_date", "code", "shares")
    f = t.groupBy("filing_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(fields)), txn), "").alias("txns"), F.first("actor_id").alias("a"), F.first("title").alias("title"))
    owner = tag("reportingOwner", F.concat(tag("reportingOwnerId", F.concat(tag("rptOwnerCik", _text("a")), tag("rptOwnerName", F.lit("DOE")))), tag("reportingOwnerRelationship", F.concat(tag("isOfficer", F.lit("1")), tag("officerTitle", F.col("title"))))))
    doc = tag("ownershipDocument", F.concat(tag("issuer", tag("issuerCik", F.lit("320193"))), owner, tag("nonDerivativeTable", F.col("txns")), tag("footnotes", F.lit('<footnote id="F1">Rule 10b5-1 plan</footnote>'))))
    parsed = forms.parse_form4(f.select(_text("filing_id").alias("file"), doc.alias("content")))
    own = t.withColumn("line", F.row_number().over(W.partitionBy("filing_id").orderBy("record_id")) - 1).select(_text("filing_id").alias("file"), "line", F.col("ticker").alias("own_ticker"))
    return parsed.join(own, ["file", "line"]).select("file", "line", F.col("own_ticker").alias("ticker"), "owner_cik", "title", "is_officer", "transaction_date", "code", "shares", "total_value", "footnotes")


@query(
    "s2_read_senate_ptr_html",
    f"""{WITH}, o AS (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY record_id) AS row FROM trades WHERE source = 'congress')
    SELECT CAST(filing_id AS VARCHAR) AS file, CAST(row AS INTEGER) AS row, execution_date AS date, CASE WHEN owner_type = 'self' THEN 'Self' ELSE owner_type END AS owner, CASE WHEN code = 'M' THEN NULL ELSE ticker END AS ticker, action AS transaction, '$1,001 - $15,000' AS amount FROM o""",
)
def s2(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    td = lambda c: tag("td", c)
    ticker = F.when(F.col("code") == "P", F.concat(F.lit("<a href='x'> "), "ticker", F.lit(" </a>"))).when(F.col("code") == "M", "--").otherwise(F.col("ticker"))
    cells = F.concat(td(F.lit("1")), td(F.date_format("execution_date", "MM/dd/yyyy")), td(F.when(F.col("owner_type") == "self", "").otherwise(F.col("owner_type"))), td(ticker), td(F.lit("Some Asset")), td(F.lit("Stock")), td(F.col("action")), td(F.lit("<b>$1,001 -\n $15,000</b>")))
    f = t.groupBy("filing_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record_id", tag("tr", cells).alias("x")))), lambda r: r["x"]), "\n").alias("rows"))
    page = F.concat(F.lit('<html><table class="plain"><tr><td>x</td></tr></table><table class="table table-striped"><tr><th>#</th></tr>'), "rows", F.lit("</table></html>"))
    return forms.parse_senate_ptr(f.select(_text("filing_id").alias("file"), page.alias("content"))).select("file", "row", "date", "owner", "ticker", "transaction", "amount")


@query("s4_read_senate_search_rows", """SELECT printf('%08x-0', o_orderkey) AS filing_id, o_orderkey % 2 = 0 AS is_paper, CASE WHEN o_orderkey % 3 = 0 THEN 'Ann Lee' ELSE 'Lee, Ann (Senator)' END AS filer_name, CAST(o_orderdate AS DATE) AS filing_date FROM orders WHERE o_orderkey % 7 > 0""")
def s4(spark, sf_dir):
    k = F.col("o_orderkey")
    link = F.format_string('<a href="/search/view/%s/%08x-0/">r</a>', F.when(k % 7 == 0, "other").when(k % 2 == 0, "paper").otherwise("ptr"), k)
    body = F.to_json(F.array(F.array(F.lit("Ann"), F.lit("Lee"), F.when(k % 3 == 0, "").otherwise("Lee, Ann (Senator)"), link, F.date_format("o_orderdate", "MM/dd/yyyy"))))
    return forms.parse_search_rows(table(spark, sf_dir, "orders").select(body.alias("body")))


@query("s5_read_house_index_xml", "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'Ann Lee' || CASE WHEN o_orderkey % 2 = 0 THEN ' Jr' ELSE '' END AS name, CAST(o_orderdate AS DATE) AS filing_date FROM orders WHERE o_orderkey % 4 > 0")
def s5(spark, sf_dir):
    k = F.col("o_orderkey")
    member = tag("Member", F.concat(tag("First", F.lit("Ann")), tag("Last", F.lit("Lee")), tag("Suffix", F.when(k % 2 == 0, "Jr").otherwise("")), tag("FilingType", F.when(k % 4 == 0, "C").otherwise("P")), tag("FilingDate", F.date_format("o_orderdate", "M/d/yyyy")), tag("DocID", k.cast("string"))))
    files = table(spark, sf_dir, "orders").groupBy(file_of(k).alias("file")).agg(F.array_join(F.collect_list(member), "").alias("m"))
    return forms.parse_house_index(files.select(tag("FinancialDisclosure", F.col("m")).alias("content")))


@query("s8_parse_house_entry", f"""{WITH} SELECT record_id AS entry_id, CASE owner_type WHEN 'spouse' THEN 'spouse' WHEN 'joint' THEN 'joint' WHEN 'dependent' THEN 'dependent' ELSE 'self' END AS owner, ticker, 'ST' AS asset_type, execution_date AS trade_date, disclosure_date AS notification_date, CAST(15001 AS BIGINT) AS low, CAST(50000 AS BIGINT) AS high, CASE code WHEN 'P' THEN 'purchase' WHEN 'S' THEN CASE WHEN planned THEN 'sale_partial' ELSE 'sale' END ELSE 'exchange' END AS kind FROM trades WHERE source = 'congress'""")
def s8(spark, sf_dir):
    t = trades(spark, sf_dir).where("source = 'congress'")
    code = F.when(F.col("code") == "S", F.when(F.col("planned"), "S (partial)").otherwise("S")).when(F.col("code") == "M", "E").otherwise("P")
    prefix = F.when(F.col("owner_type") == "spouse", "SP ").when(F.col("owner_type") == "joint", "JT ").when(F.col("owner_type") == "dependent", "DC ").otherwise("")
    day = lambda c: F.date_format(c, "MM/dd/yyyy")
    entry = F.concat(prefix, F.lit("Some Company Common Stock ("), "ticker", F.lit(") [ST] "), code, F.lit(" "), day("execution_date"), F.lit(" "), day("disclosure_date"), F.lit(" $15,001 - $50,000"))
    return forms.parse_house_entry(t.select(F.col("record_id").alias("entry_id"), entry.alias("entry")))


@query("s14_read_company_tickers", "SELECT 'N' || c_nationkey AS ticker, lpad(CAST(max(c_custkey) AS VARCHAR), 10, '0') AS cik FROM customer WHERE c_custkey % 9 > 0 GROUP BY c_nationkey")
def s14(spark, sf_dir):
    k = F.col("c_custkey")
    entry = F.struct(k.alias("cik_str"), F.when(k % 9 == 0, " ").otherwise(F.concat(F.lit(" n"), F.col("c_nationkey").cast("string"))).alias("ticker"), F.col("c_name").alias("title"))
    c = table(spark, sf_dir, "customer").groupBy(file_of(k).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(k.cast("string"), entry)))).alias("content"))
    return forms.parse_company_tickers(c)


@query("s15_read_universe_csv", "SELECT 'S' || s_suppkey AS ticker, CASE WHEN s_suppkey % 3 = 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 10, '0') ELSE lpad(CAST(s_suppkey + 5 AS VARCHAR), 10, '0') END AS cik, s_name AS company_name FROM supplier WHERE s_suppkey % 3 < 2")
def s15(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    ticker = F.concat(F.lit("S"), k.cast("string"))
    raw = s.select(ticker.alias("Ticker "), F.when(k % 3 == 0, k.cast("string")).otherwise("n/a").alias(" CIK"), F.col("s_name").alias("Company Name"))
    known = s.where(k % 3 == 1).select(ticker.alias("ticker"), F.lpad((k + 5).cast("string"), 10, "0").alias("cik"))
    return forms.read_universe(raw, known).select("ticker", "cik", "company_name")


@query("s17_read_committee_yaml", "SELECT 'f' || c_nationkey AS file, 'C' || c_nationkey % 3 AS code, 'Member ' || c_custkey AS name, 'majority' AS party, CAST(c_custkey % 9 AS INTEGER) AS rank, CASE WHEN c_custkey % 4 = 0 THEN 'Chair' END AS title, 'B' || c_custkey AS bioguide FROM customer")
def s17(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    member = F.concat(F.lit("- name: Member "), k, F.lit("\n  party: majority\n  rank: "), (F.col("c_custkey") % 9).cast("string"), F.when(F.col("c_custkey") % 4 == 0, "\n  title: Chair").otherwise(""), F.lit("\n  bioguide: B"), k)
    files = table(spark, sf_dir, "customer").groupBy("c_nationkey", file_of(F.col("c_custkey")).alias("part")).agg(F.array_join(F.collect_list(member), "\n").alias("m"))
    n = F.col("c_nationkey")
    content = F.concat(F.lit("C"), (n % 3).cast("string"), F.lit(":\n"), "m", F.lit("\n"))
    # the reader goes through each file by its name, which carries the part until the rows are read
    name = F.concat(F.lit("f"), n.cast("string"), F.lit("/"), F.col("part").cast("string"))
    members = forms.parse_committee_roster(files.select(name.alias("file"), content.alias("content")))
    return members.withColumn("file", F.substring_index("file", "/", 1))


@query("s19_read_prices", f"{WITH} SELECT ticker, execution_date AS date, round(avg(price), 6) AS close FROM trades GROUP BY ALL")
def s19(spark, sf_dir):
    from tradelens.plans.trades import prices

    return prices(spark, sf_dir)


@query("s20_read_vendor_trades", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(1001 AS DOUBLE) ELSE CAST(o_orderkey * 1000 AS DOUBLE) END AS low, CASE WHEN o_orderkey % 2 = 0 THEN CAST(15000 AS DOUBLE) ELSE CAST(o_orderkey * 1000 AS DOUBLE) END AS high FROM orders")
def s20(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = F.when(k % 2 == 0, "$1,001 - $15,000").otherwise(F.concat(F.lit("$"), F.format_number(k * 1000, 0)))
    return table(spark, sf_dir, "orders").select("o_orderkey", forms.parse_vendor_range(raw).alias("r")).select("o_orderkey", "r.low", "r.high")


@query("t2_dedupe_by_hash", "SELECT event_id FROM events WHERE NOT (event_id % 3 = 0 AND event_id % 2 = 0)")
def t2(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("filing_id"), F.col("props").alias("content"))
    # the last parse knew every third filing; every second of those has the same content still
    known = e.where("event_id % 3 = 0").select("filing_id", F.sha2(F.when(F.col("filing_id") % 2 == 0, F.col("content")).otherwise("old").cast("binary"), 256).alias("hash"))
    return streams.changed_only(e, known).select("event_id")


@query("t2b_stream_changed_only", "SELECT event_id FROM events WHERE NOT (event_id % 3 = 0 AND event_id % 2 = 0)")
def t2b(spark, sf_dir):
    """The same over a file stream that is started three times; every event lands twice, in different folders."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("filing_id"), F.col("props").alias("content"), F.col("ts").cast("timestamp").alias("ts"))
    known = e.where("event_id % 3 = 0").select("filing_id", F.sha2(F.when(F.col("filing_id") % 2 == 0, F.col("content")).otherwise("old").cast("binary"), 256).alias("hash"))
    known = sinks.staged(known, "ledger")
    landed, out, checkpoint = (sinks.staging_path(spark, name) for name in ("changed", "fresh", "checkpoint"))
    for k in range(3):
        e.where(f"event_id % 3 in ({k}, {(k + 1) % 3})").coalesce(2).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(e.schema).parquet(landed)
        fresh = streams.stream_changed_only(stream, "ts", known, "60 days").select("event_id")
        fresh.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    return spark.read.schema("event_id long").parquet(out)


@query("t3_rescore_touched", f"{A1_SQL} SELECT subject_key, window_days, label, score FROM a1 WHERE subject_key IN (SELECT subject_key FROM ins WHERE filing_id % 400 = 0)")
def t3(spark, sf_dir):
    t = insiders(spark, sf_dir)
    scored = streams.rescore_touched(t.where("filing_id % 400 <> 0"), t.where("filing_id % 400 = 0"), lambda df: signals.insider_company_signal(df, ref()))
    return scored.select("subject_key", "window_days", "label", "score")


@query("t3b_rescore_stream", f"{A1_SQL} SELECT subject_key, window_days, label, score FROM a1 WHERE subject_key IN (SELECT subject_key FROM ins WHERE filing_id % 400 = 0)")
def t3b(spark, sf_dir):
    """The same as a stream of three batches, each over the history up to it."""
    t = sinks.staged(insiders(spark, sf_dir), "trades")
    landed, history, scores, checkpoint = (sinks.staging_path(spark, name) for name in ("new", "history", "scores", "checkpoint"))
    streams.start_history(t.where("filing_id % 400 <> 0"), history)
    for k in range(3):
        # each run takes what has landed since the last one as one batch, so a batch may have any number of files
        t.where(f"filing_id % 400 = 0 and pmod(filing_id div 400, 3) = {k}").write.mode("append").parquet(landed)
        stream = spark.readStream.schema(t.schema).parquet(landed)
        streams.rescore_stream(stream, history, scores, lambda df: signals.insider_company_signal(df, ref()), checkpoint).awaitTermination()
    return streams.latest_scores(spark, scores).select("subject_key", "window_days", "label", "score")


@query(
    "t4_stream_cluster_buys",
    """WITH e AS (SELECT ts, 'T' || user_id % 20 AS ticker, user_id AS actor_id, value FROM events), w AS (SELECT unnest(generate_series(date_trunc('day', ts) - INTERVAL 6 DAY, date_trunc('day', ts), INTERVAL 1 DAY)) AS window_start, * FROM e)
    SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, ticker, CAST(count(DISTINCT actor_id) AS INTEGER) AS actors, count(*) AS trades, round(sum(value), 2) AS total_value FROM w GROUP BY ALL HAVING count(DISTINCT actor_id) >= 2""",
)
def t4(spark, sf_dir):
    """The events table as a file stream in append mode; a last file without trades moves the watermark past all windows."""
    source = table(spark, sf_dir, "events")
    landed, out, checkpoint = _stream_folder(spark, sf_dir), sinks.staging_path(spark, "windows"), sinks.staging_path(spark, "checkpoint")
    read = spark.readStream.schema(source.schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 2)
    ticker = F.when(F.col("user_id").isNotNull(), F.concat(F.lit("T"), (F.col("user_id") % 20).cast("string")))

    def run():
        raw = read.parquet(landed)
        buys = raw.select(F.col("ts").cast("timestamp").alias("ts"), ticker.alias("ticker"), F.col("user_id").alias("actor_id"), "value")
        windows = streams.cluster_buy_windows(buys, "ts", 7, 1, "60 days")
        windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet").awaitTermination()

    run()
    last = source.agg(F.max("ts").alias("ts")).withColumn("ts", F.expr("ts + interval 90 days").cast(source.schema["ts"].dataType))
    last.select(*[F.col(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema]).write.mode("append").parquet(landed)
    run()
    done = spark.read.schema("window_start timestamp, window_end timestamp, ticker string, actors int, trades long, total_value double").parquet(out)
    return done.withColumns({"total_value": F.round("total_value", 2), **{c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}})


def _stream_folder(spark, sf_dir: str) -> str:
    """A folder with the events as landed files."""
    path = sinks.staging_path(spark, "events")
    table(spark, sf_dir, "events").repartition(4).write.parquet(path)
    return path
