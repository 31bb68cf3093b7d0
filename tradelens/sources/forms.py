"""Readers of filings and rosters: XML, HTML, JSON and line-oriented text, as column expressions over whole-file text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORM_SCHEMA = """periodOfReport string, issuer struct<issuerCik string, issuerName string, issuerTradingSymbol string>,
reportingOwner array<struct<reportingOwnerId struct<rptOwnerCik string, rptOwnerName string>, reportingOwnerRelationship struct<isDirector string, isOfficer string, isTenPercentOwner string, isOther string, officerTitle string>>>,
nonDerivativeTable struct<nonDerivativeTransaction array<{t}>>, derivativeTable struct<derivativeTransaction array<{t}>>, footnotes struct<footnote array<struct<_VALUE string, _id string>>>, _corrupt_record string""".replace(
    "{t}",
    """struct<transactionDate struct<value string>, transactionCoding struct<transactionCode string, footnoteId array<struct<_id string>>>,
transactionAmounts struct<transactionShares struct<value string, footnoteId array<struct<_id string>>>, transactionPricePerShare struct<value string, footnoteId array<struct<_id string>>>>,
postTransactionAmounts struct<sharesOwnedFollowingTransaction struct<value string>>, ownershipNature struct<directOrIndirectOwnership struct<value string>>>""",
)


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def _flag(text: Column) -> Column:
    return F.coalesce(text.isin("1", "true", "True", "TRUE"), F.lit(False))


def without_namespaces(xml: Column) -> Column:
    """XML text without declarations of namespaces and prefixes of elements. Most documents have neither, so patterns only run where they may match."""
    undeclared = F.when(F.contains(xml, F.lit("xmlns")), F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"', "")).otherwise(xml)
    return F.when(F.contains(xml, F.lit(":")), F.regexp_replace(undeclared, r"<(/?)\w+:", "<$1")).otherwise(undeclared)


def parse_form4(files: DataFrame) -> DataFrame:
    """Transactions of ownership filings: ``files`` has file and content (whole XML text).

    One row per transaction, non-derivative ones first; further owners as an array; ``parse_error`` is set, and
    the transaction columns are null, where the document is malformed. Namespaces are stripped.
    """
    clean = without_namespaces(F.col("content"))
    # exploded from an array of one, so that filters on the rows are not pushed below it, which would parse each document again
    x = files.select("file", F.explode(F.array(F.from_xml(clean, FORM_SCHEMA, {"mode": "PERMISSIVE", "attributePrefix": "_", "valueTag": "_VALUE"}))).alias("x"))
    t = lambda name, derivative: F.transform(F.coalesce(F.col(name), F.array()), lambda r: F.struct(F.lit(derivative).alias("is_derivative"), r.alias("t")))
    rows = F.concat(t("x.nonDerivativeTable.nonDerivativeTransaction", False), t("x.derivativeTable.derivativeTransaction", True))
    owner = F.element_at("x.reportingOwner", 1)
    bad = F.col("x._corrupt_record").isNotNull() | F.col("x.issuer").isNull()
    out = x.select("file", "x", bad.alias("parse_error"), owner.alias("o"), F.posexplode_outer(F.when(~bad, rows)).alias("line", "r"))
    a = F.col("r.t.transactionAmounts")
    shares, price = _number(a["transactionShares"]["value"]), _number(a["transactionPricePerShare"]["value"])
    ids = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.coalesce(F.transform(c, lambda f: f["_id"]), F.array().cast("array<string>")) for c in (F.col("r.t.transactionCoding.footnoteId"), a["transactionShares"]["footnoteId"], a["transactionPricePerShare"]["footnoteId"])]))))
    notes = F.transform(ids, lambda i: F.element_at(F.filter(F.coalesce(F.col("x.footnotes.footnote"), F.array()), lambda f: f["_id"] == i), 1)["_VALUE"])
    relation = F.col("o.reportingOwnerRelationship")
    return out.select(
        "file", "parse_error", "line", F.col("r.is_derivative").alias("is_derivative"), F.lpad(F.trim("x.issuer.issuerCik"), 10, "0").alias("issuer_cik"), F.col("x.issuer.issuerName").alias("issuer_name"), F.col("x.issuer.issuerTradingSymbol").alias("ticker"),
        F.col("x.periodOfReport").alias("period"), F.lpad(F.trim("o.reportingOwnerId.rptOwnerCik"), 10, "0").alias("owner_cik"), F.col("o.reportingOwnerId.rptOwnerName").alias("owner_name"), relation["officerTitle"].alias("title"),
        _flag(relation["isOfficer"]).alias("is_officer"), _flag(relation["isDirector"]).alias("is_director"), _flag(relation["isTenPercentOwner"]).alias("is_ten_pct"), _flag(relation["isOther"]).alias("is_other"),
        F.transform(F.slice("x.reportingOwner", 2, 1000), lambda o: o["reportingOwnerId"]["rptOwnerName"]).alias("other_owners"),
        F.try_to_date("r.t.transactionDate.value", "yyyy-MM-dd").alias("transaction_date"), F.col("r.t.transactionCoding.transactionCode").alias("code"), shares.alias("shares"), price.alias("price"), F.round(shares * price, 2).alias("total_value"),
        _number(F.col("r.t.postTransactionAmounts.sharesOwnedFollowingTransaction.value")).alias("shares_after"), F.col("r.t.ownershipNature.directOrIndirectOwnership.value").alias("ownership"), F.nullif(F.array_join(notes, " | "), F.lit("")).alias("footnotes"),
    )


def read_form4_xml(spark, paths) -> DataFrame:
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))
    return parse_form4(files)


def _cell_text(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]+>", ""), r"\s+", " "))


def parse_senate_ptr(files: DataFrame) -> DataFrame:
    """Rows of the first striped table of report pages (file, content); the header row is skipped, a leading number column shifts the cells."""
    body = F.regexp_extract("content", r'(?is)<table[^>]*class="[^"]*table[^"]*striped[^"]*"[^>]*>(.*?)</table>', 1)
    rows = files.select("file", F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row", "tr")).where("row > 0")
    cells = rows.withColumn("td", F.regexp_extract_all("tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1))
    text = F.transform("td", _cell_text)
    cells = cells.withColumn("c", text).where(F.size("c") >= 7)
    shift = F.when(F.rlike(F.element_at("c", 1), F.lit(r"^\d+$")), 1).otherwise(0)
    cells = cells.withColumn("s", shift).where((F.col("s") == 0) | (F.size("c") >= 8))
    at = lambda k: F.get("c", F.col("s") + k)
    link = F.regexp_extract(F.get("td", F.col("s") + 2), r"(?is)<a[^>]*>(.*?)</a>", 1)
    ticker = F.when(F.trim(link) != "", F.trim(link)).when(at(2) != "--", at(2))
    return cells.select("file", "row", F.try_to_date(at(0), "MM/dd/yyyy").alias("date"), F.coalesce(F.nullif(at(1), F.lit("")), F.lit("Self")).alias("owner"), ticker.alias("ticker"), at(3).alias("asset"), at(4).alias("asset_type"), at(5).alias("transaction"), at(6).alias("amount"))


def parse_search_rows(responses: DataFrame) -> DataFrame:
    """Filings of search responses: ``responses`` has body, a JSON array of string arrays with at least five cells."""
    rows = responses.select(F.explode(F.from_json("body", "array<array<string>>")).alias("c")).where(F.size("c") >= 5)
    pattern = r"/search/view/(ptr|paper)/([a-f0-9-]+)/"
    link, kind, doc = F.col("c")[3], F.regexp_extract(F.col("c")[3], pattern, 1), F.regexp_extract(F.col("c")[3], pattern, 2)
    name = F.coalesce(F.nullif(F.trim(F.col("c")[2]), F.lit("")), F.concat_ws(" ", F.trim(F.col("c")[0]), F.trim(F.col("c")[1])))
    return rows.where(F.rlike(link, F.lit(pattern))).select(doc.alias("filing_id"), (kind == "paper").alias("is_paper"), name.alias("filer_name"), F.try_to_date(F.col("c")[4], "MM/dd/yyyy").alias("filing_date"))


def parse_house_index(files: DataFrame) -> DataFrame:
    """Periodic transaction reports of yearly index XML (content): doc_id, name, filing_date."""
    schema = "Member array<struct<Prefix string, First string, Last string, Suffix string, FilingType string, FilingDate string, DocID string>>"
    m = files.select(F.explode(F.from_xml("content", schema)["Member"]).alias("m"))
    part = lambda c: F.nullif(F.trim(F.col(f"m.{c}")), F.lit(""))
    return m.where((F.col("m.FilingType") == "P") & part("DocID").isNotNull()).select(part("DocID").alias("doc_id"), F.concat_ws(" ", part("First"), part("Last"), part("Suffix")).alias("name"), F.try_to_date("m.FilingDate", "M/d/yyyy").alias("filing_date"))


def parse_company_tickers(files: DataFrame) -> DataFrame:
    """Ticker to 10-digit CIK from issuer-map JSON (content); blank tickers are dropped, of duplicates the last entry stays."""
    rows = files.select(F.explode(F.from_json("content", "map<string, struct<cik_str:bigint, ticker:string, title:string>>")).alias("k", "v"))
    clean = rows.select(F.upper(F.trim("v.ticker")).alias("ticker"), F.lpad(F.col("v.cik_str").cast("string"), 10, "0").alias("cik"), F.col("k").cast("long").alias("k")).where("ticker <> ''")
    return clean.groupBy("ticker").agg(F.max_by("cik", "k").alias("cik"))


def read_universe(df: DataFrame, ciks: DataFrame) -> DataFrame:
    """Universe rows with cleaned column names; the CIK from the row or by ticker; rows without one are dropped."""
    import re

    df = df.toDF(*[re.sub(r"\W+", "_", c.strip().lower()) for c in df.columns])
    own = F.when(F.rlike(F.trim("cik"), F.lit(r"^\d+$")), F.lpad(F.trim("cik"), 10, "0")) if "cik" in df.columns else F.lit(None).cast("string")
    out = df.withColumn("_own", own).join(ciks.select("ticker", F.col("cik").alias("_found")), "ticker", "left")
    return out.withColumn("cik", F.coalesce("_own", "_found")).drop("_own", "_found").where("cik is not null")


def parse_committee_roster(files: DataFrame) -> DataFrame:
    """Members of committee rosters (file, content): lines ``CODE:``, ``- key: value`` (a new member) and ``  key: value``."""
    from pyspark.sql import Window as W

    lines = files.select("file", F.posexplode(F.split("content", "\n")).alias("i", "line")).where(F.trim("line") != "")
    code = F.nullif(F.regexp_extract("line", r"^(\w+):\s*$", 1), F.lit(""))
    starts = F.startswith(F.ltrim("line"), F.lit("- "))
    w = W.partitionBy("file").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    tagged = lines.withColumns({"code": F.last(code, True).over(w), "member": F.sum(starts.cast("int")).over(w), "key": F.regexp_extract("line", r"^\s*(?:- )?\s*(\w+):\s*(.*)$", 1), "value": F.trim(F.regexp_extract("line", r"^\s*(?:- )?\s*(\w+):\s*(.*)$", 2)), "top": code.isNotNull()})
    maps = tagged.where("not top and member > 0").groupBy("file", "code", "member").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("m"))
    return maps.select("file", "code", F.col("m")["name"].alias("name"), F.col("m")["party"].alias("party"), F.col("m")["rank"].try_cast("int").alias("rank"), F.col("m")["title"].alias("title"), F.col("m")["bioguide"].alias("bioguide"))


def parse_house_entry(entries: DataFrame) -> DataFrame:
    """Fields of page-text entries (entry_id, entry): owner, ticker, asset type, dates, amount range, transaction type."""
    e = F.col("entry")
    dates = F.regexp_extract_all(e, F.lit(r"(\d{1,2}/\d{1,2}/\d{4})"), 1)
    owner = F.regexp_extract(e, r"^\s*(SP|DC|JT)\b", 1)
    before = F.regexp_extract(e, r"^(.*?)\d{1,2}/\d{1,2}/\d{4}", 1)
    kind = (
        F.when(F.rlike(before, F.lit(r"(?i)\bS\s*\(partial\)")), "sale_partial").when(F.rlike(before, F.lit(r"\bS\s*$")), "sale").when(F.rlike(before, F.lit(r"\bE\s*$")), "exchange").otherwise("purchase")
    )
    money = lambda k: F.replace(F.regexp_extract(e, r"\$([\d,]+)\s*-\s*\$([\d,]+)", k), F.lit(","), F.lit("")).try_cast("long")
    return entries.select(
        "entry_id", F.when(owner == "SP", "spouse").when(owner == "DC", "dependent").when(owner == "JT", "joint").otherwise("self").alias("owner"), F.nullif(F.regexp_extract(e, r"\(([A-Z]{1,5}(?:\.[A-Z])?)\)", 1), F.lit("")).alias("ticker"),
        F.nullif(F.regexp_extract(e, r"\[([A-Z]{2})\]", 1), F.lit("")).alias("asset_type"), F.try_to_date(F.get(dates, F.lit(0)), "M/d/yyyy").alias("trade_date"), F.try_to_date(F.get(dates, F.lit(1)), "M/d/yyyy").alias("notification_date"),
        money(1).alias("low"), money(2).alias("high"), kind.alias("kind"),
    )


def parse_vendor_range(text: Column) -> Column:
    """struct(low, high) of ``$a - $b`` or a single amount."""
    clean = F.regexp_replace(text, r"[$,\s]", "")
    low = F.split(clean, "-")[0].try_cast("double")
    return F.struct(low.alias("low"), F.coalesce(F.get(F.split(clean, "-"), F.lit(1)).try_cast("double"), low).alias("high"))
