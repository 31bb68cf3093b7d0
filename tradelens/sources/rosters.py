"""Readers of metadata around filings: sidecars, canonical entities, members, filing lists, prices, vendor feeds and stored results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.text import entity_name_norm
from tradelens.sources.forms import parse_vendor_range

_MEMBERS = "struct<members: array<struct<bioguideId: string, name: string, partyName: string, state: string, terms: struct<item: string>>>>"


def file_stem(path: Column) -> Column:
    """File name without folders and its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def read_filing_sidecar(filings: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Adds filer_name, filing_date and is_paper from sidecar files to filings (file).

    ``sidecars``: file, content (a JSON object). They meet by file stem; a missing or corrupt sidecar gives nulls, and of
    several for a stem the first by name counts.
    """
    schema = "filing_id string, filer_name string, filing_date string, is_paper boolean"
    parsed = sidecars.select(file_stem(F.col("file")).alias("stem"), "file", F.from_json("content", schema).alias("j"))
    one = parsed.groupBy("stem").agg(F.min_by("j", "file").alias("j"))
    day = F.try_to_date(F.substring("j.filing_date", 1, 10), "yyyy-MM-dd")
    out = filings.withColumn("stem", file_stem(F.col("file"))).join(one, "stem", "left")
    return out.select(*filings.columns, F.col("j.filer_name").alias("filer_name"), day.alias("filing_date"), F.col("j.is_paper").alias("is_paper"))


def read_canonical_entities(rows: DataFrame) -> DataFrame:
    """Canonical entities (entity_key, instrument_key, ticker, cik, issuer_name, aliases) from rows with ``name_aliases`` split by ``|``.

    The issuer name is the first alias; blank CIKs are null. This is the dimension of ``resolve_entities``.
    """
    names = F.concat(F.array("issuer_name"), F.filter(F.split(F.coalesce("name_aliases", F.lit("")), r"\|"), lambda a: a != ""))
    return rows.select("entity_key", "instrument_key", F.upper(F.trim("ticker")).alias("ticker"), F.nullif(F.trim("cik"), F.lit("")).alias("cik"), "issuer_name", names.alias("aliases"))


def entities_by_alias(entities: DataFrame) -> DataFrame:
    """alias (normalized) and the sorted keys of the entities that carry it."""
    named = entities.select("entity_key", F.explode("aliases").alias("a")).select("entity_key", entity_name_norm(F.col("a")).alias("alias"))
    return named.where("alias is not null").groupBy("alias").agg(F.array_sort(F.collect_set("entity_key")).alias("entity_keys"))


def read_members(responses: DataFrame, committees: DataFrame) -> DataFrame:
    """Members of roster responses (body: JSON with ``members``) with the chamber of their last term and their committees.

    ``committees``: bioguide, code, title. Returns bioguide, name, party, state, chamber, committees (array of code and title,
    sorted by code). Members without an id are left out; of repeated ids the last response by name counts.
    """
    members = responses.select(F.explode(F.from_json("body", _MEMBERS)["members"]).alias("m"))
    terms = F.col("m.terms.item")
    last = F.coalesce(F.try_element_at(F.from_json(terms, "array<struct<chamber: string>>"), F.lit(-1)), F.from_json(terms, "struct<chamber: string>"))
    rows = members.where("m.bioguideId <> ''").select(F.col("m.bioguideId").alias("bioguide"), F.col("m.name").alias("name"), F.col("m.partyName").alias("party"), F.col("m.state").alias("state"), last["chamber"].alias("chamber"))
    one = rows.groupBy("bioguide").agg(F.max_by(F.struct("name", "party", "state", "chamber"), "name").alias("m")).select("bioguide", "m.*")
    own = committees.groupBy("bioguide").agg(F.array_sort(F.collect_list(F.struct(F.lower("code").alias("code"), "title"))).alias("committees"))
    return one.join(own, "bioguide", "left").withColumn("committees", F.coalesce("committees", F.array().cast("array<struct<code: string, title: string>>")))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Daily closes (ticker, date, close) from parquet; rows without one of the three are dropped, of several closes of a day the last by value counts."""
    df = spark.read.parquet(path).select(F.upper(F.trim("ticker")).alias("ticker"), F.col("date").cast("date").alias("date"), F.col("close").cast("double").alias("close"))
    return df.where("ticker is not null and date is not null and close is not null").groupBy("ticker", "date").agg(F.max("close").alias("close"))


def read_vendor_trades(bodies: DataFrame) -> DataFrame:
    """Trades of vendor responses (body: JSON array): name, ticker, action, date, low, high.

    A range is ``$a - $b`` or one amount; dates are ``yyyy-MM-dd`` or ``MM/dd/yyyy``; actions are purchase, sale or exchange.
    """
    schema = "array<struct<Representative: string, Ticker: string, Transaction: string, TransactionDate: string, Range: string>>"
    t = bodies.select(F.explode(F.from_json("body", schema)).alias("t"))
    day = F.coalesce(F.try_to_date("t.TransactionDate", "yyyy-MM-dd"), F.try_to_date("t.TransactionDate", "MM/dd/yyyy"))
    kind = F.lower("t.Transaction")
    action = F.when(F.contains(kind, F.lit("purchase")), "purchase").when(F.contains(kind, F.lit("sale")), "sale").when(F.contains(kind, F.lit("exchange")), "exchange")
    bounds = parse_vendor_range(F.col("t.Range"))
    name = F.upper(F.trim(F.regexp_replace("t.Representative", r"\s+", " ")))
    return t.select(name.alias("name"), F.upper(F.trim("t.Ticker")).alias("ticker"), action.alias("action"), day.alias("date"), bounds["low"].alias("low"), bounds["high"].alias("high"))


def _listed(accession: Column, day: Column, form: Column, cik: Column) -> list[Column]:
    amended = F.contains(form, F.lit("/A"))
    return [accession.alias("accession"), day.alias("filing_date"), form.alias("form_type"), amended.alias("is_amendment"), F.lpad(cik, 10, "0").alias("issuer_cik")]


def parse_atom_feed(feeds: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filings of Atom feeds (issuer_cik, content): accession, filing_date (text), form_type, is_amendment, issuer_cik, link; bounds compare as text."""
    content = "array<struct<content: struct<`accession-number`: string, `filing-date`: string, `filing-href`: string, `filing-type`: string>>>"
    clean = F.regexp_replace(F.regexp_replace("content", r'\sxmlns(:\w+)?="[^"]*"', ""), r"<(/?)\w+:", "<$1")
    e = feeds.select("issuer_cik", F.explode(F.from_xml(clean, f"entry {content}")["entry"]["content"]).alias("e"))
    day = F.trim("e.filing-date")
    out = e.select(*_listed(F.trim("e.accession-number"), day, F.coalesce(F.nullif(F.trim("e.filing-type"), F.lit("")), F.lit("4")), F.col("issuer_cik")), F.trim("e.filing-href").alias("link")).where("accession <> ''")
    undated = F.coalesce("filing_date", F.lit("")) == ""
    if start:
        out = out.where(undated | (F.col("filing_date") >= start))
    return out.where(undated | (F.col("filing_date") <= end)) if end else out


def parse_search_hits(responses: DataFrame) -> DataFrame:
    """Filings of search responses (issuer_cik, body) whose hits name the issuer: accession, filing_date, form_type, is_amendment, issuer_cik."""
    schema = "struct<hits: struct<hits: array<struct<_source: struct<adsh: string, ciks: array<string>, root_form: string, file_date: string>>>>>"
    h = responses.select("issuer_cik", F.explode(F.from_json("body", schema)["hits"]["hits"]["_source"]).alias("h"))
    bare = lambda c: F.regexp_replace(c, "^0+", "")
    own = F.exists(F.coalesce("h.ciks", F.array().cast("array<string>")), lambda c: bare(c) == bare(F.col("issuer_cik")))
    form = F.coalesce("h.root_form", F.lit("4"))
    return h.where((F.col("h.adsh") != "") & own).select(*_listed(F.col("h.adsh"), F.coalesce("h.file_date", F.lit("")), form, F.col("issuer_cik")))


def parse_result_table(pages: DataFrame, chamber: str) -> DataFrame:
    """Filings of result pages (content) of the house or the senate: filing_id, filer_name, state, district, filing_date, is_paper.

    Rows need three cells and a link with an id: the number of a PDF, or the id behind /view/ptr/ or /view/paper/.
    """
    pattern = r"/(\d+)\.pdf" if chamber == "house" else r"/(?:ptr|paper)/([a-f0-9-]+)"
    rows = pages.select(F.explode(F.regexp_extract_all("content", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("tr"))
    text = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]+>", ""), r"\s+", " "))
    cells = rows.withColumn("td", F.transform(F.regexp_extract_all("tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1), text)).where(F.size("td") >= 3)
    link = F.regexp_extract("tr", r"""(?is)<a[^>]*href\s*=\s*["']?([^"'\s>]+)""", 1)
    place, parts = F.col("td")[1], F.split(F.col("td")[1], "-")
    split = (chamber == "house") & F.contains(place, F.lit("-")) if chamber == "house" else F.lit(False)
    out = cells.select(
        F.regexp_extract(link, pattern, 1).alias("filing_id"), F.col("td")[0].alias("filer_name"), F.when(split, F.trim(parts[0])).otherwise(place).alias("state"), F.when(split, F.trim(F.get(parts, F.lit(1)))).alias("district"),
        F.try_to_date(F.col("td")[2], "MM/dd/yyyy").alias("filing_date"), F.contains(link, F.lit("/paper/")).alias("is_paper"),
    )
    return out.where("filing_id <> ''")


def filer_names(filings: DataFrame, index: DataFrame, metadata: DataFrame) -> DataFrame:
    """Adds filer to filings (filing_id, parsed_name): by the yearly index (doc_id, name), by the first eight characters of the id in
    the metadata (filing_id, name), else the parsed name, else Unknown. Each lookup has one name per key, so no filing multiplies."""
    by_doc = index.groupBy(F.col("doc_id").alias("filing_id")).agg(F.max("name").alias("index_name"))
    by_start = metadata.groupBy(F.substring("filing_id", 1, 8).alias("start")).agg(F.max("name").alias("start_name"))
    out = filings.withColumn("start", F.substring("filing_id", 1, 8)).join(by_doc, "filing_id", "left").join(by_start, "start", "left")
    named = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return out.select(*filings.columns, F.coalesce(named("index_name"), named("start_name"), named("parsed_name"), F.lit("Unknown")).alias("filer"))


def _of_runs(rows: DataFrame, run_id: str | None, run_ids: list[str] | None) -> DataFrame:
    """Rows of one run or of a list of runs; of all where none is named."""
    if run_id is not None and run_ids:
        raise ValueError("pass either run_id or run_ids, not both")
    wanted = run_ids if run_ids else [run_id] if run_id is not None else None
    return rows.where(F.col("run_id").isin(wanted)) if wanted else rows


def load_results(results: DataFrame, source: str | None = None, run_id: str | None = None, run_ids: list[str] | None = None) -> DataFrame:
    """Stored results by source and run, with their JSON column provenance_refs decoded; either one run or a list of runs may be named."""
    results = _of_runs(results, run_id, run_ids)
    if source is not None:
        results = results.where(F.col("source") == source)
    refs = "struct<normalized_row_ids: array<string>, resolution_event_ids: array<string>>"
    return results.withColumn("provenance_refs", F.from_json("provenance_refs", refs))


def load_combined(combined: DataFrame, run_id: str | None = None, run_ids: list[str] | None = None) -> DataFrame:
    """Stored overlay results by run, with their JSON column refs (the results of both sides) decoded; text that is no JSON gives null."""
    return _of_runs(combined, run_id, run_ids).withColumn("refs", F.from_json("refs", "struct<insider: string, congress: string>"))


def load_blocks(blocks: DataFrame, run_id: str | None = None, run_ids: list[str] | None = None) -> DataFrame:
    """Stored block events by run, with their JSON column payload decoded to a map."""
    return _of_runs(blocks, run_id, run_ids).withColumn("payload", F.from_json("payload", "map<string, string>"))


def latest_results(results: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last stored row per key across runs; ties go to the larger run id."""
    w = W.partitionBy(*keys).orderBy(F.desc(order), F.desc("run_id"))
    return results.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")
