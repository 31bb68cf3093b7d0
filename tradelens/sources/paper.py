"""Filings' extracted text: House report pages, paper reports, amendment letters and paper Senate reports, as column expressions.

Documents come as rows (doc, text) or (doc, page, text). Lines are exploded, entries are numbered by a running
count of the lines that start one, and fields are regular expressions over an entry's text. Null and empty
texts have no rows; a document's lines are the largest thing a task holds at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.config import BRACKETS
from tradelens.functions.text import amount_bracket, asset_name_plausible, literal_map

#: Fixed values of the formats.
OWNERS = {"SP": "spouse", "DC": "dependent", "JT": "joint"}
BOILERPLATE = ("example", "provide full", "mega corp", "ticker symbol", "type of", "date of", "amount of", "transaction", "action", "certified", "penalty")
LONG_DATE = r"(\d{2}/\d{2}/\d{4})"
ANY_DATE = r"(\d{1,2}/\d{1,2}/\d{2,4})"
AMOUNT = r"(\$[\d,]+\s*-\s*\$[\d,]+|Over \$[\d,]+)"
_LOW, _HIGH = r"\$(\d[\d,\]\|Iil]*)", r"\$(\d[\d,\]\|Iil,]*)"
AMENDMENT = rf"(?i)^(.+?)\s+{_LOW}\s*[-–]\s*{_HIGH}\s+(Sale|Purchase)\s+(\d{{1,2}}/\d{{1,2}}/\d{{4}})\s+(Spouse|Self)\b"
AMENDMENT_SPLIT = rf"(?i)^(.+?)\s+{_LOW}\s*[-–]\s*(Sale|Purchase)\s+(\d{{1,2}}/\d{{1,2}}/\d{{4}})\s+(Spouse|Self)\b.*?{_HIGH}"


def _named(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _has(text: Column, pattern: str) -> Column:
    return F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False))


def _whole(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("long")


def _any_day(text: Column) -> Column:
    """A date with a year of two or four digits; two digits from 69 on are of the last century."""
    year = F.try_element_at(F.split(text, "/"), F.lit(-1))
    short = F.try_to_date(text, "M/d/yy")
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    return F.when(F.length(year) == 4, F.try_to_date(text, "M/d/yyyy")).when(F.length(year) == 2, short)


def _once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with columns that are computed once. They are exploded, as a later filter on them would be pushed below a plain column and compute it a second time."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _lines(docs: DataFrame, *keys: str) -> DataFrame:
    """Trimmed lines that are not blank, with their position."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", "")))
    return docs.select(*keys, F.posexplode(trimmed).alias("i", "line")).where("line <> ''")


def parse_house_metadata(docs: DataFrame) -> DataFrame:
    """doc, filing_id, filer_name, filer_status, state_district of reports (doc, text)."""
    field = lambda name: F.trim(_found(F.col("text"), rf"{name}:[ \t]*(.+?)[ \t]*(?:\n|$)"))
    return docs.select("doc", _found(F.col("text"), r"Filing ID #?(\d+)").alias("filing_id"), field("Name").alias("filer_name"), field("Status").alias("filer_status"), field("State/District").alias("state_district"))


def parse_house_pages(pages: DataFrame) -> DataFrame:
    """Entries of report pages (doc, page, text): doc, page, entry (from 1), text, lines, description, sub_owner.

    Rows begin after the line with Owner, Asset and Transaction and end at the certify line. A line starts an entry
    if it has an owner prefix, two dates, or a date and an amount; lines that begin with a dollar sign belong to the line
    before. Descriptions and sub-owners stand in lines of their own. An entry counts once a further one or the
    certify line follows on its page.
    """
    own = W.partitionBy("doc", "page").orderBy("i")
    so_far = own.rowsBetween(W.unboundedPreceding, 0)
    line = F.col("line")
    within = lambda letter: F.contains(F.substring(line, 1, 20), F.lit(letter))
    starts = lambda letter: F.startswith(line, F.lit(letter))
    header = F.contains(line, F.lit("Owner")) & F.contains(line, F.lit("Asset")) & F.contains(line, F.lit("Transaction"))
    labels = F.contains(line, F.lit("Type")) & F.contains(line, F.lit("Date")) & F.contains(line, F.lit("Gains"))
    certify = _has(line, r"CERTIFY|certify|(?i:asset type abbreviations)")
    marked = _lines(pages, "doc", "page").withColumns({"header": header, "certify": certify})
    marked = marked.withColumns({"open": F.max("header").over(so_far), "closed": F.max("certify").over(so_far), "certified": F.max("certify").over(W.partitionBy("doc", "page"))})
    rows = marked.where("open and not closed and not header").where(~labels)
    dates = F.size(F.regexp_extract_all(line, F.lit(LONG_DATE), 1))
    kind = (
        F.when((starts("F") & within("S") & F.contains(line, F.lit(":"))) | (starts("L") & within(":")), "dropped").when(starts("S") & within("O") & F.contains(line, F.lit(":")), "sub_owner")
        .when(starts("D") & within(":"), "description").when(_has(line, "^(SP|DC|JT) ") | (dates >= 2) | ((dates == 1) & _has(line, AMOUNT)), "entry").when(starts("$"), "amount").otherwise("more")
    )
    rows = _once(rows, {"kind": kind}).where("kind <> 'dropped'")
    rows = rows.withColumn("entry", F.sum((F.col("kind") == "entry").cast("int")).over(so_far))
    rows = rows.withColumn("last", F.max("entry").over(W.partitionBy("doc", "page")))
    noted = F.col("kind").isin("description", "sub_owner")
    # notes above the first entry are its own; other lines there belong to nothing
    rows = rows.where((F.col("entry") > 0) | noted).withColumn("entry", F.greatest("entry", F.lit(1)))
    rows = rows.where((F.col("entry") < F.col("last")) | F.col("certified"))
    text = F.when(noted, _found(line, r":\s*(.+)")).otherwise(line)
    pick = lambda c: F.collect_list(F.when(c, F.struct("i", text.alias("t"), F.col("kind").alias("k"))))
    grouped = rows.groupBy("doc", "page", "entry").agg(
        F.array_sort(pick(~noted)).alias("parts"), F.array_sort(pick(F.col("kind") == "description")).alias("d"), F.array_sort(pick(F.col("kind") == "sub_owner")).alias("s")
    )
    join = lambda c, by: F.nullif(F.array_join(F.transform(c, lambda x: x["t"]), by), F.lit(""))
    merged = F.aggregate(
        "parts", F.array().cast("array<string>"),
        lambda acc, x: F.when((x["k"] == "amount") & (F.size(acc) > 0), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(F.try_element_at(acc, F.lit(-1)), F.lit(" "), x["t"])))).otherwise(F.concat(acc, F.array(x["t"]))),
    )
    grouped = _once(grouped.where(F.size("parts") > 0), {"lines": merged})
    return grouped.select("doc", "page", "entry", F.array_join("lines", " ").alias("text"), "lines", join(F.col("d"), " ").alias("description"), join(F.col("s"), " | ").alias("sub_owner"))


def _entry_amount(text: Column, lines: Column) -> Column:
    """struct(low, high): a range; a dangling lower bound and a later upper one; two amounts in a line; an exact amount."""
    direct = _named(_found(text, AMOUNT), lambda d: F.when(d.isNotNull(), amount_bracket(d)))
    n = F.size(lines)
    bound = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    none = bound(F.lit(None).cast("long"), F.lit(None).cast("long"))

    def dangling(i: Column) -> Column:
        low = _whole(_found(F.try_element_at(lines, i), r"\$(\d{1,3}(?:,\d{3})*)\s*-\s*$"))
        later = F.filter(F.transform(F.slice(lines, i + 1, n), lambda x: F.try_element_at(F.regexp_extract_all(x, F.lit(r"\$(\d{1,3}(?:,\d{3})*)"), 1), F.lit(-1))), lambda x: x.isNotNull())
        return bound(low, _whole(F.get(later, F.lit(0))))

    def two(x: Column) -> Column:
        amounts = F.transform(F.regexp_extract_all(x, F.lit(r"\$([\d,]+)"), 1), _whole)
        return F.when((F.size(amounts) >= 2) & (F.try_element_at(amounts, F.lit(-1)) > F.try_element_at(amounts, F.lit(1))), bound(F.try_element_at(amounts, F.lit(1)), F.try_element_at(amounts, F.lit(-1))))

    exact = F.transform(lines, lambda x: F.floor(F.replace(_found(x, r"\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)\s*$"), F.lit(","), F.lit("")).try_cast("double")))
    first = lambda a, ok: F.get(F.filter(a, ok), F.lit(0))
    open_range = first(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), dangling), lambda x: x["low"].isNotNull() & x["high"].isNotNull())
    pair = first(F.transform(lines, two), lambda x: x.isNotNull())
    alone = first(exact, lambda x: x.isNotNull())
    return F.coalesce(direct, open_range, pair, F.when(alone.isNotNull(), bound(alone, alone)), none)


def house_entry_fields(entries: DataFrame) -> DataFrame:
    """Adds the fields of entries (text, lines): owner, ticker, asset_type, trade_date, notification_date, low, high, kind, asset_name."""
    text = F.col("text")
    code = _found(text, "^(SP|DC|JT)")
    body = F.trim(F.regexp_replace(text, "^(SP|DC|JT)", ""))
    out = entries.withColumns({"owner": F.coalesce(F.element_at(literal_map(OWNERS), code), F.lit("self")), "body": body})
    body = F.col("body")
    dates = F.regexp_extract_all(body, F.lit(LONG_DATE), 1)
    day = lambda k: F.try_to_date(F.get(dates, F.lit(k)), "MM/dd/yyyy")
    before = F.coalesce(_found(body, rf"^(.*?){LONG_DATE}"), F.when(F.size(dates) == 0, body), F.lit(""))
    out = out.withColumns({
        "ticker": _found(body, r"\(([A-Z]{1,5}(?:\.[A-Z])?)\)"), "asset_type": _found(body, r"\[([A-Z]{2})\]"), "trade_date": day(0), "notification_date": day(1),
        "amount": _entry_amount(body, F.col("lines")), "before": before, "dated": F.size(dates) > 0,
    })
    before = F.col("before")
    kind = F.when(~F.col("dated"), "purchase").when(F.contains(before, F.lit("S (partial)")), "sale_partial").when(_has(before, r"\bS\b"), "sale").when(_has(before, r"\bE\b"), "exchange").otherwise("purchase")
    name = F.regexp_replace(F.regexp_replace(F.trim(before), r"\s+[PSE]\s*$", ""), r"\s+S \(partial\)\s*$", "")
    name = F.when(F.col("asset_type").isNotNull(), F.regexp_replace(name, r"\s*\[[A-Z]{2}\]\s*$", "")).otherwise(name)
    name = F.when(F.col("ticker").isNotNull(), F.regexp_replace(name, r"\s*\([A-Z]{1,5}(?:\.[A-Z])?\)\s*$", "")).otherwise(name)
    out = out.withColumns({"low": F.col("amount.low"), "high": F.col("amount.high"), "kind": kind, "asset_name": F.trim(name)})
    return out.drop("body", "before", "dated", "amount")


def _digits(text: Column) -> Column:
    """An amount with the usual misread digits put right."""
    clean = F.regexp_replace(F.translate(text, "Iil|]", "11111"), r"[^\d,]", "")
    return F.when(_has(clean, "^1,?0001$"), F.lit(1_001).cast("long")).otherwise(_whole(clean))


def _without_tail(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, r"""\s+[~'"`.,;:]+\s*$""", ""))


def amendment_fields(line: Column) -> Column:
    """struct(owner, asset_name, kind, trade_date, low, high) of an amendment letter's line, null if it is none."""
    # each pattern is run once: its groups are put behind one another, the name, which may hold anything, last
    groups = lambda pattern, order: F.when(_has(line, pattern), F.split(F.regexp_replace(line, pattern + r"(?s:.*)$", order), "\x01", 6))
    found = F.coalesce(groups(AMENDMENT, "$6\x01$4\x01$5\x01$2\x01$3\x01$1"), groups(AMENDMENT_SPLIT, "$5\x01$3\x01$4\x01$2\x01$6\x01$1"))
    fields = lambda g: F.struct(
        F.when(F.lower(F.get(g, F.lit(0))) == "spouse", "spouse").otherwise("self").alias("owner"), _without_tail(F.trim(F.get(g, F.lit(5)))).alias("asset_name"),
        F.when(F.lower(F.get(g, F.lit(1))) == "sale", "sale").otherwise("purchase").alias("kind"), F.try_to_date(F.get(g, F.lit(2)), "M/d/yyyy").alias("trade_date"), _digits(F.get(g, F.lit(3))).alias("low"), _digits(F.get(g, F.lit(4))).alias("high"),
    )
    valid = lambda f: F.when(asset_name_plausible(f["asset_name"]) & f["trade_date"].isNotNull() & f["low"].isNotNull() & f["high"].isNotNull(), f)
    return _named(found, lambda g: F.when(g.isNotNull(), _named(fields(g), valid)))


def _kept(found: DataFrame) -> DataFrame:
    """Lines with fields f. They are exploded, as a filter on f would be pushed below it and compute it a second time."""
    return found.select("doc", F.col("i").alias("line"), F.inline(F.filter(F.array("f"), lambda f: f.isNotNull())))


def parse_amendment_lines(docs: DataFrame) -> DataFrame:
    """Transactions of amendment letters (doc, text): doc, line (from 0), owner, asset_name, kind, trade_date, low, high.

    An amount may go on in one of the next two lines.
    """
    own = W.partitionBy("doc").orderBy("i")
    lines = _lines(docs, "doc").withColumn("merged", F.concat_ws(" ", "line", F.lead("line", 1).over(own), F.lead("line", 2).over(own)))
    spaced = lambda c: F.regexp_replace(F.replace(c, F.lit("|"), F.lit(" | ")), r"\s+", " ")
    starts = _has(F.col("line"), r"(?i)\$.*\b(Sale|Purchase)\b.*\d{1,2}/\d{1,2}/\d{4}")
    found = lines.where(starts).withColumn("f", F.coalesce(amendment_fields(spaced(F.col("line"))), amendment_fields(spaced(F.col("merged")))))
    return _kept(found)


def paper_fields(line: Column) -> Column:
    """struct(owner, asset_name, ticker, kind, trade_date, notification_date, low, high) of a paper report's line, null if it is none."""
    brackets = literal_map({"ABCDEFGHIJ"[k]: f"{low}-{high}" for k, (_, low, high) in enumerate(BRACKETS)})
    spaced = F.regexp_replace(F.replace(line, F.lit("|"), F.lit(" | ")), r"\s+", " ")
    prefix = r"(?i)^(JT|SP|DC|st)\s*\|?\s*"
    base = F.struct(spaced.alias("l"), F.regexp_extract_all(spaced, F.lit(ANY_DATE), 1).alias("dates"), F.upper(F.regexp_extract(spaced, prefix, 1)).alias("code"), F.regexp_replace(spaced, prefix, "").alias("rest"))

    def parts(b: Column) -> Column:
        at = F.instr(b["rest"], F.get(b["dates"], F.lit(0)))
        before = F.substr(b["rest"], F.lit(1), F.greatest(at - 1, F.lit(0)))
        after = F.try_element_at(F.split(b["rest"], F.try_element_at(b["dates"], F.lit(-1))), F.lit(-1))
        return F.struct(b["l"].alias("l"), b["dates"].alias("dates"), b["code"].alias("code"), b["rest"].alias("rest"), at.alias("at"), before.alias("before"), after.alias("after"))

    def fields(p: Column) -> Column:
        name = p["before"]
        for pattern in (r"\s*[-–]\s*[A-Z]{1,5}(?:\.[A-Z])?\s*$", r"\s*\|+\s*$", r"^\s*\|+\s*", r"\s*[PSE]\s*$", r"\s+[xX]+\s*$"):
            name = F.regexp_replace(name, pattern, "")
        kind = (
            F.when(_has(p["before"], r"\bS\b"), "sale").when(_has(p["before"], r"\bE\b"), "exchange").when(_has(p["before"], r"\bP\b"), "purchase")
            .when(_has(p["before"], r"(?i)\bsale\b"), "sale").when(_has(p["before"], r"(?i)\bpurchase\b"), "purchase").when(_has(p["rest"], "[xX]"), "purchase")
        )
        column = F.upper(F.coalesce(_found(p["after"], r"[xX]\s*([A-J])"), _found(p["after"], r"([A-J])\s*[xX]")))
        first = F.regexp_extract(p["after"], r"[xX]\s*([A-J])|([A-J])\s*[xX]", 0)
        column = F.when(first != "", _found(first, "([A-J])")).otherwise(column)
        range_text = F.coalesce(F.when(_has(p["after"], r"\$[\d,]+\s*[-–]\s*\$[\d,]+"), F.regexp_replace(F.regexp_extract(p["after"], r"\$[\d,]+\s*[-–]\s*\$[\d,]+", 0), r"[$,\s]", "")), F.element_at(brackets, column), F.when(_has(p["after"], "[xX]"), "1001-15000"))
        bound = lambda k: F.get(F.split(range_text, "[-–]"), F.lit(k)).try_cast("long")
        day = lambda k: _any_day(F.get(p["dates"], F.lit(k)))
        return F.struct(
            F.coalesce(F.element_at(literal_map(OWNERS), p["code"]), F.lit("self")).alias("owner"), _without_tail(name).alias("asset_name"), _found(p["rest"], r"[-–]\s*([A-Z]{1,5}(?:\.[A-Z])?)\b").alias("ticker"), kind.alias("kind"),
            day(0).alias("trade_date"), day(1).alias("notification_date"), bound(0).alias("low"), bound(1).alias("high"), (p["at"] > 1).alias("placed"),
        )

    plain = _named(_named(_named(base, parts), fields), lambda f: F.when(f["placed"] & asset_name_plausible(f["asset_name"]) & f["kind"].isNotNull() & f["low"].isNotNull(), f.dropFields("placed")))
    letter = lambda a: F.when(
        a.isNotNull(),
        F.struct(a["owner"].alias("owner"), a["asset_name"].alias("asset_name"), F.lit(None).cast("string").alias("ticker"), a["kind"].alias("kind"), a["trade_date"].alias("trade_date"), F.lit(None).cast("date").alias("notification_date"), a["low"].alias("low"), a["high"].alias("high")),
    )
    return F.coalesce(_named(amendment_fields(spaced), letter), plain)


def parse_paper_text(docs: DataFrame) -> DataFrame:
    """Transactions of paper reports (doc, text): doc, line (from 0), owner, asset_name, ticker, kind, trade_date, notification_date, low, high.

    Short lines and those with words of the form itself are skipped. A line that names a sale or purchase and a
    date but is no transaction alone is tried again with the next two lines. Amounts are a written range, else the column
    letter next to a cross, else a bare cross for the lowest range.
    """
    own = W.partitionBy("doc").orderBy("i")
    every = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("i", "line")).withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", ""))
    part = lambda k: F.nullif(F.lead("line", k).over(own), F.lit(""))
    every = every.withColumn("merged", F.concat_ws(" ", F.nullif("line", F.lit("")), part(1), part(2)))
    lines = every.where((F.length("line") >= 10) & ~_has(F.lower("line"), "|".join(BOILERPLATE)))
    again = _has(F.col("line"), r"(?i)\b(Sale|Purchase)\b") & _has(F.col("line"), r"\d{1,2}/\d{1,2}/\d{4}")
    found = lines.withColumn("f", F.coalesce(paper_fields(F.col("line")), F.when(again, paper_fields(F.col("merged")))))
    return _kept(found)


def parse_senate_paper_text(docs: DataFrame) -> DataFrame:
    """Transactions of paper Senate reports (doc, text): doc, entry, owner, asset_name, ticker, kind, trade_date, low, high.

    The first line with a date or an amount opens an entry, every further line with a date starts another. Asset names are
    what is left without ticker, dates and amounts, at most 200 characters. Entries with a ticker, a name or a range are kept.
    """
    dated = _has(F.col("line"), r"\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}")
    priced = _has(F.col("line"), r"\$[\d,]+")
    own = W.partitionBy("doc").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    rows = _once(_lines(docs, "doc"), {"dated": dated, "priced": priced}).withColumn("any", F.max(F.col("dated") | F.col("priced")).over(own)).where("any")
    first = F.row_number().over(W.partitionBy("doc").orderBy("i")) == 1
    rows = rows.withColumn("starts", (F.col("dated") | first).cast("int")).withColumn("entry", F.sum("starts").over(own))
    entries = rows.groupBy("doc", "entry").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "\n").alias("text"))
    text = F.col("text")
    entries = _once(entries.where(F.length("text") >= 10), {"ticker": _found(text, r"\(([A-Z]{1,5})\)"), "lower": F.lower(text)})
    ticker, lower = F.col("ticker"), F.col("lower")
    day = F.coalesce(
        F.try_to_date(_found(text, r"(\d{1,2}/\d{1,2}/\d{4})"), "M/d/yyyy"), F.try_to_date(_found(text, r"(\d{1,2}-\d{1,2}-\d{4})"), "M-d-yyyy"),
        _any_day(_found(text, r"(\d{1,2}/\d{1,2}/\d{2})")),
    )
    pair = r"\$(\d{1,3}(?:,\d{3})*)\s*[-—]\s*\$(\d{1,3}(?:,\d{3})*)"
    statutory = None
    for name, low, high in BRACKETS:
        value = F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"))
        hit = F.contains(lower, F.lit(name.lower()))
        statutory = F.when(hit, value) if statutory is None else statutory.when(hit, value)
    amount = F.when(_has(text, pair), F.struct(_whole(F.regexp_extract(text, pair, 1)).alias("low"), _whole(F.regexp_extract(text, pair, 2)).alias("high"))).otherwise(statutory)
    kind = F.when(_has(lower, "purchase|buy|bought|acquire"), "purchase").when(_has(lower, "sale|sell|sold|dispos"), "sale").when(F.contains(lower, F.lit("exchange")), "exchange").otherwise("unknown")
    owner = F.when(_has(lower, "spouse| sp "), "spouse").when(_has(lower, "joint| jt "), "joint").when(_has(lower, "child| dc "), "dependent").otherwise("self")
    bare = F.when(ticker.isNotNull(), F.replace(text, F.concat(F.lit("("), ticker, F.lit(")")), F.lit(""))).otherwise(text)
    for pattern in (r"\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}", r"\$[\d,]+(?:\s*[-—]\s*\$[\d,]+)?"):
        bare = F.regexp_replace(bare, pattern, "")
    bare = F.trim(F.regexp_replace(bare, r"\s+", " "))
    out = _once(entries, {"bare": bare, "amount": amount})
    out = out.select(
        "doc", "entry", owner.alias("owner"), F.when(F.length("bare") > 3, F.substring("bare", 1, 200)).alias("asset_name"), "ticker", kind.alias("kind"), day.alias("trade_date"),
        "amount.low", "amount.high",
    )
    return out.where("ticker is not null or asset_name is not null or (low > 0 and high > 0)")
