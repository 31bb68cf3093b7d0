"""Readers of filings' text against literal examples."""

import datetime as dt

from tradelens.sources import paper

D = dt.date


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc int, text string")


def test_house_pages(spark):
    page = """Filing ID #20012345
Name: Hon. Ann Lee
Status: Member
State/District: NY01
ID Owner Asset Transaction Date Notification Amount Cap.
Type Date Gains >
SP Apple Inc. (AAPL) [ST] S (partial) 01/10/2024 01/12/2024 $1,001 - $15,000
F S: New
S O: Family Trust
D: sold some
Big Company Common Stock (BIG.B) [ST] P 02/10/2024 02/12/2024 $15,001 -
$50,000
L: US
Other Fund E 03/10/2024 03/11/2024 Over $50,000,000
JT Plain Bond
P 04/10/2024 04/11/2024 $1,234.50
* For the complete list of asset type abbreviations, see the site
SP Late (LATE) [ST] P 05/10/2024 05/11/2024 $1,001 - $15,000"""
    pages = spark.createDataFrame([("a", 1, page), ("a", 2, "Owner Asset Transaction\nSP X (X) [ST] P 01/10/2024 01/12/2024 $1,001 - $15,000"), ("b", 1, None), ("b", 2, "")], "doc string, page int, text string")
    meta = paper.parse_house_metadata(pages.where("page = 1")).where("doc = 'a'").first()
    assert tuple(meta) == ("a", "20012345", "Hon. Ann Lee", "Member", "NY01")
    rows = paper.house_entry_fields(paper.parse_house_pages(pages)).orderBy("doc", "page", "entry").collect()
    got = [(r.entry, r.owner, r.asset_name, r.ticker, r.asset_type, r.kind, r.trade_date, r.notification_date, r.low, r.high) for r in rows]
    assert got == [
        (1, "spouse", "Apple Inc.", "AAPL", "ST", "sale_partial", D(2024, 1, 10), D(2024, 1, 12), 1001, 15000),
        (2, "self", "Big Company Common Stock", "BIG.B", "ST", "purchase", D(2024, 2, 10), D(2024, 2, 12), 15001, 50000),
        (3, "self", "Other Fund", None, None, "exchange", D(2024, 3, 10), D(2024, 3, 11), 50000001, 100000000),
        # the line of the dates starts an entry of its own and has the exact amount; the name before it is an entry too
        (4, "joint", "Plain Bond", None, None, "purchase", None, None, None, None),
        (5, "self", "P", None, None, "purchase", D(2024, 4, 10), D(2024, 4, 11), 1234, 1234),
    ]
    assert [(r.description, r.sub_owner) for r in rows][:2] == [("sold some", "Family Trust"), (None, None)]
    assert paper.parse_house_pages(pages.limit(0)).count() == 0


def test_amounts_of_entries(spark):
    cases = [(["A $1,001 -", "x", "and $15,000 here"], 1001, 15000), (["B $20 then $30"], 20, 30), (["C $30 then $20"], 20, 20), (["D nothing"], None, None), (["E $15,001 - $50,000"], 15001, 50000)]
    df = spark.createDataFrame([(k, lines, " ".join(lines)) for k, (lines, _, _) in enumerate(cases)], "id int, lines array<string>, text string")
    got = paper.house_entry_fields(df).orderBy("id").collect()
    assert [(r.low, r.high) for r in got] == [(low, high) for _, low, high in cases]


def test_paper_samples(spark):
    sample = "NAME: JOHN DOE MEMBER\nFiling ID: 8229999\nSP | Apple Inc - AAPL P 03/01/2026 03/02/2026 x A\nSelf | Microsoft Corp - MSFT S 03/03/2026 03/04/2026 x C"
    letter = "Dynatrace, Inc. $1,0001 - Sale 03/27/2024 Spouse\nCommon Stock | $15,000\nHumana Inc. $1,0001 - Sale 03/27/2024 Self\nCommon Stock | $15,000\nSynopsys, Inc. $1,0001 - Purchase 03/27/2024 Self\nCommon Stock | $15,000"
    recoverable = "{WALMARTINCCMN — - x | 12/05/25} 01/04/26 x\nOC | NVIDIA CORPORATION CMN x 12/05/25] 01/04/26] x\nCOLGATE-PALMOLIVE CO CMN x 12/30/25} 01/04/26] x\nBUILDERS FIRSTSOURCE, INC. CMN x 12/31/25 01/04/26 x"
    nothing = "UNITED STATES HOUSE OF REPRESENTATIVES\nPeriodic Transaction Report\n\nNothing to report for December 2025"
    noise = "pc _ | USD x } 12-16-2025 - 01/04/26 x\nj{CLASSA x 12/05/25} _01/04/26 | x\nsP__}CMN x 12/11/25 01/04/26"
    rows = paper.parse_paper_text(docs(spark, sample, letter, recoverable, nothing, noise)).orderBy("doc", "line").collect()
    by_doc = lambda k: [r for r in rows if r.doc == k]
    assert [(r.owner, r.ticker, r.kind, r.trade_date, r.notification_date, r.low, r.high) for r in by_doc(0)] == [
        ("spouse", "AAPL", "purchase", D(2026, 3, 1), D(2026, 3, 2), 1001, 15000), ("self", "MSFT", "sale", D(2026, 3, 3), D(2026, 3, 4), 50001, 100000),
    ]
    assert [(r.asset_name, r.kind, r.owner, r.low, r.high) for r in by_doc(1)] == [("Dynatrace, Inc.", "sale", "spouse", 1001, 15000), ("Humana Inc.", "sale", "self", 1001, 15000), ("Synopsys, Inc.", "purchase", "self", 1001, 15000)]
    assert len(by_doc(2)) == 4 and all((r.low, r.high, r.trade_date.year) == (1001, 15000, 2025) for r in by_doc(2))
    assert by_doc(3) == []
    amended = paper.parse_amendment_lines(docs(spark, letter)).orderBy("line").collect()
    assert [(r.asset_name, r.kind, r.trade_date, r.low, r.high) for r in amended] == [("Dynatrace, Inc.", "sale", D(2024, 3, 27), 1001, 15000), ("Humana Inc.", "sale", D(2024, 3, 27), 1001, 15000), ("Synopsys, Inc.", "purchase", D(2024, 3, 27), 1001, 15000)]


def test_senate_paper(spark):
    text = "Report of trades\n01/05/2024 Apple Inc (AAPL)\nPurchase Spouse $1,001 - $15,000\n2-7-2024 Big Bond sold jointly Over $50,000,000\nmore\n3/8/69 some exchange"
    rows = paper.parse_senate_paper_text(docs(spark, text, None, "")).orderBy("entry").collect()
    assert [(r.owner, r.ticker, r.kind, r.trade_date, r.low, r.high) for r in rows] == [
        ("spouse", "AAPL", "purchase", D(2024, 1, 5), 1001, 15000), ("joint", None, "sale", D(2024, 2, 7), 50000001, 100000000), ("self", None, "exchange", D(1969, 3, 8), None, None),
    ]
    assert rows[0].asset_name == "Apple Inc Purchase Spouse"


def test_fields_are_computed_once(spark):
    """No filter computes a field a second time: each pattern stands once in the plan."""
    docs = spark.createDataFrame([("d", 1, "05/06/2020 Some Company (ABC)\nPurchase $1,001 - $15,000")], "doc string, page int, text string")
    senate = paper.parse_senate_paper_text(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert senate.count(r"\(([A-Z]{1,5})\)") == 1
    assert senate.count(r"^\s+|\s+$") == 1
    house = paper.parse_house_pages(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert house.count("^(SP|DC|JT) ") == 1
