"""Steps that many queries share: how often tables are read and shuffled."""

import os

import pytest
from pyspark.sql import functions as F

from tradelens import registry
from tradelens.operators import reports
from tradelens.plans import report_queries, signal_queries, store_queries, study_queries, trades

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(trades, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_trades_are_in_place_by_filing(spark, no_broadcast):
    t = trades.trades(spark, FOLDER)
    assert exchanges(t) == exchanges(t.groupBy("filing_id").agg(F.min("execution_date"))) == 4


@pytest.fixture
def reads(monkeypatch):
    """Counts the times that the joined trades are asked for."""
    count = []

    def counted(spark, sf_dir):
        count.append(1)
        return trades.trades(spark, sf_dir)

    for module in (report_queries, signal_queries, store_queries, study_queries):
        monkeypatch.setattr(module, "trades", counted)
    return count


@pytest.mark.parametrize("name, most", [("a16_daily_brief", 2), ("a16b_brief_contents", 2), ("a23b_run_observability", 2), ("a28b_vendor_validation", 1), ("t5_stream_supersede", 1)])
def test_trades_are_made_once_per_source(spark, reads, name, most):
    registry.QUERIES[name](spark, FOLDER)
    assert len(reads) <= most


def test_filings_of_the_supersede_stream_need_no_join(spark, monkeypatch, no_broadcast):
    landed = []
    monkeypatch.setattr(store_queries.sinks, "staging_path", lambda spark, name: landed.append(name) or "/nowhere")

    class Stop(Exception):
        pass

    def write(self, path):
        landed.append(exchanges(self._df))
        raise Stop

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", write)
    with pytest.raises(Stop):
        registry.QUERIES["t5_stream_supersede"](spark, FOLDER)
    assert landed[-1] == 4


def test_vendor_validation_counts_what_its_discrepancies_list(spark):
    columns = "id string, ticker string, action string, date date, amount double"
    import datetime as dt

    day = dt.date(2024, 1, 1)
    ours = spark.createDataFrame([("1", "A", "sale", day, 1.0), ("2", "A", "sale", day, 5.0), ("3", None, "sale", day, None), ("4", "B", None, day, 2.0)], columns)
    theirs = spark.createDataFrame([("v1", "A", "sale", day, 1.0), ("v2", "X", "sale", day, 9.0), ("v3", "A", "sale", None, None), ("v4", "B", "sale", day, None)], columns)
    matches = spark.createDataFrame([(k, f"v{k}") for k in "1234"], "a_id string, b_id string")
    found = {(r.a_id, r.kind) for r in reports.vendor_discrepancies(matches, ours, theirs).collect()}
    assert found == {("2", "ticker"), ("2", "amount"), ("4", "amount")}
    report = {(r.part, r.name): (r.value, r.detail) for r in reports.vendor_validation(matches, ours, theirs).collect()}
    assert report["metric", "matched"][0] == 4 and report["metric", "ticker_rate"][0] == 0.5 and report["metric", "amount_rate"][0] == 0.5
    assert report["discrepancy", "amount"][0] == 2 and report["sample", "2"][1] == "amount,ticker" and ("sample", "1") not in report


def test_patterns_of_forms_run_only_where_they_may_match(spark):
    from tradelens.functions import text
    from tradelens.sources import forms

    issuer, owner = "<issuer><issuerCik>7</issuerCik></issuer>", "<reportingOwner><reportingOwnerId><rptOwnerCik>9</rptOwnerCik></reportingOwnerId></reportingOwner>"
    txn = "<nonDerivativeTransaction><securityTitle><value>A</value></securityTitle><transactionCoding><transactionCode>P</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>1,200</value></transactionShares></transactionAmounts></nonDerivativeTransaction>"
    doc = lambda attributes, t: f"<ownershipDocument{attributes}>{issuer}{owner}<nonDerivativeTable>{t}</nonDerivativeTable></ownershipDocument>"
    plain = doc("", txn)
    prefixed = doc(' xmlns:n="http://e.org"', txn).replace("</", "</n:").replace("<", "<n:").replace("<n:/n:", "</n:")
    bare = doc("", "<nonDerivativeTransaction><securityTitle><value>A: b</value></securityTitle></nonDerivativeTransaction>")
    rows = [("plain", plain), ("default", doc(' xmlns="urn"', txn)), ("prefixed", prefixed), ("undeclared", prefixed.replace(' xmlns:n="http://e.org"', "")), ("bare", bare), ("broken", plain[:-5])]
    files = spark.createDataFrame(rows, "file string, content string")
    always = F.regexp_replace(F.regexp_replace("content", r'\sxmlns(:\w+)?="[^"]*"', ""), r"<(/?)\w+:", "<$1")
    cleaned = files.select("file", forms.without_namespaces(F.col("content")).alias("c"), always.alias("a"))
    assert cleaned.where("c <> a").count() == 0
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("Contains(content") >= 2
    got = {r.file: (r.parse_error, r.code, r.shares) for r in forms.parse_form4(files).collect()}
    assert got == {**dict.fromkeys(("plain", "default", "prefixed", "undeclared"), (False, "P", 1200.0)), "bare": (False, None, None), "broken": (True, None, None)}
    names = ["Some Issuer, Inc.", "OC Oerlikon - OC", "  ACME Cl. Class A", "Foo ADR", "Foo Sponsored ADR B", "x CMN CLASS A y", "Bar Common Stock", "Bar cmln", "", "...", None, "a b Procter c"]
    want = ["some issuer inc", "oerlikon", "acme cl", "foo", "foo b", "x y", "bar", "bar", None, None, None, "procter c"]
    got = [r.n for r in spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, s string").coalesce(1).select(text.entity_name_norm(F.col("s")).alias("n")).collect()]
    assert got == want
