"""Store operators against literal values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.operators import store
from tradelens.sources import forms, rosters

ENTITIES = [("AAPL", "0000320193", "entity:apple", "i:aapl", "Apple Inc.", "apple inc|apple"), ("MSFT", "", "entity:microsoft", "i:msft", "Microsoft Corporation", "")]
FORM = """<ownershipDocument><periodOfReport>2024-06-17</periodOfReport><issuer><issuerCik>0000320193</issuerCik><issuerName>APPLE INC</issuerName><issuerTradingSymbol>AAPL</issuerTradingSymbol></issuer>
<reportingOwner><reportingOwnerId><rptOwnerCik>0001234567</rptOwnerCik><rptOwnerName>DOE JOHN</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isOfficer>1</isOfficer><officerTitle>%s</officerTitle></reportingOwnerRelationship></reportingOwner>
<nonDerivativeTable>%s</nonDerivativeTable></ownershipDocument>"""
TXN = """<nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2024-06-15</value></transactionDate><transactionCoding><transactionCode>%s</transactionCode></transactionCoding>
<transactionAmounts><transactionShares><value>%s</value></transactionShares><transactionPricePerShare><value>185.50</value></transactionPricePerShare></transactionAmounts>
<postTransactionAmounts><sharesOwnedFollowingTransaction><value>50000</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>"""


def entities(spark):
    return rosters.read_canonical_entities(spark.createDataFrame(ENTITIES, "ticker string, cik string, entity_key string, instrument_key string, issuer_name string, name_aliases string"))


def test_form4_to_normalized(spark):
    files = [("a.xml", FORM % ("Chief Executive Officer", TXN % ("P", "10000") + TXN % ("P", "10") + TXN % ("M", "10000"))), ("b.xml", FORM % ("Former CEO", TXN % ("S", "10000"))), ("c.xml", "<ownershipDocument><issuer>")]
    parsed = forms.parse_form4(spark.createDataFrame(files, "file string, content string"))
    rows = store.normalize_form4(parsed, entities(spark)).orderBy("record_id").collect()
    got = [(r.record_id, r.role, r.value, r.included, r.reason_code, r.entity_key, r.subject_key, r.ticker) for r in rows]
    base = "0000320193:0001234567:2024-06-17"
    same = ("entity:apple", "entity:aapl", "AAPL")
    assert got == [
        (f"{base}:a:1", "ceo", 1855000.0, True, None, *same), (f"{base}:a:2", "ceo", 1855.0, False, "BELOW_MINIMUM_VALUE", *same), (f"{base}:a:3", "ceo", 1855000.0, False, None, *same),
        (f"{base}:b:1", "excluded", 1855000.0, False, "ENTITY_ROLE_EXCLUDED", *same),
    ]


def test_trade_level_slice(spark):
    day = dt.date(2024, 6, 10)
    legs = spark.createDataFrame(
        [("p:1", "entity:aapl", "AAPL", "purchase", 1001, 15000, "self", day, 0.99, True), ("p:2", "entity:msft", "MSFT", "sale_partial", 15001, 50000, "spouse", day, 0.99, True), ("p:3", "entity:x", None, "sale", 1, 2, "self", day, 0.5, False)],
        "record_id string, subject_key string, ticker string, action string, low long, high long, owner_type string, execution_date date, resolution_confidence double, included boolean",
    )
    files = spark.createDataFrame([("a.xml", FORM % ("CEO", TXN % ("P", "10000")))], "file string, content string")
    insiders = store.normalize_form4(forms.parse_form4(files), entities(spark))
    rows = {(r.source, r.subject_key): r for r in store.trade_level_signals(legs, insiders).collect()}
    assert rows["congress", "entity:aapl"].score == pytest.approx(2685.319112321662) and rows["congress", "entity:aapl"].label == "bullish"
    assert rows["congress", "entity:msft"].score == pytest.approx(-15183.375381251693) and rows["congress", "entity:msft"].label == "bearish"
    assert (rows["insider", "entity:aapl"].score, rows["insider", "entity:aapl"].label) == (0.0, "insufficient") and len(rows) == 3


def test_confidence_chains(spark):
    names = "overlap long, combined long, blocked long, congress_results long, missing_counterpart long, ambiguous long, house_candidates long, senate_candidates long, insider_candidates long, house_scored_rate double"
    cases = [
        ((0, 0, 0, 0, 0, 0, 0, 0, 0, 1.0), "no_cross_source_overlap", "pipeline_correct_but_signal_sparse"), ((10, 1, 9, 20, 6, 0, 0, 0, 0, 1.0), "sparse_counterpart_coverage", "pipeline_correct_but_signal_sparse"),
        ((10, 1, 9, 20, 0, 2, 0, 0, 0, 1.0), "entity_resolution_ambiguity", "pipeline_operational_needs_more_data_quality_work"), ((10, 1, 9, 20, 0, 1, 0, 3, 0, 1.0), "candidate_backlog", "pipeline_operational_needs_more_data_quality_work"),
        ((10, 1, 9, 20, 0, 1, 1, 0, 0, 0.05), "low_house_signal_extraction_rate", "pipeline_operational_needs_more_data_quality_work"),
        ((10, 1, 9, 20, 0, 1, 0, 0, 1, 0.5), "combined_layer_ready_for_strategy_evaluation", "ready_for_broader_live_strategy_validation"),
        ((10, 1, 9, 20, 0, 1, 1, 0, 1, 0.5), "combined_layer_ready_for_strategy_evaluation", "operationally_ready"),
    ]
    rows = store.production_confidence(spark.createDataFrame([c for c, _, _ in cases], names)).collect()
    assert [(r.primary_constraint, r.readiness) for r in rows] == [(a, b) for _, a, b in cases]


def test_ledger_and_new_columns(spark, tmp_path):
    ledger = sinks.RunLedger(spark, f"{tmp_path}/runs")
    ledger.start("one", {"b": 1, "a": 2})
    ledger.start("two", {})
    ledger.finish("one", {"n": 3})
    runs = {r.run_id: r for r in ledger.runs().collect()}
    assert (runs["one"].status, runs["one"].params, runs["one"].summary) == ("SUCCEEDED", '{"a": 2, "b": 1}', '{"n": 3}') and runs["two"].status == "STARTED" and runs["two"].finished is None
    sinks.write_with_new_columns(spark.range(2), f"{tmp_path}/t")
    sinks.write_with_new_columns(spark.range(2).withColumn("more", F.lit("x")), f"{tmp_path}/t")
    assert sorted((r.id, r.more) for r in sinks.read_with_new_columns(spark, f"{tmp_path}/t").where("id = 1").collect() if r.more) == [(1, "x")]


def test_members_and_lists(spark):
    body = '{"members": [{"bioguideId": "A1", "name": "Lee, Ann", "partyName": "I", "state": "Ohio", "terms": {"item": {"chamber": "Senate"}}}, {"name": "no id"}]}'
    seats = spark.createDataFrame([("A1", "SSBA", "Chair"), ("A1", "ssba01", None), ("Z9", "hssy", None)], "bioguide string, code string, title string")
    row = rosters.read_members(spark.createDataFrame([(body,), ("broken",), (None,)], "body string"), seats).collect()
    assert len(row) == 1 and row[0].chamber == "Senate" and [c.code for c in row[0].committees] == ["ssba", "ssba01"]
    with pytest.raises(ValueError):
        rosters.load_results(spark.createDataFrame([], "run_id string, source string, provenance_refs string"), run_id="a", run_ids=["b"])
