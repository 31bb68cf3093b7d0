"""Plans that read or compute a thing once."""

import datetime as dt

from pyspark.sql import functions as F

from tradelens import registry
from tradelens.plans import store_queries

FOLDER = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_parsed_once(spark):
    parsed = store_queries.forms.parse_form4(spark.createDataFrame([("a.xml", "<ownershipDocument/>")], "file string, content string"))
    out = store_queries.store.normalize_form4(parsed, store_queries.entities(spark, FOLDER))
    assert optimized(out).count("from_xml(") == 1


def test_probes_of_closes_are_not_sorted(spark):
    from tradelens.operators import studies

    day = lambda k: dt.date(2000, 1, k)
    prices = spark.createDataFrame([("A", day(3), 1.0), ("A", day(9), 2.0)], "ticker string, date date, close double")
    probes = spark.createDataFrame([("A", day(1)), ("A", day(3)), ("A", day(4)), ("A", day(10)), ("B", day(1)), (None, day(1)), ("A", None)], "ticker string, at date")
    out = studies.asof_forward(probes, prices, "ticker", "at")
    got = {(r.ticker, r["at"]): r.found_close for r in out.collect()}
    assert got == {("A", day(1)): 1.0, ("A", day(3)): 1.0, ("A", day(4)): 2.0, ("A", day(10)): None, ("B", day(1)): None, (None, day(1)): None, ("A", None): None}
    assert "Union" not in optimized(out)


def test_amendment_patterns_run_once_each(spark):
    from tradelens.sources import paper

    out = paper.parse_amendment_lines(spark.createDataFrame([("d", "x")], "doc string, text string"))
    assert optimized(out).count("Sale|Purchase") <= 12
