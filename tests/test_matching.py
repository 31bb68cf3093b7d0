import datetime as dt
import random

import pytest

from tradelens import registry
from tradelens.operators import matching, resolve

KIND = "id string, ticker string, action string, date date, amount double"
FOLDER = "/root/testdata/sf0.001"


def test_no_two_trades_would_both_score_more_together(spark):
    rng = random.Random(7)
    day = lambda: None if rng.random() < 0.05 else dt.date(1995, 1, 1) + dt.timedelta(rng.randrange(120))
    amounts = [None, 0.0, -5.0, 90.0, 100.0, 105.0, 110.5, 500.0]
    side = lambda p, n, t: [(f"{p}{i}", rng.choice(["A", "B", t]), rng.choice(["P", "S", None]), day(), rng.choice([*amounts, float(rng.randrange(80, 700))])) for i in range(n)]
    a, b = (spark.createDataFrame(rows, KIND) for rows in (side("a", 300, "C"), side("b", 200, None)))
    got = matching.match_trades(a, b).collect()
    pairs = {(r.a_id, r.b_id): r.score for r in resolve.vendor_pair_scores(a, b).collect()}
    ours, theirs = {r.a_id: r.score for r in got}, {r.b_id: r.score for r in got}
    assert len(got) == len(ours) == len(theirs) > 100
    assert all(pairs[r.a_id, r.b_id] == r.score for r in got)
    assert [p for p, s in pairs.items() if ours.get(p[0], 0) < s and theirs.get(p[1], 0) < s] == []


@pytest.mark.parametrize("name", ["j16b_match_vendor_trades", "a28_vendor_match_report"])
def test_matching_makes_no_table_of_pairs(spark, monkeypatch, name):
    def pairs(*_):
        raise AssertionError("pairs grow with the square of a ticker's trades")

    monkeypatch.setattr(resolve, "vendor_pair_scores", pairs)
    assert registry.QUERIES[name](spark, FOLDER).count() > 0
