"""Fixed cases of the column functions and scores."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradelens.functions import numeric as N
from tradelens.functions import text as T
from tradelens.operators import resolve, signals, studies


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def day():
    return F.lit(dt.date(2026, 3, 1))


def reference():
    return F.lit(dt.date(2026, 4, 2))


def test_insider_recency_and_size(spark):
    assert one(spark, N.recency(day(), reference())) == pytest.approx(0.6109134395363373)
    assert one(spark, N.size_signal(F.lit(0.05))) == 0.8
    assert one(spark, N.size_signal(F.lit(None).cast("double"))) == 0.6


def test_legislator_score(spark):
    none = F.lit(None).cast("date")
    row = one(spark, N.legislator_txn_score(F.lit("purchase"), F.lit(15001), F.lit(50000), F.lit("self"), day(), none, reference(), F.lit(1.0), F.lit(1.0)))
    assert (row.base, row.stale, row.raw, row.final) == pytest.approx((27387.040730973473, 0.6910106796357246, 18924.73762872125, 13247.316340104875))


@pytest.mark.parametrize(("days", "weight"), [(30, 1.0), (45, 0.85), (90, 0.6), (180, 0.3), (None, 0.7)])
def test_lag_weight(spark, days, weight):
    disclosed = F.lit(None).cast("date") if days is None else F.date_add(day(), days)
    assert one(spark, N.disclosure_lag_weight(day(), disclosed)) == weight


@pytest.mark.parametrize(("a", "b", "m", "tier"), [(0.8, 0.75, 0.5, "strong"), (0.5, 0.5, 0.1, "moderate"), (0.3, 0.8, 0.5, "weak"), (0.8, 0.8, 0.2, "moderate")])
def test_strength_tier(spark, a, b, m, tier):
    assert one(spark, N.strength_tier(F.lit(a), F.lit(b), F.lit(m))) == tier


def test_rank(spark):
    assert one(spark, N.insider_rank(F.lit("ceo"), F.lit(False), F.lit("D"), F.lit(0.02), F.date_sub(reference(), 4), reference())["rank"]) == 8
    assert one(spark, N.insider_rank(F.lit("officer_other"), F.lit(True), F.lit("I"), F.lit(None).cast("double"), F.lit(None).cast("date"), reference())["rank"]) == 1


@pytest.mark.parametrize(("change", "weight"), [(-0.05, 1.1), (0.1, 0.95), (0.0, 1.0), (None, 1.0)])
def test_regime(spark, change, weight):
    assert one(spark, N.regime_of(F.lit(change).cast("double")))["weight"] == weight


@pytest.mark.parametrize(
    ("title", "role"),
    [("Senior Vice President", "officer_other"), ("President", "president"), ("President and CEO", "ceo"), ("Former CEO", "excluded"), ("Chief Financial Officer", "cfo"), ("Exec. Chair", "chair")],
)
def test_roles(spark, title, role):
    no = F.lit(False)
    assert one(spark, T.role_class(F.lit(title), F.lit("DOE JOHN"), F.lit(True), no, no, no))["role"] == role


def test_nulls_do_not_fail(spark):
    none = F.lit(None).cast("string")
    for f in (T.entity_name_norm, T.filer_name_norm, T.senator_name_norm, T.ticker_canonical, T.amount_bracket, T.filing_format):
        assert one(spark, f(none)) is None
    assert one(spark, T.owner_norm(none)) == "self"
    assert one(spark, T.txn_class(none)) == "unknown"
    assert one(spark, T.planned_trade(none)) is False


def test_lone_insider_is_not_capped_and_others_are(spark):
    rows = [("entity:a", i, dt.date(2026, 3, 20), True, 1.0, s) for i, s in ((1, 1.0), (1, 1.0))] + [("entity:b", i, dt.date(2026, 3, 20), True, 1.0, s) for i, s in ((1, 9.0), (2, 1.0))]
    df = spark.createDataFrame(rows, "subject_key string, actor_id long, execution_date date, included boolean, direction_weight double, signal double")
    out = {r.subject_key: r for r in signals.insider_company_signal(df, reference()).where("window_days = 30").collect()}
    assert out["entity:a"].score == pytest.approx(0.964, abs=1e-3)
    assert out["entity:b"].unique_buyers == 2 and out["entity:b"].buy_count == 2


def test_forward_returns_take_the_first_close_on_or_after(spark):
    prices = spark.createDataFrame([("A", dt.date(2026, 1, 5), 10.0), ("A", dt.date(2026, 1, 12), 11.0)], "ticker string, date date, close double")
    events = spark.createDataFrame([("A", dt.date(2026, 1, 3)), ("A", dt.date(2026, 1, 6)), ("B", dt.date(2026, 1, 3))], "ticker string, event_date date")
    got = {(r.ticker, r.event_date.day): r.forward_return for r in studies.forward_returns(events, prices, [5]).collect()}
    assert got[("A", 3)] == pytest.approx(0.1) and got[("A", 6)] == pytest.approx(0.0) and got[("B", 3)] is None


def test_matches_are_one_to_one(spark):
    pairs = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.9), ("b", "x", 0.8), ("b", "y", 0.6)], "a_id string, b_id string, score double")
    got = {(r.a_id, r.b_id) for r in resolve.match_vendor_trades(pairs).collect()}
    assert got == {("a", "x"), ("b", "y")}


def test_all_ties_are_matched(spark):
    block = [(f"a{i:02}", f"b{j:02}", 0.8) for i in range(50) for j in range(50)]
    ladder = [(f"c{i:02}", f"d{j:02}", 0.8) for i in range(30) for j in range(i + 1)]
    got = resolve.match_vendor_trades(spark.createDataFrame(block + ladder, "a_id string, b_id string, score double")).collect()
    assert sum(r.a_id < "b" for r in got) == 50 and len({r.a_id for r in got}) == len({r.b_id for r in got}) == len(got)
    free = [(a, b) for a, b, _ in block + ladder if a not in {r.a_id for r in got} and b not in {r.b_id for r in got}]
    assert free == []


def test_pair_scores_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    side = lambda p: [(f"{p}{i}", rng.choice("ABC"), rng.choice(["Purchase", "Sale"]), dt.date(1995, 1, 1) + dt.timedelta(rng.randrange(60)), float(rng.choice([100, 105, 120, 500]))) for i in range(60)]
    a, b = side("a"), side("b")
    kind = "id string, ticker string, action string, date date, amount double"
    got = {(r.a_id, r.b_id): r.score for r in resolve.vendor_pair_scores(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind)).collect()}
    score = lambda x, y: round(0.5 * (x[1] == y[1]) + 0.2 * (x[2] == y[2]) + 0.2 * (abs((x[3] - y[3]).days) <= 7) + 0.1 * (abs(x[4] - y[4]) <= 0.1 * max(x[4], y[4])), 4)
    assert got == {(x[0], y[0]): score(x, y) for x in a for y in b if score(x, y) >= 0.5}
