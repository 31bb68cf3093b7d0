import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tradelens.functions.config import V2
from tradelens.operators import signals

# three trades of member 1 cancel, but 0.1 + 0.2 - 0.3 is not 0 in doubles, whatever the order
TRADES = [("r1", 1, 0.1, 1.0, True), ("r2", 1, 0.2, 1.0, True), ("r3", 1, -0.3, 1.0, True), ("r4", 2, 0.4, 1.0, True), ("r5", 3, -0.5, 1.0, True)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(TRADES, "record_id string, member_id long, final double, stale double, included boolean").coalesce(1)


def test_a_member_whose_trades_cancel_is_neutral_in_the_sweep(scored):
    rows = signals.cap_sweep(scored, [0.5, 0.9]).collect()
    assert [(r.buyers, r.sellers, r.neutral) for r in rows] == [(1, 1, 1)] * 2


def test_a_member_whose_trades_cancel_is_neutral_in_the_market(scored):
    row = signals.market_positioning(scored, scored, 1).first()
    assert (row.buyers, row.sellers, row.neutral, row.breadth) == (1, 1, 1, 0.0)


def test_a_member_whose_trades_cancel_is_no_buyer_of_a_sector(scored):
    seats = scored.select("member_id").distinct().withColumns({"sector": F.lit("Energy"), "exposure": F.lit(1.0)})
    row = signals.sector_positioning(scored, seats).first()
    assert (row.buyers, row.sellers, row.members) == (1, 1, 3)


def test_a_lone_insider_is_not_capped_by_a_sum_in_another_order(spark):
    def in_any_order(batches):
        # every run of the plan meets the trades in an order of its own, as a shuffle may
        import random

        import pyarrow as pa

        whole = pa.Table.from_batches(batches)
        yield from whole.take(random.SystemRandom().sample(range(len(whole)), len(whole))).to_batches()

    kind = "subject_key string, actor_id long, execution_date date, included boolean, direction_weight double, signal double"
    day = dt.date(1999, 12, 1)
    rows = [(f"s{k}", k, day, True, 1.0, x) for k in range(200) for x in (0.1, 0.2, 0.3)]
    scored = spark.createDataFrame(rows, kind).coalesce(1).mapInArrow(in_any_order, kind)
    found = signals.insider_company_signal(scored, F.lit(dt.date(2000, 1, 1)), replace(V2, windows=(90,))).collect()
    assert len(found) == 200 and {r.score for r in found} == {0.537}
