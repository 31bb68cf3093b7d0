"""Numbered report lines, markdown text, signals of single trades and filings, caps after member sums."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tradelens import sinks
from tradelens.operators import signals, store


def test_lines_are_numbered_without_a_single_task(spark):
    rows = [(k * 7919 % 1000, "abc"[k % 3]) for k in range(1000)] + [(5, "z"), (5, "z"), (None, "n")]
    df = spark.createDataFrame(rows, "k int, s string")
    out = sinks.numbered(df, ["k", "s"])
    plan = out._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    got = [(r.k, r.s) for r in sorted(out.collect(), key=lambda r: r.position)]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) and sorted(r.position for r in out.collect()) == list(range(1, 1004))
    assert sinks.numbered(df.limit(0), ["k"]).count() == 0


def test_markdown_has_sections_in_order(spark, tmp_path):
    lines = spark.createDataFrame([("b", 2, "two\nlines"), ("b", 1, "one"), ("a", 1, "first"), ("other", 1, "not asked for")], "section string, position int, line string")
    folder = str(tmp_path / "report")
    sinks.write_markdown(lines, folder, {"b": "B part", "a": "A part", "c": "Nothing here"})
    text = "".join(open(f"{folder}/{f}").read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    assert text == "## B part\n- one\n- two lines\n## A part\n- first\n## Nothing here\n"


def test_filings_are_scored_at_their_own_dates(spark):
    day = dt.date(2020, 1, 1)
    schema = "filing_id long, record_id string, subject_key string, actor_id long, code string, role string, planned boolean, ownership string, shares double, shares_after double, execution_date date, included boolean"
    trade = lambda f, r, d, code="P", inc=True: (f, r, "entity:x", 1, code, "ceo", False, "D", 50.0, 100.0, day + dt.timedelta(days=d), inc)
    insiders = spark.createDataFrame([trade(1, "1", 0), trade(1, "2", -900), trade(1, "3", 5, "M", False), trade(2, "4", 0), trade(3, "5", 0, "M", False)], schema)
    legs = spark.createDataFrame([], "record_id string, subject_key string, action string, low long, high long, owner_type string, execution_date date, resolution_confidence double, included boolean, ticker string")
    got = {r.record_id: r for r in store.trade_level_signals(legs, insiders).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].input_count, got["1"].included_count, got["1"].as_of_date) == (3, 2, day - dt.timedelta(days=900)) and got["1"].score > 0
    # a trade two years older than the other counts in full, as each is scored at its own date
    both = insiders.where("filing_id = 1 and included").withColumn("execution_date", F.lit(day))
    assert store.trade_level_signals(legs, both).first().score == got["1"].score
    assert got["2"].label == "insufficient"


def test_sweep_equals_positioning_at_each_cap(spark):
    from dataclasses import replace

    from tradelens.functions.config import V2

    rows = [(f"r{k}", k % 7, float((-1) ** (k % 3) * (k * k % 97)), 1.0) for k in range(200)]
    scored = spark.createDataFrame(rows, "record_id string, member_id long, final double, stale double")
    caps = [0.05, 0.1, 0.3]
    sweep = {r.cap: r.asDict() for r in signals.cap_sweep(scored, caps).collect()}
    for cap in caps:
        (one,) = signals.positioning(scored.withColumn("g", F.lit(1)), ["g"], replace(V2, member_cap=cap)).drop("g").collect()
        assert all(abs(sweep[cap][c] - v) < 1e-9 if isinstance(v, float) else sweep[cap][c] == v for c, v in one.asDict().items())
