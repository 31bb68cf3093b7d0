"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tradelens import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype(str)
        df[c] = df[c].map(lambda v: "" if v is None or v is pd.NaT or v is pd.NA or v != v else f"{v:.6g}" if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = plain(registry.QUERIES[name](spark, FOLDER).toPandas()), plain(duck.sql(registry.ORACLES[name]).df())
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_other_queries_run(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).count() >= 0


@pytest.mark.parametrize("name, parser", [("s5_read_house_index_xml", "parse_house_index"), ("s14_read_company_tickers", "parse_company_tickers"), ("s17_read_committee_yaml", "parse_committee_roster")])
def test_generated_files_stay_bounded(spark, tmp_path, monkeypatch, name, parser):
    from tradelens.plans import source_queries

    table = "customer" if name[1:3] in ("14", "17") else "orders"
    key, other = ("c_custkey", "c_nationkey") if table == "customer" else ("o_orderkey", "o_custkey")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(1).drop(key, other).crossJoin(spark.range(40_000).selectExpr(f"id as {key}", f"cast(0 as int) as {other}"))
    rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    parse, longest = getattr(source_queries.forms, parser), []

    def spy(files):
        longest.append(files.selectExpr("max(length(content))").first()[0])
        return parse(files)

    monkeypatch.setattr(source_queries.forms, parser, spy)
    registry.QUERIES[name](spark, str(tmp_path))
    assert longest[0] < 250_000


def test_vendor_report_and_diagnostics_cover_all_trades(spark, duck):
    from tradelens.plans.trades import trades

    congress = trades(spark, FOLDER).where("source = 'congress'")
    assert registry.QUERIES["a28_vendor_match_report"](spark, FOLDER).first().ours == congress.count()
    assert registry.QUERIES["j19b_member_diagnostics_all"](spark, FOLDER).count() == congress.select("actor_id").distinct().count()
