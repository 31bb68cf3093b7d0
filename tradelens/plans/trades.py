"""Trades, filings and prices as views of the driver tables, in Spark and as the same SQL text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.operators.resolve import BROADCAST_ROWS

REFERENCE_DATE = dt.date(2000, 1, 1)
TITLES = {"AUTOMOBILE": "Chief Executive Officer", "BUILDING": "Chief Financial Officer", "FURNITURE": "Chairman", "HOUSEHOLD": "President", "MACHINERY": "Senior Vice President"}
OWNERS = {"1-URGENT": "self", "2-HIGH": "spouse", "3-MEDIUM": "joint", "4-NOT SPECIFIED": "dependent", "5-LOW": "managed"}
CODES = {"A": "P", "R": "S", "N": "M"}
ACTIONS = {"P": "purchase", "S": "sale", "M": "exchange"}
SECTORS = ["Financials", "Industrials", "Health Care", "Energy", "Technology"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(column, mapping: dict):
    """Value of a small fixed mapping, null for other keys."""
    chain = None
    for key, value in mapping.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade per line item; filers are customers, issuers are groups of suppliers.

    Orders meet their customers first, so line items are shuffled once, by order, and what is grouped by filing later is in place.
    Few orders are broadcast instead, which Spark cannot tell from the estimated size of a join.
    """
    line, orders, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    day = F.col("l_shipdate").cast("date")
    ticker = F.concat(F.lit("T"), F.translate(F.lpad((F.col("l_suppkey") % 50).cast("string"), 2, "0"), "0123456789", "ABCDEFGHIJ"))
    code = lookup(F.col("l_returnflag"), CODES)
    filed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    filed = F.broadcast(filed) if orders.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else filed
    joined = line.join(filed, line.l_orderkey == filed.o_orderkey)
    return joined.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format(day, "yyyyMMdd")).alias("record_id"),
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("short_id"),
        F.col("l_orderkey").alias("filing_id"),
        F.when(F.col("l_orderkey") % 2 == 0, "insider").otherwise("congress").alias("source"),
        ticker.alias("ticker"),
        F.concat(F.lit("entity:"), F.lower(ticker)).alias("subject_key"),
        F.col("o_custkey").alias("actor_id"),
        F.col("c_name").alias("actor_name"),
        lookup(F.col("c_mktsegment"), TITLES).alias("title"),
        code.alias("code"),
        lookup(code, ACTIONS).alias("action"),
        F.when(code == "P", "BUY").when(code == "S", "SELL").otherwise("NEUTRAL").alias("direction"),
        F.col("l_quantity").alias("shares"),
        F.col("l_extendedprice").alias("value"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_quantity") * (F.lit(0.5) + F.col("l_tax") * 100)).alias("shares_after"),
        (F.col("l_discount") >= 0.09).alias("planned"),
        F.when(F.col("l_linestatus") == "F", "D").otherwise("I").alias("ownership"),
        lookup(F.col("o_orderpriority"), OWNERS).alias("owner_type"),
        F.when(F.col("o_orderstatus") == "F", "senate").otherwise("house").alias("chamber"),
        day.alias("execution_date"),
        F.date_add(day, (F.col("l_partkey") % 150).cast("int")).alias("disclosure_date"),
        F.element_at(F.array(*map(F.lit, SECTORS)), (F.col("l_suppkey") % 5 + 1).cast("int")).alias("sector"),
    )


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


_CODE = _case("l_returnflag", CODES)
TRADES_SQL = f"""
trades AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS record_id,
    concat_ws(':', l_orderkey, l_linenumber) AS short_id, l_orderkey AS filing_id,
    CASE WHEN l_orderkey % 2 = 0 THEN 'insider' ELSE 'congress' END AS source,
    'T' || translate(lpad(CAST(l_suppkey % 50 AS VARCHAR), 2, '0'), '0123456789', 'ABCDEFGHIJ') AS ticker,
    'entity:' || lower('T' || translate(lpad(CAST(l_suppkey % 50 AS VARCHAR), 2, '0'), '0123456789', 'ABCDEFGHIJ')) AS subject_key,
    o_custkey AS actor_id, c_name AS actor_name, {_case("c_mktsegment", TITLES)} AS title, {_CODE} AS code,
    {_case(_CODE, ACTIONS)} AS action, CASE {_CODE} WHEN 'P' THEN 'BUY' WHEN 'S' THEN 'SELL' ELSE 'NEUTRAL' END AS direction,
    l_quantity AS shares, l_extendedprice AS value, l_extendedprice / l_quantity AS price,
    l_quantity * (CAST(0.5 AS DOUBLE) + l_tax * 100) AS shares_after, l_discount >= CAST(0.09 AS DOUBLE) AS planned,
    CASE WHEN l_linestatus = 'F' THEN 'D' ELSE 'I' END AS ownership, {_case("o_orderpriority", OWNERS)} AS owner_type,
    CASE WHEN o_orderstatus = 'F' THEN 'senate' ELSE 'house' END AS chamber, CAST(l_shipdate AS DATE) AS execution_date,
    CAST(l_shipdate AS DATE) + CAST(l_partkey % 150 AS INTEGER) AS disclosure_date,
    ({SECTORS!r})[CAST(l_suppkey % 5 + 1 AS INTEGER)] AS sector
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price per ticker and day: ticker, date, close."""
    return trades(spark, sf_dir).groupBy("ticker", F.col("execution_date").alias("date")).agg(F.round(F.avg("price"), 6).alias("close"))


PRICES_SQL = "prices AS (SELECT ticker, execution_date AS date, round(avg(price), 6) AS close FROM trades GROUP BY ALL)"


def benchmark_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean close over tickers per day: date, close."""
    return prices(spark, sf_dir).groupBy("date").agg(F.round(F.avg("close"), 6).alias("close"))


BENCHMARK_SQL = "bench AS (SELECT date, round(avg(close), 6) AS close FROM prices GROUP BY ALL)"
