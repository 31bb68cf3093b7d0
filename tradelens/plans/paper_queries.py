"""Queries for the readers of filings' text: trades written as report text and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.plans.catalog import query
from tradelens.plans.expressions import WITH
from tradelens.plans.trades import lookup, trades
from tradelens.sources import paper

LETTERS = {"P": "P", "S": "S", "M": "E"}
PREFIXES = {"spouse": "SP ", "joint": "JT ", "dependent": "DC "}
OWNER_SQL = "CASE WHEN owner_type IN ('spouse', 'joint', 'dependent') THEN owner_type ELSE 'self' END"
KIND_SQL = "CASE code WHEN 'P' THEN 'purchase' WHEN 'S' THEN 'sale' ELSE 'exchange' END"
NUMBERED_SQL = f"{WITH}, o AS (SELECT *, CAST(filing_id AS VARCHAR) AS doc, row_number() OVER (PARTITION BY filing_id ORDER BY record_id) AS n FROM trades WHERE source = 'congress')"


def congress(spark, sf_dir) -> DataFrame:
    own = W.partitionBy("filing_id").orderBy("record_id")
    return trades(spark, sf_dir).where("source = 'congress'").withColumn("n", F.row_number().over(own))


def documents(rows: DataFrame, text: Column, head: str = "", foot: str = "") -> DataFrame:
    """One text per filing, of its trades' lines in order."""
    lines = rows.groupBy(F.col("filing_id").cast("string").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("n", text.alias("t")))).alias("x"))
    return lines.select("doc", F.concat(F.lit(head), F.array_join(F.transform("x", lambda x: x["t"]), "\n"), F.lit(foot)).alias("text"))


def day(column: str, pattern: str = "MM/dd/yyyy") -> Column:
    return F.date_format(column, pattern)


@query(
    "s7_parse_house_page_text",
    f"""{NUMBERED_SQL} SELECT doc, CAST(n AS BIGINT) AS entry, {OWNER_SQL} AS owner, 'Some Company Common Stock' AS asset_name, ticker, 'ST' AS asset_type, {KIND_SQL} AS kind, execution_date AS trade_date,
    disclosure_date AS notification_date, CAST(15001 AS BIGINT) AS low, CAST(50000 AS BIGINT) AS high, CASE WHEN planned THEN 'plan note' END AS description FROM o""",
)
def s7(spark, sf_dir):
    prefix = F.coalesce(lookup(F.col("owner_type"), PREFIXES), F.lit(""))
    entry = F.concat(
        prefix, F.lit("Some Company Common Stock ("), "ticker", F.lit(") [ST] "), lookup(F.col("code"), LETTERS), F.lit(" "), day("execution_date"), F.lit(" "), day("disclosure_date"), F.lit(" $15,001 -\n$50,000\nF S: New"),
        F.when(F.col("planned"), "\nD: plan note").otherwise(""),
    )
    pages = documents(congress(spark, sf_dir), entry, "Filing ID #7\nName: Ann Lee\nID Owner Asset Transaction Date\nType Date Gains\n", "\nI CERTIFY that this is true").withColumn("page", F.lit(1))
    rows = paper.house_entry_fields(paper.parse_house_pages(pages))
    return rows.select("doc", "entry", "owner", "asset_name", "ticker", "asset_type", "kind", "trade_date", "notification_date", "low", "high", "description")


@query(
    "s9_parse_paper_text",
    f"""{NUMBERED_SQL}, b AS (SELECT *, CAST(shares AS BIGINT) % 10 AS k FROM o)
    SELECT doc, CAST(n AS INTEGER) AS line, {OWNER_SQL} AS owner, 'Some Company - ' || ticker AS asset_name, ticker, {KIND_SQL} AS kind, execution_date AS trade_date, disclosure_date AS notification_date,
    ([1001, 15001, 50001, 100001, 250001, 500001, 1000001, 5000001, 25000001, 50000001])[k + 1]::BIGINT AS low, ([15000, 50000, 100000, 250000, 500000, 1000000, 5000000, 25000000, 50000000, 100000000])[k + 1]::BIGINT AS high FROM b""",
)
def s9(spark, sf_dir):
    prefix = F.concat(F.trim(F.coalesce(lookup(F.col("owner_type"), PREFIXES), F.lit(""))), F.when(F.col("owner_type").isin(*PREFIXES), " | ").otherwise(""))
    letter = F.substr(F.lit("ABCDEFGHIJ"), (F.col("shares").cast("long") % 10 + 1).cast("int"), F.lit(1))
    line = F.concat(prefix, F.lit("Some Company - "), "ticker", F.lit(" "), lookup(F.col("code"), LETTERS), F.lit(" "), day("execution_date"), F.lit(" "), day("disclosure_date", "MM/dd/yy"), F.lit(" x "), letter)
    return paper.parse_paper_text(documents(congress(spark, sf_dir), line, "NAME: ANN LEE\n")).select("doc", "line", "owner", "asset_name", "ticker", "kind", "trade_date", "notification_date", "low", "high")


@query(
    "s10_parse_amendment_lines",
    f"""{NUMBERED_SQL} SELECT doc, CAST(2 * n - 1 AS INTEGER) AS line, CASE WHEN owner_type = 'spouse' THEN 'spouse' ELSE 'self' END AS owner, 'Some Company, Inc.' AS asset_name, {KIND_SQL} AS kind, execution_date AS trade_date,
    CAST(1001 AS BIGINT) AS low, CAST(15000 AS BIGINT) AS high FROM o WHERE code IN ('P', 'S')""",
)
def s10(spark, sf_dir):
    kind, owner = F.when(F.col("code") == "P", "Purchase").when(F.col("code") == "S", "Sale").otherwise("Gift"), F.when(F.col("owner_type") == "spouse", "Spouse").otherwise("Self")
    line = F.concat(F.lit("Some Company, Inc. $1,0001 - "), kind, F.lit(" "), day("execution_date"), F.lit(" "), owner, F.lit("\nCommon Stock | $15,000"))
    return paper.parse_amendment_lines(documents(congress(spark, sf_dir), line, "Dear Clerk\n"))


@query(
    "s13_parse_senate_paper_text",
    f"""{NUMBERED_SQL} SELECT doc, CAST(n AS BIGINT) AS entry, CASE WHEN owner_type IN ('spouse', 'joint') THEN owner_type WHEN owner_type = 'dependent' THEN 'dependent' ELSE 'self' END AS owner,
    'Some Company ' || CASE code WHEN 'P' THEN 'Purchase' WHEN 'S' THEN 'Sale' ELSE 'Exchange' END || CASE owner_type WHEN 'spouse' THEN ' Spouse' WHEN 'joint' THEN ' Joint' WHEN 'dependent' THEN ' Child' ELSE '' END AS asset_name,
    ticker, {KIND_SQL} AS kind, execution_date AS trade_date, CAST(15001 AS BIGINT) AS low, CAST(50000 AS BIGINT) AS high FROM o""",
)
def s13(spark, sf_dir):
    kind = F.when(F.col("code") == "P", "Purchase").when(F.col("code") == "S", "Sale").otherwise("Exchange")
    owner = F.coalesce(lookup(F.col("owner_type"), {"spouse": "Spouse", "joint": "Joint", "dependent": "Child"}), F.lit(""))
    line = F.concat(day("execution_date"), F.lit(" Some Company ("), "ticker", F.lit(")\n"), kind, F.lit(" "), owner, F.lit(" $15,001 - $50,000"))
    return paper.parse_senate_paper_text(documents(congress(spark, sf_dir), line, "Periodic report\n")).select("doc", "entry", "owner", "asset_name", "ticker", "kind", "trade_date", "low", "high")
