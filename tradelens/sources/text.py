"""Readers of extracted text: filings' page text, paper text, rosters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_quality_gate(text: Column) -> Column:
    """At least 50 characters, at most 30 % special ones, and a date or a dollar amount."""
    special = F.length(F.regexp_replace(text, r"[A-Za-z0-9\s]", ""))
    found = F.rlike(text, F.lit(r"\d{1,2}/\d{1,2}/\d{2,4}")) | F.rlike(text, F.lit(r"\$[\d,]+"))
    return (F.length(F.coalesce(text, F.lit(""))) >= 50) & (special / F.length(text) <= 0.3) & found
