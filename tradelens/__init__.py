"""Analytics over public trade filings, as composable Spark DataFrame operators."""
