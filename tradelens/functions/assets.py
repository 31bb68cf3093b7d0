"""Asset categories of legislators' trades. The lists and patterns are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelens.functions.text import literal_map

BROAD = "SPY VOO IVV QQQ QQQM VTI ITOT VT ACWI DIA IWM IWV VEA IEFA VWO IEMG BND AGG TLT IEF SHY".split()
SECTOR = "XLF XLE XLK XLV XLI XLY XLP XLB XLU XLRE VGT VHT VFH VDE VIS VCR VDC VAW VPU VNQ SMH XBI IBB ARKK ARKG XOP OIH GDX GDXJ KRE KBE IAT IYR".split()
SINGLE = "TSLL TSLQ NVDL NVDS AAPD AAPU MSFO MSFD AMZD AMZU GOOGL GOOLD METD METU".split()
CODES = {"ST": "common_stock", "OP": "option", "GS": "treasury", "MF": "mutual_fund", "EF": "sector_etf", "BD": "corporate_bond", "CS": "crypto", "AB": "private_placement"}
PREFERRED = r"depositary shares?|series [abc]|preferred|pfd|\d+\.\d+%\s+series"
TREASURY = r"treasury|t-?bill|t-?bond|t-?note|us\s+gov|u\.s\.\s+gov|united\s+states.*(?:bond|note|bill)"
MUNICIPAL = (
    r"\bgo\b.*(?:call|bond|bds)|\bgo(?=rate/coupon|\b)|municipal|general\s+obligation|\bst\b.*(?:sales|tax|rev)|city\s+(?:&|and)|county\s+(?:&|and)|authority.*\brev\b|airport.*\brev\b"
    r"|water(?:\s*&\s*|\s+and\s+)?wastew(?:ater|tr)\s+\brev\b|school\s+dist(?:rict)?|rev(?:enue)?\s+(?:bond|jr)|revenue\s+refunding|\brev(?=rate/coupon|\b)|utx\s+due|\bn\s*y\b.*\bgo\b"
    r"|\bgo\s+bds\b|\bsch\s+dist\b|\barpt\b|\bwtr\b|\bwastewtr\b|\bcnty\b|\btpk\b|\bohio\b.*\bgo\b|\bpa\b.*\brev\b"
)
PRIVATE = r",\s*llc\b|,\s*lp\b|promissory\s+note|private\s+equity|venture\s+fund|capital\s+fund|partners?\s+llc|allocate\s+\d{4}\s+lp"
FUND = r"\bfund\b(?!.*etf)|portfolio|retirement|401k|ira\s+|target\s+date|money\s+market|admiral\s+shares|\binstl\b|\binst!\b|harding\s+loevner|dimensional|\bdfa\b|core\s+equity"
ETF = r"\betf\b|spdr|invesco\s+qqq|dow\s+jones|trust\s+nysearca|total\s+stock\s+market"
BOND = r"structured\s+note|linked\s+note|floating\s+rate\s+note|fixed(?:\s+|-)?to(?:\s+|-)?floating|senior\s+notes?|subordinated\s+notes?|hybrid\s+perpetual|rate/coupon|matures:\d|\b\d{6}[a-z0-9]{2}\b"
CRYPTO = r"bitcoin|ethereum|crypto|blockchain|digital\s+asset"
WEIGHTS = {"common_stock": 1.0, "single_stock_etf": 1.0, "sector_etf": 0.8, "option": 0.7, "preferred_stock": 0.6, "unknown": 0.3}
EXCLUDED = ("broad_index_etf", "mutual_fund", "treasury", "municipal_bond", "corporate_bond", "private_placement", "crypto")


def asset_category(name: Column, ticker: Column, type_code: Column, archive: bool = False) -> Column:
    """Category by preferred names, type code, name patterns and ticker lists, in that order; ``archive`` has no fund-name and bond patterns."""
    s, t = F.lower(F.coalesce(name, F.lit(""))), F.upper(F.trim(ticker))
    by_code = F.element_at(literal_map(CODES), type_code)
    has = lambda p: F.rlike(s, F.lit(p))
    known = lambda names: F.coalesce(t.isin(names), F.lit(False))
    refined = F.when(known(BROAD), "broad_index_etf").when(known(SINGLE), "single_stock_etf").otherwise("sector_etf")
    chain = F.when(has(PREFERRED), "preferred_stock").when(by_code == "sector_etf", refined).when(by_code.isNotNull(), by_code)
    chain = chain.when(has(TREASURY), "treasury").when(has(MUNICIPAL), "municipal_bond").when(has(PRIVATE), "private_placement")
    if not archive:
        broad = (F.coalesce(t, F.lit("")) == "DIA") | has("dow jones|qqq|total stock market")
        chain = chain.when(has(ETF), F.when(has("admiral shares"), "mutual_fund").when(broad, "broad_index_etf").when(known(SECTOR), "sector_etf").otherwise("broad_index_etf"))
    chain = chain.when(has(FUND), "mutual_fund")
    if not archive:
        chain = chain.when(has(BOND), "corporate_bond")
    chain = chain.when(has(CRYPTO), "crypto").when(known(BROAD), "broad_index_etf").when(known(SECTOR), "sector_etf").when(known(SINGLE), "single_stock_etf")
    return chain.when(F.coalesce(t, F.lit("")) != "", F.when(has("depositary|preferred"), "preferred_stock").otherwise("common_stock")).otherwise("unknown")


def asset_policy(category: Column, ticker: Column, type_code: Column) -> Column:
    """struct(include, reason, confidence, weight, method) of an asset category."""
    t = F.upper(F.trim(ticker))
    has_ticker = F.coalesce(t, F.lit("")) != ""
    reason = F.when(category.isin(*EXCLUDED), F.concat(F.lit("asset_excluded:"), category)).when((category == "unknown") & ~has_ticker, "asset_excluded:unresolved")
    listed = F.when(F.coalesce(t.isin(BROAD + SECTOR + SINGLE), F.lit(False)), 0.2).otherwise(0.0)
    stock = F.when((category == "common_stock") & F.rlike(t, F.lit("^[A-Z]{1,5}$")), 0.1).otherwise(0.0)
    confidence = F.when(~has_ticker, 0.0).otherwise(F.least(F.lit(1.0), F.lit(0.5) + F.when(F.coalesce(type_code, F.lit("")) != "", 0.2).otherwise(0.0) + listed + stock))
    include = reason.isNull()
    weight = F.when(~include, 0.0).otherwise(F.coalesce(F.element_at(literal_map(WEIGHTS), category), F.lit(0.5)))
    method = F.when(has_ticker, "extracted").when(~include, "excluded").otherwise("unresolved")
    return F.struct(include.alias("include"), reason.alias("reason"), F.round(confidence, 4).alias("confidence"), weight.alias("weight"), method.alias("method"))
