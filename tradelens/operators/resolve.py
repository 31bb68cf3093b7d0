"""Resolution of issuers, filers and sectors, and joins of filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.functions.text import entity_name_norm

#: Rows of a dimension table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if a bounded count shows that it is small; Spark chooses otherwise."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def resolve_entities(df: DataFrame, entities: DataFrame, version: str = "v2") -> DataFrame:
    """Ticker, then CIK, then unique alias, then several aliases (ambiguous), then the ticker itself, else unresolved.

    ``df``: record_id, source, ticker, cik, issuer_name. ``entities``: entity_key, instrument_key, ticker, cik,
    aliases (array). Adds event_id (hash), status, entity_key, confidence, evidence. The alias table is reduced
    to one row per name first, so no row of ``df`` multiplies.
    """
    by_ticker = entities.select(F.upper("ticker").alias("_t"), F.col("entity_key").alias("t_key")).dropDuplicates(["_t"])
    by_cik = entities.where("cik is not null").select(F.col("cik").alias("_c"), F.col("entity_key").alias("c_key")).dropDuplicates(["_c"])
    names = entities.select("entity_key", F.explode("aliases").alias("a")).select("entity_key", entity_name_norm(F.col("a")).alias("_n")).where("_n is not null")
    by_name = names.groupBy("_n").agg(F.array_sort(F.collect_set("entity_key")).alias("n_keys"))
    out = df.withColumns({"_t": F.upper(F.trim("ticker")), "_c": F.col("cik"), "_n": entity_name_norm(F.col("issuer_name"))})
    out = out.join(small(by_ticker), "_t", "left").join(small(by_cik), "_c", "left").join(small(by_name), "_n", "left")
    found = F.coalesce(F.size("n_keys"), F.lit(0))
    own = F.concat(F.lit("entity:"), F.lower("_t"))

    def hit(status: str, key: Column, confidence: float, by: str) -> Column:
        return F.struct(F.lit(status).alias("status"), key.alias("entity_key"), F.lit(confidence).alias("confidence"), F.lit(by).alias("evidence"))

    chosen = (
        F.when(F.col("t_key").isNotNull(), hit("RESOLVED", F.col("t_key"), 0.99, "ticker"))
        .when(F.col("c_key").isNotNull(), hit("RESOLVED", F.col("c_key"), 0.97, "cik"))
        .when(found == 1, hit("RESOLVED", F.element_at("n_keys", 1), 0.90, "alias"))
        .when(found > 1, hit("AMBIGUOUS", F.lit(None).cast("string"), 0.40, "aliases"))
        .when(F.coalesce("_t", F.lit("")) != "", hit("RESOLVED", own, 0.95, "passthrough"))
        .otherwise(hit("UNRESOLVED", F.lit(None).cast("string"), 0.0, "none"))
    )
    event = F.sha2(F.concat_ws("|", "source", "record_id", F.lit(version)), 256)
    return out.withColumn("_r", chosen).select(*df.columns, event.alias("event_id"), "_r.*", F.when(found > 1, F.array_join("n_keys", ",")).alias("candidates"))


def resolve_cik(tickers: DataFrame, ciks: DataFrame) -> DataFrame:
    """CIK of the first of four spellings that is known: as is, dots as dashes, dashes as dots, without both."""
    t = F.upper(F.trim("ticker"))
    spellings = F.array(t, F.replace(t, F.lit("."), F.lit("-")), F.replace(t, F.lit("-"), F.lit(".")), F.regexp_replace(t, "[.-]", ""))
    tried = tickers.select("ticker", F.posexplode(spellings).alias("pos", "_s"))
    met = tried.join(ciks.select(F.col("ticker").alias("_s"), "cik"), "_s")
    best = met.groupBy("ticker").agg(F.min_by("cik", "pos").alias("cik"))
    return tickers.join(best, "ticker", "left")


def resolve_filers(names: DataFrame, members: DataFrame) -> DataFrame:
    """Member of each filer name: exact normalized name (first in roster order), else a unique last name, else a unique one in the state.

    ``names``: name, norm, state (may be null); ``members``: member_id, norm, state, position.
    """
    first = members.groupBy("norm").agg(F.min_by("member_id", "position").alias("exact_id"))
    last = lambda c: F.element_at(F.split(c, " "), -1)
    by_last = members.groupBy(last(F.col("norm")).alias("_last")).agg(F.count("*").alias("n"), F.first("member_id").alias("last_id"))
    by_state = members.groupBy(last(F.col("norm")).alias("_last"), "state").agg(F.count("*").alias("m"), F.first("member_id").alias("state_id"))
    out = names.withColumn("_last", last(F.col("norm"))).join(first, "norm", "left").join(by_last, "_last", "left").join(by_state, ["_last", "state"], "left")
    found = F.coalesce("exact_id", F.when(F.col("n") == 1, F.col("last_id")), F.when(F.col("m") == 1, F.col("state_id")))
    return out.select(*names.columns, found.alias("member_id"))


def sector_lookup(df: DataFrame, sectors: DataFrame) -> DataFrame:
    """Adds sector and industry by ticker, Unknown by default."""
    own = sectors.select("ticker", F.col("sector").alias("_s"), F.col("industry").alias("_i"))
    out = df.join(small(own), "ticker", "left")
    return out.withColumns({"sector": F.coalesce("_s", F.lit("Unknown")), "industry": F.coalesce("_i", F.lit("Unknown"))}).drop("_s", "_i")


def exercise_and_sell(trades: DataFrame, days: int = 3, tolerance: float = 0.1) -> DataFrame:
    """Sells with an option exercise by the same owner within ``days`` and a share count within ``tolerance`` of it.

    Exercises are put into day buckets around their date, so the join is on owner and bucket and stays a hash join.
    """
    bucket = F.floor(F.datediff("execution_date", F.lit("1970-01-01").cast("date")) / days)
    sells = trades.where("code = 'S'").withColumn("_b", bucket)
    near = F.explode(F.sequence(bucket - 1, bucket + 1)).alias("_b")
    exercises = trades.where("code = 'M'").select(F.col("actor_id").alias("_a"), F.col("execution_date").alias("_d"), F.col("shares").alias("_n"), near)
    met = (sells.actor_id == exercises._a) & (sells._b == exercises._b) & (F.abs(F.datediff("execution_date", "_d")) <= days) & (F.abs(F.col("shares") - F.col("_n")) <= F.col("_n") * tolerance)
    return sells.join(exercises, met, "left_semi").drop("_b")


def supersede_amendments(filings: DataFrame) -> DataFrame:
    """Filings that no later amendment of the same (issuer, owner, period) replaces; ``filings``: filing_id, issuer, owner, period, filing_date, is_amendment."""
    w = W.partitionBy("issuer", "owner", "period")
    newest = F.max(F.when(F.col("is_amendment"), F.struct("filing_date", "filing_id"))).over(w)
    return filings.withColumn("_n", newest).where(F.col("_n").isNull() | (F.struct("filing_date", "filing_id") >= F.col("_n"))).drop("_n")


def crossref(legislators: DataFrame, insiders: DataFrame, top: int = 100) -> DataFrame:
    """Per ticker of both sides (ticker, code, value): net volumes and agreement; the legislator side is cut to the ``top`` largest volumes."""

    def side(df: DataFrame, name: str) -> DataFrame:
        buys, sells = F.sum(F.when(F.col("code") == "P", F.col("value")).otherwise(0)), F.sum(F.when(F.col("code") == "S", F.col("value")).otherwise(0))
        return df.groupBy("ticker").agg(buys.alias(f"{name}_buys"), sells.alias(f"{name}_sells"))

    leading = side(legislators, "l").orderBy(F.desc(F.col("l_buys") + F.col("l_sells")), "ticker").limit(top)
    net = lambda s: F.col(f"{s}_buys") - F.col(f"{s}_sells")
    kind = F.when((net("l") > 0) & (net("i") > 0), "BOTH_BULLISH").when((net("l") < 0) & (net("i") < 0), "BOTH_BEARISH").when(net("l") * net("i") < 0, "DIVERGENT").otherwise("MIXED")
    return leading.join(side(insiders, "i"), "ticker").select("ticker", net("l").alias("legislator_net"), net("i").alias("insider_net"), kind.alias("agreement"))


def vendor_pair_scores(ours: DataFrame, theirs: DataFrame, least: float = 0.5) -> DataFrame:
    """Scores of candidate pairs of trades (id, ticker, action, date, amount): ticker .5, action .2, a week .2, amount .1.

    Candidates share the ticker, or the action and a week bucket; a pair that scores enough always does.
    """
    week = F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / 7)
    a = ours.select(*[F.col(c).alias(f"a_{c}") for c in ("id", "ticker", "action", "date", "amount")], week.alias("_w"))
    b = theirs.select(*[F.col(c).alias(f"b_{c}") for c in ("id", "ticker", "action", "date", "amount")], week.alias("_v"))
    by_ticker = a.join(b, F.col("a_ticker") == F.col("b_ticker"))
    b_near = b.withColumn("_near", F.explode(F.sequence(F.col("_v") - 1, F.col("_v") + 1)))
    by_week = a.join(b_near, (F.col("a_action") == F.col("b_action")) & (F.col("_w") == F.col("_near")) & ~F.equal_null("a_ticker", "b_ticker")).drop("_near")
    close = F.abs(F.col("a_amount") - F.col("b_amount")) <= 0.1 * F.greatest("a_amount", "b_amount")
    point = lambda c, p: F.when(F.coalesce(c, F.lit(False)), p).otherwise(0.0)
    score = point(F.col("a_ticker") == F.col("b_ticker"), 0.5) + point(F.col("a_action") == F.col("b_action"), 0.2) + point(F.abs(F.datediff("a_date", "b_date")) <= 7, 0.2) + point(close, 0.1)
    return by_ticker.unionByName(by_week).select("a_id", "b_id", F.round(score, 4).alias("score")).where(F.col("score") >= least)


def match_vendor_trades(pairs: DataFrame) -> DataFrame:
    """One-to-one matches from pair scores (a_id, b_id, score): higher scores go first; no pair of two unmatched trades is left.

    A sequential matcher would go through our rows in order; where best partners are mutual both agree. In each
    round every trade keeps its pairs of best score. Both sides are ranked among the trades that meet one set of
    partners there, so equal ranks match a block of ties at once; of the other pairs those of least hash for both
    sides are taken, which a round always has. Rounds end when no pair is left.
    """
    from tradelens.sinks import staged

    taken, pairs = None, staged(pairs.select("a_id", "b_id", "score").distinct(), "pairs")
    while not pairs.isEmpty():
        top = lambda side: F.max("score").over(W.partitionBy(side))
        tied = pairs.withColumns({"x": top("a_id"), "y": top("b_id")}).where("score = x and score = y").select("a_id", "b_id", "score")
        # trades of one block have the same set of partners, known by its size and two sums of hashes
        sets = [F.count("*"), F.sum(F.xxhash64("other").cast("decimal(38,0)")), F.sum(F.xxhash64("other", F.lit(1)).cast("decimal(38,0)"))]
        of = lambda one, other: tied.withColumnRenamed(other, "other").groupBy(one).agg(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(sets)]).alias(f"{one}_set"))
        blocks = staged(tied.join(of("a_id", "b_id"), "a_id").join(of("b_id", "a_id"), "b_id"), "tied")
        own = W.partitionBy("a_id_set", "b_id_set")
        rank = lambda one: blocks.select(one, "a_id_set", "b_id_set").distinct().withColumn("i", F.row_number().over(own.orderBy(one)))
        equal = rank("a_id").join(rank("b_id"), ["a_id_set", "b_id_set", "i"])
        first = lambda side: F.row_number().over(W.partitionBy(side).orderBy(F.col("i").isNull(), F.xxhash64("a_id", "b_id"), "a_id", "b_id"))
        ordered = blocks.join(equal.select("a_id", "b_id", "i"), ["a_id", "b_id"], "left")
        new = staged(ordered.withColumns({"k": first("a_id"), "l": first("b_id")}).where("k = 1 and l = 1").select("a_id", "b_id", "score"), "matches")
        taken = new if taken is None else taken.union(new)
        pairs = staged(pairs.join(new.select("a_id"), "a_id", "left_anti").join(new.select("b_id"), "b_id", "left_anti"), "pairs")
    return taken if taken is not None else pairs


def reconcile_counts(ours: DataFrame, theirs: DataFrame, key: str, absolute: int = 5, relative: float = 0.2) -> DataFrame:
    """Counts per key on both sides, which side lacks it, and whether they differ by more than the tolerances."""
    a, b = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((ours, "ours"), (theirs, "theirs")))
    both = a.join(b, key, "full_outer").fillna(0, ["ours", "theirs"])
    gap = F.abs(F.col("ours") - F.col("theirs"))
    status = F.when(F.col("theirs") == 0, "only_ours").when(F.col("ours") == 0, "only_theirs").otherwise("both")
    return both.withColumn("status", status).withColumn("flagged", (gap > absolute) | (gap / F.greatest("ours", "theirs") > relative))


def compare_to_golden(actual: DataFrame, expected: DataFrame, key: str, tolerance: float = 1e-6) -> DataFrame:
    """Divergences of (key, label, score) tables: missing, extra, label or score."""
    a = actual.select(key, F.col("label").alias("al"), F.col("score").alias("as"), F.lit(1).alias("ai"))
    b = expected.select(key, F.col("label").alias("bl"), F.col("score").alias("bs"), F.lit(1).alias("bi"))
    kind = F.when(F.col("ai").isNull(), "missing").when(F.col("bi").isNull(), "extra").when(~F.equal_null("al", "bl"), "label").when(F.abs(F.col("as") - F.col("bs")) > tolerance, "score")
    return a.join(b, key, "full_outer").withColumn("kind", kind).where("kind is not null").select(key, "kind")
