"""One-to-one matching of two sides' trades without a table of pairs."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.operators.resolve import small
from tradelens.sinks import staged

#: What a pair has in common, best score first: equal columns, the axis that is swept with its reach, and whether amounts must be close too.
STEPS = [
    (1.0, ["ticker", "action"], "day", True),
    (0.9, ["ticker", "action"], "day", False),
    (0.8, ["ticker", "action"], "size", True),
    (0.8, ["ticker"], "day", True),
    (0.7, ["ticker", "action"], None, False),
    (0.7, ["ticker"], "day", False),
    (0.6, ["ticker"], "size", True),
    (0.5, ["ticker"], None, False),
    (0.5, ["action"], "day", True),
]
#: Reach and block width of each axis; a block is wider than two reaches. Close amounts are less than one apart on ``size``, but for rounding.
AXES = {"day": (7.0, 16), "size": (1.001, 4)}
#: Parts of a group that are numbered on their own.
PARTS = 1024
COLUMNS = "ours boolean, id string, ticker string, action string, day double, size double, amount double, mate string"


def _close(x: float, y: float) -> bool:
    return abs(x - y) <= 0.1 * max(x, y)


class _Waiting:
    """Trades of one side that wait for a mate, in order of the axis; with ``amounts`` also in order of amount."""

    def __init__(self, amounts: bool):
        self.queue, self.sorted = deque(), [] if amounts else None

    def add(self, at: float, n: int, row: list) -> None:
        self.queue.append((at, n, row))
        if self.sorted is not None:
            insort(self.sorted, (row[6], n, row))

    def _drop(self, amount: float, n: int) -> None:
        del self.sorted[bisect_left(self.sorted, (amount, n))]

    def expire(self, before: float, out: list) -> None:
        while self.queue and (self.queue[0][0] < before or self.queue[0][2][7] is not None):
            _, n, row = self.queue.popleft()
            if row[7] is None:
                out.append(row)
                if self.sorted is not None:
                    self._drop(row[6], n)

    def take(self, amount: float | None) -> list | None:
        """The waiting trade of nearest amount, if that is close; the first one, where amounts do not matter."""
        if self.sorted is None:
            while self.queue:
                row = self.queue.popleft()[2]
                if row[7] is None:
                    return row
            return None
        k = bisect_left(self.sorted, (amount,))
        near = [e for e in self.sorted[max(k - 1, 0) : k + 1] if _close(e[0], amount)]
        if not near:
            return None
        found = min(near, key=lambda e: (abs(e[0] - amount), e[1]))
        self._drop(found[0], found[1])
        return found[2]


def _sweep(axis: str | None, amounts: bool):
    """Matches the trades of each block in one pass in order of the axis: a trade takes a waiting one of the other side within reach, or waits itself.

    When the later trade of a pair comes, the earlier one is waiting or has a mate, so no pair of two free trades is left in a block.
    """
    place = {"day": 4, "size": 5, None: None}[axis]
    reach = AXES[axis][0] if axis else math.inf
    pool = amounts and axis == "day"

    def flushed(out: list, schema: pa.Schema):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def run(batches):
        block, sides, n = None, None, 0
        schema = pa.schema([("ours", pa.bool_()), *[(c, pa.string()) for c in ("id", "ticker", "action")], *[(c, pa.float64()) for c in ("day", "size", "amount")], ("mate", pa.string())])
        out: list = []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                row, own = list(row[:8]), row[8:]
                if own != block:
                    for side in sides or ():
                        side.expire(math.inf, out)
                    block, sides = own, (_Waiting(pool), _Waiting(pool))
                n += 1
                at = row[place] if axis else 0.0
                mine, others = sides[row[0]], sides[not row[0]]
                others.expire(at - reach, out)
                mine.expire(at - reach, out)
                other = others.take(row[6])
                if other is not None and axis == "size" and not _close(other[6], row[6]):
                    # the first one is the farthest in reach: it goes on waiting for none that comes later
                    out.append(other)
                    while (other := others.take(None)) is not None and not _close(other[6], row[6]):
                        out.append(other)
                if other is None:
                    mine.add(at, n, row)
                else:
                    row[7], other[7] = other[1], row[1]
                    out += [row, other]
                if len(out) >= 20000:
                    yield flushed(out, schema)
                    out = []
        for side in sides or ():
            side.expire(math.inf, out)
        if out:
            yield flushed(out, schema)

    return run


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_block``, the place of a trade among those of its side and keys; parts of a group are numbered on their own and added up."""
    part, own = F.pmod(F.xxhash64("id"), F.lit(PARTS)), [*keys, "ours"]
    rows = rows.withColumn("_p", part)
    before = F.sum("count").over(W.partitionBy(*own).orderBy("_p").rowsBetween(W.unboundedPreceding, -1))
    starts = rows.groupBy(*own, "_p").count().withColumn("_s", F.coalesce(before, F.lit(0))).drop("count")
    place = F.row_number().over(W.partitionBy(*own, "_p").orderBy("id"))
    return rows.withColumn("_k", place).join(starts, [*own, "_p"]).withColumn("_block", F.col("_s") + F.col("_k")).drop("_p", "_s", "_k")


def _blocks(rows: DataFrame, keys: list[str], axis: str | None) -> list[tuple[Column, Column]]:
    """For each pass: which trades take part, and their block. Blocks of the second pass lie across the borders of the first."""
    if axis is None:
        return [(F.lit(True), F.col("_block"))]
    reach, width = AXES[axis]
    x = F.col(axis)
    border = F.round(x / width) * width
    return [(F.lit(True), F.floor(x / width)), (F.abs(x - border) <= reach, F.floor(x / width + 0.5))]


def _side(df: DataFrame, ours: bool) -> DataFrame:
    amount = F.col("amount").cast("double")
    amount = F.when(~F.isnan(amount) & (F.abs(amount) != float("inf")), amount)
    size = F.when(amount > 0, F.log(amount) / math.log(1 / 0.9)).when(amount == 0, F.lit(-1e6))
    day = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("double")
    row = df.where("id is not null").select(F.lit(ours).alias("ours"), F.col("id").cast("string").alias("id"), "ticker", "action", day.alias("day"), size.alias("size"), amount.alias("amount"))
    # rows of one id are one trade
    one = row.groupBy("ours", "id").agg(F.min(F.struct("ticker", "action", "day", "size", "amount")).alias("r"))
    return one.select("ours", "id", "r.*", F.lit(None).cast("string").alias("mate"))


def match_trades(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One-to-one matches (a_id, b_id, score) of trades (id, ticker, action, date, amount), scored as in ``vendor_pair_scores``; higher scores go first.

    Every pair that scores enough has one of the combinations of ``STEPS``. These are settled from the best down, each until it
    joins no two free trades, so no pair of trades is left of which both are free or have a lower score. Each pass shuffles
    the free trades by blocks of time or amount and sweeps these, so work grows with trades; trades of equal score are
    matched by nearest amount where amounts count, else in order. Amounts that are no finite number are close to none.
    """
    rows = staged(_side(ours, True).unionByName(_side(theirs, False)), "trades")
    found = []
    for score, keys, axis, amounts in STEPS:
        needed = [*keys, *([axis] if axis else []), *(["size"] if amounts else [])]
        complete = F.lit(True)
        for c in needed:
            complete = complete & F.col(c).isNotNull()
        met = staged(rows.where(complete).groupBy(*keys).agg(F.bool_or("ours").alias("o"), F.bool_and("ours").alias("p")).where("o and not p").select(*keys), "groups")
        if met.isEmpty():
            continue
        marked = rows.join(small(met.withColumn("_met", F.lit(True))), keys, "left").withColumn("_met", F.coalesce("_met", F.lit(False)) & complete).select(*rows.columns, "_met")
        taking = marked.where("_met").drop("_met")
        taking, resting = taking if axis else _numbered(taking, keys), marked.where("not _met").drop("_met")
        for within, block in _blocks(rows, keys, axis):
            order = [*keys, "_block", *([axis] if axis else []), "ours", "id"]
            part = taking.where(within).withColumn("_block", block.cast("long"))
            part = part.select(*rows.columns, *[F.col(k).alias(f"_{k}") for k in keys], "_block")
            part = part.repartition(*keys, "_block").sortWithinPartitions(*order)
            swept = staged(part.mapInArrow(_sweep(axis, amounts), COLUMNS), "swept")
            found.append(swept.where("ours and mate is not null").select(F.col("id").alias("a_id"), F.col("mate").alias("b_id"), F.lit(score).alias("score")))
            taking = taking.where(~within).select(*rows.columns).unionByName(swept.where("mate is null"))
        rows = staged(taking.unionByName(resting), "free")
    out = found[0] if found else rows.select(F.col("id").alias("a_id"), F.col("mate").alias("b_id"), F.lit(0.0).alias("score")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out
