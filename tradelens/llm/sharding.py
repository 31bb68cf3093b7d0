"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import cut

LIMIT_BYTES = 8 << 20
#: Bits of the key from the document's id; the bits below them tell apart rows that repeat an id.
ID_BITS, KEY_BITS = 32, 62
#: Bits by which the first size table is finer than the mean shard.
FINER_BITS = 3
#: Column of a row's place in the table.
ROW = "_row"


def _key(uid):
    """62 bits: 32 from the hash of the id, then 30 from the hash of the row's place in the table; both from the place for rows without an id."""
    by_id = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64(uid, F.lit(1)))).bitwiseAND(F.lit((1 << ID_BITS) - 1))
    by_row = F.xxhash64(uid).bitwiseAND(F.lit((1 << (KEY_BITS - ID_BITS)) - 1))
    return F.shiftleft(by_id, KEY_BITS - ID_BITS).bitwiseOR(by_row)


def _prefix(depth: int):
    return F.shiftright(F.col("key"), KEY_BITS - depth)


def extendible_shards(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """Assign every document to a shard of at most ``limit_bytes`` of UTF-8 text.

    Returns a row per input row: doc_id, n_bytes, shard (depth and hash prefix as text, e.g. ``3:101``),
    depth (prefix bits), shard_bytes, oversized (only where a single row is above the limit: it shares its shard with
    no other row). The directory starts at one bucket; only buckets above the limit take another bit, so light
    buckets keep short prefixes. Sizes are summed by a prefix a few bits longer than the mean shard needs;
    all shorter prefixes follow from that small table, and only buckets still too large go back to the rows.

    Null and empty texts weigh nothing. Rows with the same id share a shard until it must split, then the row's place in
    the table decides, which is written once and read by all rounds. Rows without an id are spread by their place. An
    empty table gives an empty result.
    """
    return _assigned(_keyed(docs.withColumn(ROW, F.monotonically_increasing_id())), limit_bytes).drop(ROW)


def _keyed(docs: DataFrame) -> DataFrame:
    """Id, size, place in the table and key of each row, written once so that all rounds read the same places."""
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_bytes"), ROW).withColumn("key", _key(F.col(ROW))), "keys")


def _assigned(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """Shards of keyed rows; see ``extendible_shards``."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    fine_depth = min(KEY_BITS, max(1, total // limit_bytes).bit_length() + FINER_BITS)
    sums = (F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    leaf = (F.col("bytes") <= limit_bytes) | (F.col("lo") == F.col("hi"))

    def sized(part: DataFrame, depth: int) -> DataFrame:
        return part.groupBy(_prefix(depth).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi"))

    fine = cut(sized(rows, fine_depth), "fine")
    spread = fine.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(fine_depth)))).withColumn("p", F.expr(f"shiftright(prefix, {fine_depth} - depth)"))
    levels = cut(spread.groupBy("depth", "p").agg(*sums).withColumn("leaf", leaf), "levels")
    above = levels.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("up"), F.col("leaf").alias("done"))
    leaves = levels.where("leaf").withColumn("up", F.expr("shiftright(p, 1)")).join(above, ["depth", "up"], "left").where("depth = 0 or not done").select("depth", "p", F.col("bytes").alias("shard_bytes"))
    known = spread.select("prefix", "depth", "p").join(leaves, ["depth", "p"])
    found = [rows.withColumn("prefix", _prefix(fine_depth)).join(known, "prefix").select("doc_id", "n_bytes", ROW, "depth", F.col("p").alias("prefix"), "shard_bytes")]

    over = levels.where((F.col("depth") == fine_depth) & ~F.col("leaf")).select(F.col("p").alias("prefix"))
    pending, depth = rows, fine_depth
    while depth < KEY_BITS and not over.isEmpty():
        pending = cut(pending.withColumn("prefix", _prefix(depth)).join(over, "prefix", "left_semi").drop("prefix"), f"pending{depth}")
        depth += 1
        level = cut(sized(pending, depth).withColumn("leaf", leaf | F.lit(depth == KEY_BITS)), f"level{depth}")
        done = level.where("leaf").select("prefix", F.col("bytes").alias("shard_bytes"))
        found.append(pending.withColumn("prefix", _prefix(depth)).join(done, "prefix").select("doc_id", "n_bytes", ROW, F.lit(depth).alias("depth"), "prefix", "shard_bytes"))
        over = level.where("not leaf").select("prefix")
    out = reduce(DataFrame.unionByName, found)
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return out.select(ROW, "doc_id", "n_bytes", F.concat_ws(":", F.col("depth").cast("string"), bits).alias("shard"), "depth", "shard_bytes", (F.col("shard_bytes") > limit_bytes).alias("oversized"))


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """Write every row of ``docs`` once below ``path``, in the folder of its shard (``shard=<depth>:<prefix>``); returns the assignment as ``extendible_shards`` does.

    Rows are known by their place in the table, so rows without an id and rows that repeat one are written like others. A column of
    the documents that is called shard itself is written as doc_shard.
    """
    docs = docs.withColumnRenamed("shard", "doc_shard") if "shard" in docs.columns else docs
    docs = cut(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    shards = cut(_assigned(_keyed(docs), limit_bytes), "assignment")
    docs.join(shards.select(ROW, "shard"), ROW).drop(ROW).repartition("shard").write.partitionBy("shard").parquet(path)
    return shards.drop(ROW)
