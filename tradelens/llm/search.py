"""Exact top-k search over binary codes by incremental multi-index hashing, as joins on segment values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import cut

SEGMENT_BITS = 16
#: Entries of an index that are broadcast at most (some 40 bytes each); a larger one and the probes are shuffled.
BROADCAST_ENTRIES = 500_000


def _coded(vectors: DataFrame, segments: int) -> DataFrame:
    """vec_id and the sign code as one integer per segment (s0, s1, ...): bit i of a code is set if component i is above 0."""

    def segment(k: int):
        bits = f"transform(slice(embedding, {k * SEGMENT_BITS + 1}, {SEGMENT_BITS}), (x, i) -> if(x > 0 and not isnan(x), shiftleft(1, i), 0))"
        return F.expr(f"aggregate({bits}, 0, (a, b) -> a | b)").alias(f"s{k}")

    return vectors.select("vec_id", *[segment(k) for k in range(segments)])


def _clean(df: DataFrame) -> DataFrame:
    df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    df = df.where("vec_id is not null and size(embedding) > 0").withColumn("embedding", F.transform("embedding", lambda x: F.coalesce(x, F.lit(0.0).cast("float"))))
    return df.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` vectors nearest to each query in Hamming distance of their sign codes.

    ``vectors`` and ``queries``: vec_id (integer), embedding (array of numbers). Returns query_id,
    neighbor_id, distance, rank (from 1); equal distances are ordered by neighbor_id, the query itself is no
    neighbour of its own. Exact:

    * Vectors with equal codes are one point; of its ids only the k + 1 smallest can be an answer. Queries with
      equal codes are searched once.
    * Points are indexed by (segment, value of the segment). A query probes all values that differ from its own in r bits
      of a segment, for r = 0, 1, 2, ...; probes meet the index in an equi-join, and met points are verified on the whole code.
    * After round r, a point not met yet differs in more than r bits of every segment, so a query whose (k+1)th verified
      distance is below segments * (r + 1) is complete. Only the others go on to the next round, and farther points
      than their (k+1)th so far are dropped as soon as they are met.

    Null ids, null or empty embeddings take no part; null components and NaN count as not above 0, and shorter
    embeddings as padded with zeros. Rows that repeat an id count once (their first code by content). A table with
    fewer than ``k`` others gives them all. Empty tables give an empty result.
    """
    vectors, queries = _clean(vectors), _clean(queries)
    bits = max(df.agg(F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()[0] for df in (vectors, queries))
    segments = -(-bits // SEGMENT_BITS)
    code = [f"s{s}" for s in range(segments)]
    of_query = [f"q{s}" for s in range(segments)]

    first_ids = W.partitionBy(*code).orderBy("vec_id")
    nearest = _coded(vectors, segments).withColumn("k", F.row_number().over(first_ids)).where(F.col("k") <= k + 1)
    points = cut(nearest.groupBy(*code).agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("point", F.col("ids")[0]), "points")
    entries = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(c).alias("value")) for s, c in enumerate(code)]))
    index = cut(points.select("point", F.size("ids").alias("held"), *code, entries.alias("entry")).select("entry.*", "point", "held", *code), "index")
    total = points.count()
    index = F.broadcast(index) if total * segments <= BROADCAST_ENTRIES else index.hint("shuffle_merge")

    asked = cut(_coded(queries, segments), "asked")
    renamed = [F.col(c).alias(q) for c, q in zip(code, of_query, strict=True)]
    pending = asked.groupBy(*code).agg(F.min("vec_id").alias("query")).select("query", *renamed, F.lit(bits + 1).alias("worst"))
    pending = cut(pending, "pending")
    best, answers = None, []
    by_distance = W.partitionBy("query").orderBy("distance", "point")
    distance = reduce(lambda a, b: a + b, [F.bit_count(F.col(c).bitwiseXOR(F.col(q))) for c, q in zip(code, of_query, strict=True)])
    for radius in range(SEGMENT_BITS + 1):
        masks = F.explode(F.expr(f"filter(sequence(0, {(1 << SEGMENT_BITS) - 1}), m -> bit_count(m) = {radius})"))
        probes = pending.select("query", *of_query, "worst", masks.alias("mask")).select(
            "query", *of_query, "worst", F.posexplode(F.array(*[F.col(q).bitwiseXOR(F.col("mask")) for q in of_query])).alias("segment", "value")
        )
        met = probes.join(index, ["segment", "value"]).withColumn("distance", distance).where("distance <= worst").select("query", "point", "held", "distance")
        known = met if best is None else met.union(best)
        ranked = known.distinct().withColumn("k", F.row_number().over(by_distance)).where(F.col("k") <= k + 1)
        ahead = F.sum("held").over(by_distance.rowsBetween(W.unboundedPreceding, -1))
        best = cut(ranked.withColumn("ahead", F.coalesce(ahead, F.lit(0))).where(F.col("ahead") <= k).select("query", "point", "held", "distance"), f"best{radius}")
        found = best.groupBy("query").agg(F.sum("held").alias("ids"), F.count("*").alias("codes"), F.max("distance").alias("farthest"))
        worst = F.when(F.col("ids") > k, F.col("farthest")).otherwise(bits + 1)
        complete = (worst < segments * (radius + 1)) | (F.coalesce("codes", F.lit(0)) == total) | F.lit(radius == SEGMENT_BITS)
        state = cut(pending.drop("worst").join(found, "query", "left").select("query", *of_query, F.coalesce(worst, F.lit(bits + 1)).alias("worst"), F.coalesce(complete, F.lit(False)).alias("complete")), f"state{radius}")
        answers.append(best.join(state.where("complete").select("query"), "query", "left_semi"))
        pending = state.where("not complete").drop("complete")
        if pending.isEmpty():
            break
        best = best.join(pending.select("query"), "query", "left_semi")

    found = reduce(DataFrame.union, answers).join(points.select("point", "ids"), "point").select("query", "distance", F.explode("ids").alias("neighbor_id"))
    own = asked.join(asked.groupBy(*code).agg(F.min("vec_id").alias("query")), code).select(F.col("vec_id").alias("query_id"), "query")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "neighbor_id")).cast("long")
    out = own.join(found, "query").where("query_id <> neighbor_id").withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("query_id", "neighbor_id", F.col("distance").cast("long").alias("distance"), "rank")
