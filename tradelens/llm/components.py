"""Connected components of a link table, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has a link: (node, component).

    Each round takes the smallest label among a node's neighbours and then the label of that label, so
    long chains shorten by half and more; it ends when no label changes. Links with a null end are
    left out, repeated links and links to oneself are harmless, an empty table gives an empty result.
    Minimums are aggregated before they are shuffled, and hot nodes only meet equi-joins that Spark can split.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    edges = cut(both.union(both.select("v", "u")).distinct(), "edges")
    labels = cut(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")).withColumn("moved", F.lit(True)), "labels")
    for _ in range(max_rounds):
        heard = edges.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("near"))
        hooked = labels.join(heard, "u").select("u", F.col("l").alias("was"), F.least("l", "near").alias("now"))
        jump = labels.select(F.col("u").alias("now"), F.col("l").alias("far"))
        labels = cut(
            hooked.join(jump, "now", "left").select("u", F.least("now", "far").alias("l"), (F.least("now", "far") < F.col("was")).alias("moved")),
            "labels",
        )
        if labels.where("moved").isEmpty():
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
