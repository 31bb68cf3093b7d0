"""Training-corpus pipeline: quality, toxicity, near-duplicates, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept. All but the last
return the columns of ``documents``; the last returns the packed token pieces. Classifiers are trained on labelled
rows of the corpus (bounded samples, see their modules), whether or not a stage has dropped those rows.
Every stage decides row by row, so rows without an id and rows that repeat an id are documents like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm.common import arrow_batches, cut, table
from tradelens.llm.decontaminate import without_items
from tradelens.llm.near_dedup import without_near_duplicates
from tradelens.llm.packing import packed_sequences
from tradelens.llm.quality import fit_quality, quality_mask
from tradelens.llm.queries import labelled
from tradelens.llm.toxicity import fit_toxicity, toxicity_mask

#: A document is kept if its score for good quality is at least this, and its toxicity below this.
THRESHOLD = 0.3
#: Percent of shingles that near-duplicates share, and share of an item's shingles that contaminates.
SIMILARITY, CONTAINMENT = 80, 0.8
#: Bytes of an Arrow batch of texts, nodes or sets that an executor and its worker each hold in the near-duplicate stage.
NEAR_DEDUP_BATCH = "4m"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    model = fit_quality(*labelled(spark, sf_dir, "quality"))
    return quality_mask(docs, model, THRESHOLD)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the recurrent network does not reject."""
    net = fit_toxicity(*labelled(spark, sf_dir, "toxic"))
    return toxicity_mask(docs, net, THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, and of equal rows one."""
    with arrow_batches(spark, NEAR_DEDUP_BATCH):
        return without_near_duplicates(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"), CONTAINMENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of at most 4096 tokens."""
    return packed_sequences(docs).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence_id"), "offset")


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: Trained classifiers decide the first stages, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage{k}")
    return docs
