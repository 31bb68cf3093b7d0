"""Helpers shared by the corpus operators: tables, shared storage and word shingles."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CACHE = 250_000
SHINGLE_WORDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of this process; a cluster has to name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tradelens-")
        spark.conf.set("spark.checkpoint.dir", path)
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    return path.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/tradelens-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, so a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: str):
    """Queries that run inside pass rows to Python in Arrow batches of about ``size`` bytes at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def crc_mod(doc_id, n: int):
    """crc32 of the id as text, modulo ``n`` (null ids: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


class WordHashes(dict):
    """64-bit hash of each word, kept for words that come again; emptied when it grows beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case."""
    return text.lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sequence(words: list[bytes], hashes: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words in text order; the whole sequence as one if there are fewer words, none without words."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    span = min(size, len(h))
    n = len(h) - span + 1
    out = h[:n].copy()
    for k in range(1, span):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return mix(out + np.uint64(span))


def text_bytes(batch, column: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes, without decoding."""
    import pyarrow as pa

    return batch.column(column).cast(pa.large_binary()).to_pylist()


def slices(batches: Iterable, rows: int = 2000):
    """Arrow batches cut to at most ``rows`` rows, so that what a worker holds beside them stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: dict[int, int]) -> tuple[dict[int, list[str]], dict[int, int]]:
    """Texts of at most ``rows[label]`` labelled documents of each label, and how many rows each label has.

    ``docs``: doc_id, text; ``labels``: doc_id, label. The sample is drawn from the label table by hash of the
    id, so only the documents that are drawn are joined, by a broadcast of that bounded sample, and no text is shuffled.
    Rows with a null id, label or text take no part.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).where("doc_id is not null and label is not null")
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    drawn = None
    for label, n in rows.items():
        own = labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        drawn = own if drawn is None else drawn.union(own)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    found = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text").collect()
    found.sort(key=lambda r: (r.doc_id, r.text))
    return {label: [r.text for r in found if r.label == label] for label in rows}, {label: counts.get(label, 0) for label in rows}
