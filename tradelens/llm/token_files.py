"""Token ids in Arrow files of fixed-size-list batches, with zero-copy access to equal-length sequences and masks.

A shard has two files. ``sequences``: batches of rows (ids: fixed-size list of unsigned integers, mask:
fixed-size list of bytes 0 and 1), one row per sequence of ``length`` ids; documents follow one another, and only
the shard's last sequence is padded (mask 0). ``documents``: doc_id, start (ids of the shard before it)
and n_tokens. Ids take 16 bits when the vocabulary allows it, else 32.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import cut, scratch, slices
from tradelens.llm.tokens import crc32_of, encoder, tokenizer_path

LENGTH = 2048
#: Sequences of one record batch.
BATCH = 256
#: Rows per shard that are sampled to place the limits between shards.
SAMPLED = 60
SHARD = "shard int, n_documents long, n_tokens long"


def _paths(folder: str, shard: int) -> tuple[str, str]:
    return f"{folder}/sequences-{shard:06d}.arrow", f"{folder}/documents-{shard:06d}.arrow"


def _filesystem(folder: str):
    """The file system of a folder that all executors see, and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1) if folder.startswith("file:") else f"file://{folder}")


class ShardWriter:
    """Writes one shard; the files get their names only when they are whole, so a repeated task replaces them."""

    def __init__(self, folder: str, shard: int, dtype, length: int = LENGTH):
        import pyarrow as pa

        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.shard, self.final = shard, _paths(base, shard)
        self.open = [f"{p}.{np.random.default_rng().integers(1 << 62)}" for p in self.final]
        self.dtype, self.length = np.dtype(dtype), length
        item = pa.uint16() if self.dtype == np.uint16 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.uint8(), length))])
        self.index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.streams = [self.fs.open_output_stream(p) for p in self.open]
        self.writers = [pa.ipc.new_file(s, schema) for s, schema in zip(self.streams, (self.schema, self.index), strict=True)]
        self.buffer: list[np.ndarray] = []
        self.held = self.written = 0
        self.rows: list[tuple] = []
        self.documents = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.written + self.held, len(ids)))
        self.documents += 1
        self.buffer.append(ids)
        self.held += len(ids)
        if self.held >= BATCH * self.length:
            self._flush(False)
        if len(self.rows) >= 50_000:
            self._flush_index()

    def _flush(self, last: bool) -> None:
        import pyarrow as pa

        data = np.concatenate(self.buffer) if self.buffer else np.empty(0, self.dtype)
        full = len(data) // (BATCH * self.length) * BATCH * self.length
        used = len(data) if last else full
        rows = -(-used // self.length)
        for i in range(0, rows, BATCH):
            part = data[i * self.length : min(used, (i + BATCH) * self.length)]
            n = -(-len(part) // self.length)
            mask = np.zeros(n * self.length, np.uint8)
            mask[: len(part)] = 1
            padded = np.zeros(n * self.length, self.dtype)
            padded[: len(part)] = part
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
            self.writers[0].write_batch(pa.record_batch(columns, schema=self.schema))
        self.written += used
        self.buffer, self.held = ([], 0) if last else ([data[full:].copy()], len(data) - full)

    def _flush_index(self) -> None:
        import pyarrow as pa

        if self.rows:
            self.writers[1].write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)], schema=self.index))
        self.rows = []

    def close(self) -> tuple[int, int, int]:
        """Give the files their names; returns the shard, its documents and its tokens."""
        self._flush(True)
        self._flush_index()
        for writer, stream in zip(self.writers, self.streams, strict=True):
            writer.close()
            stream.close()
        for temporary, final in zip(self.open, self.final, strict=True):
            self.fs.move(temporary, final)
        return self.shard, self.documents, self.written


class ShardReader:
    """Random access to a shard's sequences and documents; local files are memory-mapped, and neither ids nor masks are copied."""

    def __init__(self, folder: str, shard: int):
        import pyarrow as pa

        filesystem, base = _filesystem(folder)
        local = getattr(filesystem, "type_name", "") == "local"
        paths = _paths(base, shard)
        self.files = [pa.ipc.open_file(pa.memory_map(p) if local else filesystem.open_input_file(p)) for p in paths]
        self.length = self.files[0].schema.field("ids").type.list_size
        self._batch: dict[int, tuple] = {}

    def _of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self._batch:
            batch = self.files[0].get_batch(k)
            self._batch = {k: tuple(batch.column(c).flatten().to_numpy().reshape(-1, self.length) for c in ("ids", "mask"))}
        return self._batch[k]

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence, both views of the file."""
        ids, mask = self._of(row // BATCH)
        return ids[row % BATCH], mask[row % BATCH].view(bool)

    def document(self, start: int, n: int) -> np.ndarray:
        """Ids of one document; it may span sequences and batches."""
        parts, stop, width = [], start + n, BATCH * self.length
        while start < stop:
            ids, _ = self._of(start // width)
            inside = start % width
            parts.append(ids.reshape(-1)[inside : inside + stop - start])
            start += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)

    def documents(self):
        """(doc_id, start, n_tokens) batches in writing order."""
        for k in range(self.files[1].num_record_batches):
            batch = self.files[1].get_batch(k)
            yield from zip(batch.column("doc_id").to_pylist(), batch.column("start").to_pylist(), batch.column("n_tokens").to_pylist(), strict=True)


def _limits(docs: DataFrame, shards: int) -> list[tuple]:
    """Limits between the shards, as (has an id, id, hash of the text, share): about as many bytes of text lie between any two.

    They come from a sample of about ``SAMPLED`` rows a shard, whose size does not depend on the table. The
    share is a random number that parts rows with the same id and text.
    """
    rows = docs.count()
    share = min(1.0, SAMPLED * shards / max(1, rows))
    size = (F.octet_length("text") + 16).alias("size")
    drawn = docs.select(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tie", F.rand(5).alias("share"), size)
    drawn = sorted(tuple(r) for r in (drawn.sample(share, 3) if share < 1 else drawn).collect())
    passed = np.cumsum([r[4] for r in drawn])
    at = np.searchsorted(passed, np.arange(1, shards) * (passed[-1] / shards)) if len(drawn) else []
    return sorted({drawn[k][:4] for k in at})


def _encode(path: str, limits: list[tuple]):
    """Ids of each text with its shard; equal rows are dealt to shards by their place in the task, which repeats with it."""

    def run(batches):
        import pyarrow as pa

        own, place = encoder(path), 0
        for batch in slices(batches, 500):
            ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            keys = [(i is not None, i or 0, t, (k * 0x9E3779B97F4A7C15) % (1 << 64) / (1 << 64)) for k, (i, t) in enumerate(zip(ids, ties, strict=True), place)]
            place += batch.num_rows
            shard = [bisect_right(limits, key) for key in keys]
            tokens = [x.tobytes() for x in own.encode(batch.column("text").to_pylist())]
            columns = [pa.array(shard, pa.int32()), batch.column("doc_id"), batch.column("tie"), pa.array(tokens, pa.binary())]
            yield pa.record_batch(columns, names=["shard", "doc_id", "tie", "ids"])

    return run


def _write(folder: str, dtype: str, length: int):
    def run(batches):
        import pyarrow as pa

        writer, rows = None, []
        for batch in slices(batches, 500):
            for shard, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids")), strict=True):
                if writer is None or writer.shard != shard:
                    if writer:
                        rows.append(writer.close())
                    writer = ShardWriter(folder, shard, dtype, length)
                writer.add(doc_id, np.frombuffer(ids, dtype))
        if writer:
            rows.append(writer.close())
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["shard", "n_documents", "n_tokens"])

    return run


def write_token_files(docs: DataFrame, folder: str, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Write all documents in ascending doc_id order below ``folder``; returns a row per shard: shard, n_documents, n_tokens.

    Documents are divided by ranges of (doc_id, hash of the text), whose limits come from a sample of the table so that
    shards hold about as much text; each range becomes a shard, written by a task of its own, and shards in
    order give the documents in order. Texts are encoded where they are read, and only ids are shuffled. Null
    ids come first; rows that repeat an id follow one another, by hash of the text, and may take several shards. A
    null or empty text has just the end id. A writer's memory holds one batch of sequences and one document.
    """
    path = path or tokenizer_path()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = docs.mapInArrow(_encode(path, _limits(docs, parts)), "shard int, doc_id long, tie long, ids binary")
    ordered = encoded.repartitionById(parts, "shard").sortWithinPartitions("shard", "doc_id", "tie")
    dtype = np.dtype(encoder(path).dtype).name
    return cut(ordered.mapInArrow(_write(folder, dtype, length), SHARD), "shards")


def _read(folder: str):
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader, rows = ShardReader(folder, shard), []
                for doc_id, start, n in reader.documents():
                    rows.append((doc_id, base + start, n, crc32_of(reader.document(start, n))))
                    if len(rows) >= 10_000:
                        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    return run


def read_token_files(shards: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``shards`` is what ``write_token_files`` returned. The running sum takes one row per shard.
    """
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    based = shards.withColumn("base", before).select("shard", "base").repartitionById(parts, "shard")
    return based.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Write to a new folder in the shared storage and read back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, length, path), folder)
