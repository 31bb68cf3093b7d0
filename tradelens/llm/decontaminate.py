"""Benchmark items inside documents: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import WordHashes, mix, shingle_sequence, slices, text_bytes, words_of

HASHES = 64
#: Smallest size class of items in shingles; each further class doubles it.
LEAST_SPAN = 1
#: Shingles that are windowed at once, about: of several short texts, or of a part of a long one.
LAID_OUT = 1 << 15
#: Bits of the table that tells which keys no item has.
FILTER_BITS = 22
#: Items that are broadcast at once, and bytes of their texts (sets and minima take about 1 KB an item and twice the text); larger benchmarks are searched in several passes.
ITEMS_PER_PASS, BYTES_PER_PASS = 20_000, 16 << 20


def _hash_family() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    draw = lambda: rng.integers(0, 2**32, HASHES, dtype=np.uint32)
    return draw() | np.uint32(1), draw(), mix(rng.integers(1, 2**63, HASHES, dtype=np.uint64))


def _minima(tokens: np.ndarray, span: int, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over each block of ``span`` tokens."""
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    x = np.pad(x, (0, -len(x) % span), mode="edge")
    step = max(span, 2048 // span * span)
    out, buffer = [], np.empty((min(step, len(x)), HASHES), np.uint32)
    for i in range(0, len(x), step):
        part = x[i : i + step, None]
        values = np.multiply(part, mul, out=buffer[: len(part)])
        values += add
        values = values.reshape(-1, span, HASHES)
        while values.shape[1] > 1 and values.shape[1] % 2 == 0:
            values = np.minimum(values[:, ::2], values[:, 1::2])
        out.append(values.min(axis=1))
    return np.concatenate(out)


class ContainmentIndex:
    """Items by size class: their shingle sets, and the minimum of every hash function as a sorted key table."""

    def __init__(self, items: list[tuple[int, bytes | None]], threshold: float):
        hashes, (mul, add, salt) = WordHashes(), _hash_family()
        self.ids, self.sets, self.threshold = [], [], threshold
        classes: dict[int, list[int]] = {}
        known = set()
        for item_id, text in items:
            tokens = np.unique(shingle_sequence(words_of(text), hashes))
            if item_id is None or not len(tokens) or (item_id, tokens.tobytes()) in known:
                continue
            known.add((item_id, tokens.tobytes()))
            span = LEAST_SPAN
            while span < len(tokens):
                span *= 2
            classes.setdefault(span, []).append(len(self.ids))
            self.ids.append(item_id), self.sets.append(tokens)
        self.classes = {}
        for span, members in sorted(classes.items()):
            low = np.vstack([_minima(self.sets[k], len(self.sets[k]), mul, add) for k in members])
            keys = (low.astype(np.uint64) ^ salt).ravel()
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << FILTER_BITS, bool)
            present[keys & np.uint64((1 << FILTER_BITS) - 1)] = True
            self.classes[span] = (keys[order], np.repeat(members, HASHES)[order], present)

    def candidates(self, units: list[np.ndarray], mul: np.ndarray, add: np.ndarray, salt: np.ndarray) -> list[set[int]]:
        """For each sequence of shingles, the items that agree with some window of it in some minimum.

        A window has two blocks of the class's span and moves by one block, so that a passage as long as an
        item lies whole in one of them, whatever the length of the text. Sequences are laid out one after the
        other, each filled up to whole blocks of the largest span.
        """
        found: list[set[int]] = [set() for _ in units]
        widest, size, blocks = max(self.classes), LEAST_SPAN, None
        filled = [np.pad(u, (0, -len(u) % widest), mode="edge") for u in units]
        ends = np.cumsum([len(u) for u in filled])
        for span, (keys, members, present) in self.classes.items():
            if blocks is None:
                size = span
                blocks = _minima(np.concatenate(filled), span, mul, add)
            while size < span:
                blocks, size = np.minimum(blocks[0::2], blocks[1::2]), size * 2
            windows = np.concatenate([np.minimum(blocks[:-1], blocks[1:]), blocks[-1:]]).astype(np.uint64)
            windows ^= salt
            hits = np.flatnonzero(present[(windows & np.uint64((1 << FILTER_BITS) - 1)).ravel().view(np.int64)])
            values = windows.ravel()[hits]
            lo, hi = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
            true = hi > lo
            owners = np.searchsorted(ends, hits[true] // HASHES * span, "right")
            for unit, i, j in zip(owners.tolist(), lo[true].tolist(), hi[true].tolist(), strict=True):
                found[unit].update(members[i:j].tolist())
        return found

    def matches(self, texts: list[bytes | None], hashes: WordHashes, family) -> list[list[tuple[int, int, int]]]:
        """For each text (item_id, item's shingles, shared shingles) of each item it contains."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not self.ids:
            return out
        overlap = 2 * max(self.classes)
        segment = max(LAID_OUT, 2 * overlap)
        units, owners, held = [], [], 0
        sequences: dict[int, np.ndarray] = {}
        wanted: dict[int, set[int]] = {}

        def settle() -> None:
            """Candidates of the units laid out so far."""
            for owner, items in zip(owners, self.candidates(units, *family), strict=True):
                if items:
                    wanted.setdefault(owner, set()).update(items)

        def confirm() -> None:
            for owner, items in wanted.items():
                own = np.unique(sequences[owner])
                for k in sorted(items):
                    at = np.minimum(np.searchsorted(own, self.sets[k]), len(own) - 1)
                    shared = int(np.count_nonzero(own[at] == self.sets[k]))
                    if shared >= self.threshold * len(self.sets[k]) - 1e-9:
                        out[owner].append((self.ids[k], len(self.sets[k]), shared))

        for k, text in enumerate(texts):
            sequence = shingle_sequence(words_of(text), hashes)
            if not len(sequence):
                continue
            sequences[k] = sequence
            for i in range(0, len(sequence), segment):
                units.append(sequence[i : i + segment + overlap])
                owners.append(k)
                held += len(units[-1])
                if held >= LAID_OUT:
                    settle()
                    units, owners, held = [], [], 0
            if not units:
                confirm()
                sequences, wanted = {}, {}
        if units:
            settle()
        confirm()
        return out


def _search(index):
    def run(batches):
        import pyarrow as pa

        hashes, family, own = WordHashes(), _hash_family(), index.value
        for batch in slices(batches, 1000):
            found = own.matches(text_bytes(batch, "text"), hashes, family)
            rows = [(d, *m) for d, ms in zip(batch.column("doc_id").to_pylist(), found, strict=True) for m in ms]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_item", "n_shared"])

    return run


def _clean(index):
    """The rows whose text contains no item."""

    def run(batches):
        import pyarrow as pa

        hashes, family, own = WordHashes(), _hash_family(), index.value
        for batch in slices(batches, 1000):
            found = own.matches(text_bytes(batch, "text"), hashes, family)
            yield batch.filter(pa.array([not m for m in found], pa.bool_()))

    return run


def _indexes(items: DataFrame, threshold: float):
    """Broadcast indexes of all items, each of bounded size."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, -(-count // ITEMS_PER_PASS), -(-size // BYTES_PER_PASS))
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        yield spark.sparkContext.broadcast(ContainmentIndex([(r.item_id, r.text.encode()) for r in part.toLocalIterator()], threshold))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Benchmark items of which a document contains at least ``threshold`` of the distinct 5-word shingles.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. Returns a row per pair:
    doc_id, item_id, n_item (the item's shingles), n_shared, containment.

    Items are divided into classes by size. For each class, windows twice its span slide over a document,
    so containment in a long text becomes a similarity of at least 0.19 with one window, and 64 minima miss
    it with less than 2e-6. Each candidate is then counted exactly on the whole document. Documents are only
    mapped, never shuffled; the items travel to the tasks in passes of bounded size.

    Words are as in near-duplicates (A-Z in lower case, split at ASCII white space); a text of fewer than
    five words is one shingle and matches a text that is the same. Null or empty texts match nothing, items
    with a null id are left out, an item row that repeats counts once, an id with several texts has each of them as an item,
    and a document row that repeats has its matches again. Long texts are searched part by part, and what
    is held beside a text's words does not grow with it. Empty tables give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for index in _indexes(items, threshold):
        hits = docs.mapInArrow(_search(index), "doc_id long, item_id long, n_item long, n_shared long")
        found = hits if found is None else found.union(hits)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def without_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents that contain none of the items; all columns stay. Every row is decided by its own text, whatever its doc_id."""
    for index in _indexes(items, threshold):
        docs = docs.mapInArrow(_clean(index), docs.schema)
    return docs
