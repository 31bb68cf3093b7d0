"""Best-fit packing of token sequences with lower bounds that certify each partition's bin count."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import cut, slices
from tradelens.llm.tokens import crc32_of, encoder, tokenizer_path

CAPACITY = 4096
#: Pieces dealt to one partition, about.
DEAL = 32_768
#: Exchanges without gain before a gap is left, and how many times ``DEAL`` a partition may hold after them.
TRIES, MERGED = 4, 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_pieces(path: str, capacity: int):
    def run(batches):
        import pyarrow as pa

        own = encoder(path)
        for batch in slices(batches, 500):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode(batch.column("text").to_pylist()), strict=True):
                rows += [(doc_id, k, s, min(capacity, len(ids) - s), crc32_of(ids[s : s + capacity])) for k, s in enumerate(range(0, len(ids), capacity))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Each document's token ids with the end id, cut into pieces of at most ``capacity``: doc_id, piece, start, length, ids_crc32.

    A null or empty text has just the end id. Null ids and repeated rows are kept as they are.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_cut_pieces(path or tokenizer_path(), capacity), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing of the lengths needs, by dual feasible functions; ``counts``: how often each length occurs.

    With lengths as shares x of the capacity: the identity; the step function that counts x over 1 - t as
    1 and under t as 0, for t up to 1/2; and the rounding functions floor((k+1)x)/k.
    """
    if not len(lengths):
        return 0
    lengths, at = np.unique(np.asarray(lengths, np.int64), return_inverse=True)
    counts = np.bincount(at, weights=counts).astype(np.int64)
    held = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = -(-int(total[-1]) // capacity)
    for t in [*lengths[lengths <= capacity // 2], capacity // 2]:
        large, least = np.searchsorted(lengths, capacity - t, "right"), np.searchsorted(lengths, t, "left")
        best = max(best, int(held[-1] - held[large]) + -(-int(total[large] - total[least]) // capacity))
    for k in range(2, 21):
        scaled = (k + 1) * lengths
        # whole multiples keep their share, others round down to a step of 1/k; both counted in units of 1/(k * capacity)
        units = np.where(scaled % capacity == 0, lengths * k, scaled // capacity * capacity)
        best = max(best, -(-int((units * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; each goes to the open bin it leaves the least room in."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[int] = []  # sorted free space of the open bins
    holders: dict[int, list[int]] = {}
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            own = holders[room].pop()
            if not holders[room]:
                rooms.pop(at)
        else:
            room, own, opened = capacity, opened, opened + 1
        bins[i], offsets[i] = own, capacity - room
        left = room - n
        if left:
            if left not in holders or not holders[left]:
                rooms.insert(bisect_left(rooms, left), left)
                holders[left] = []
            holders[left].append(own)
    return bins, offsets


def _pack_part(capacity: int):
    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32", "uid"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        pdf["bin"], pdf["offset"] = best_fit_decreasing(lengths, capacity)
        pdf["bins"], pdf["bound"] = int(pdf["bin"].max()) + 1, lower_bound(lengths, capacity)
        return pdf

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (columns ``PIECES``) of at most ``capacity`` into as few sequences as it can.

    Adds sequence_id and offset, and the round, bins and certified lower bound of the partition that placed
    the piece. Pieces are dealt by hash, equal rows by their place in the table, to partitions of about ``DEAL``; each
    runs best-fit decreasing and gets a lower bound from dual feasible functions. A partition that needs no more
    sequences than its bound is certified and settled. Partitions with a gap exchange documents: theirs are dealt anew among
    half as many partitions (of ``MERGED`` times ``DEAL`` at most) and packed again; a single one is joined by the certified partition that has the most
    room. A deal that lowers the number of sequences stays and those it certifies are settled; after ``TRIES`` deals in
    turn that do not, the packing before is kept, and bins - bound tells the gap that is left. Pieces of the full
    capacity are sequences of their own. Ties in length are broken by ids, so a result does not depend on task
    order. An empty table gives an empty result; null ids and repeated rows are packed like others.
    """
    names = [c.split()[0] for c in PIECES.split(", ")]
    one = F.lit(1).cast("long")
    full = pieces.where(F.col("length") >= capacity)
    whole = full.select(
        *names, F.lit(0).alias("round"), (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), one.alias("bins"), one.alias("bound")
    )
    rest = pieces.where(F.col("length") < capacity).withColumn("uid", F.monotonically_increasing_id())
    columns = PIECES + ", uid long, part long, bin long, offset long, bins long, bound long"

    def packed(pieces: DataFrame, parts: int, turn: int) -> DataFrame:
        part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "uid", F.lit(turn)), F.lit(parts))
        dealt = pieces.select(*names, "uid", part.alias("part"))
        return cut(dealt.groupBy("part").applyInPandas(_pack_part(capacity), columns), f"packed{turn}")

    def placed(packed: DataFrame, turn: int) -> DataFrame:
        own = (F.lit(turn) * F.lit(1 << 48) + F.col("part") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id")
        return packed.select(*names, F.lit(turn).alias("round"), own, "offset", "bins", "bound")

    def parts_of(packed: DataFrame) -> DataFrame:
        return packed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"), F.count("*").alias("pieces"), F.sum("length").alias("tokens"))

    count = rest.count()
    if not count:
        return whole
    deal, size, out = 1, DEAL, whole
    now, turn = packed(rest, -(-count // size), deal), deal
    while deal < turn + TRIES:
        parts = cut(parts_of(now), "parts")
        chosen = parts.where("bins > bound")
        gaps = chosen.count()
        if gaps == 1:
            chosen = chosen.union(parts.where("bins = bound").orderBy(F.desc(F.col("bins") * capacity - F.col("tokens")), "part").limit(1))
        total = chosen.agg(F.count("*").alias("parts"), F.sum("bins").alias("bins"), F.sum("pieces").alias("pieces")).first()
        if not gaps or total.parts == 1:
            break
        deal, size = deal + 1, min(2 * size, MERGED * DEAL)
        again = packed(now.join(chosen, "part", "left_semi"), max(-(-total.pieces // size), 1), deal)
        if parts_of(again).agg(F.sum("bins")).first()[0] < total.bins:
            out = out.unionByName(placed(now.join(chosen, "part", "left_anti"), turn))
            now, turn = again, deal
    return out.unionByName(placed(now, turn))


def packing_bound(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """Sequences that any packing of all the pieces needs; from the count of each length, of which there are ``capacity`` at most."""
    rows = pieces.groupBy("length").count().collect()
    return lower_bound(np.array([r.length for r in rows]), capacity, np.array([r["count"] for r in rows]))


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row about a whole packing: bins (its sequences) and bound (what any packing of its pieces needs)."""
    bound = packing_bound(packed, capacity)
    return packed.agg(F.count_distinct("sequence_id").alias("bins"), F.lit(bound).cast("long").alias("bound"))


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Token pieces of all documents, packed: ``PIECES`` and what ``pack`` adds."""
    return pack(cut(token_pieces(docs, capacity, path), "pieces"), capacity)
