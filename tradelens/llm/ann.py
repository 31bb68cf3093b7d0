"""Approximate nearest neighbours by an inverted multi-index over two halves of the vectors."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import cut

#: Mean entries of a cell, by which the number of centroids grows; at most ``MOST_CENTROIDS`` a half.
CELL_ENTRIES, MOST_CENTROIDS = 64, 512
#: The centroids are fitted on this many vectors for each of them, within so many bytes in all.
SAMPLE_A_CENTROID, SAMPLE_BYTES = 64, 32 << 20
FIT_ROUNDS = 10
#: Queries whose exact neighbours set how far all searches go, and the share of those neighbours that has to be reached.
CALIBRATION, TARGET = 128, 0.97
#: Entries and queries that meet in one group of a task, at most about.
BLOCK, CHUNK = 256, 128
#: Rows of partial answers that a task holds before it thins them out.
HELD = 200_000


def valid(df: DataFrame) -> DataFrame:
    """One row per id, with its least vector: vec_id, v. Null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part."""
    kind = df.schema["embedding"].dataType.elementType.typeName()
    df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "float" else "array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = df.where(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    # both zeros are one value
    df = df.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(df.schema["v"].dataType.elementType)))
    return df.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64) if len(column) else np.empty((0, 0))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``y``, up to rounding."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def fit_centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centroids by Lloyd's rounds from distinct rows, so dense regions start with more of them."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    rows = np.unique(x[rng.permutation(len(x))[: 4 * k]], axis=0)
    centroids = rows[rng.permutation(len(rows))[:k]]
    for _ in range(FIT_ROUNDS):
        near = squared(x, centroids).argmin(1)
        sums, sizes = np.zeros_like(centroids), np.bincount(near, minlength=len(centroids))
        np.add.at(sums, near, x)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


class MultiIndex:
    """Centroids of both halves and how many entries each pair of them (a cell) has."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.held = np.zeros(len(first) * len(second), np.int64)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the centroids of the first and of the second half."""
        width = self.first.shape[1]
        return squared(x[:, :width], self.first), squared(x[:, width:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def walk(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells with entries by ascending sum of both distances, each with the entries of the cells before it."""
        left, right = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[left].tolist(), b[right].tolist()
        heap, before, width = [(a[0] + b[0], 0, 0)], 0, len(b)
        while heap:
            _, i, j = heapq.heappop(heap)
            cell = int(left[i]) * width + int(right[j])
            if held := int(self.held[cell]):
                yield cell, before
                before += held
            if j + 1 < width:
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))

    def entries_before(self, a: np.ndarray, b: np.ndarray, cells: set[int]) -> list[int]:
        """For each of ``cells``, the entries of the cells that a search visits before it."""
        out = []
        for cell, before in self.walk(a, b):
            if cell in cells:
                out.append((cell, before))
                if len(out) == len(cells):
                    break
        return out


def best_of(x: np.ndarray, points: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query (row of ``q``) the ``k`` nearest points and their distances, ties to the smaller point.

    The product form finds who can be among them, within its rounding error; distances come from the differences.
    """
    rough = squared(q, x)
    slack = 1e-9 * ((x * x).sum(1).max() + (q * q).sum(1))
    for row, own, more in zip(rough, q, slack, strict=True):
        if len(row) > k:
            near = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1] + more)
        else:
            near = np.arange(len(row))
        distance = np.sqrt(((x[near] - own) ** 2).sum(1))
        order = np.lexsort((points[near], distance))[:k]
        yield points[near][order], distance[order]


def _lists(pa, columns: list[np.ndarray], sizes: list[int]) -> list:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]


def _assign(index: MultiIndex):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                yield pa.record_batch([pa.array(index.cells(matrix(b.column("v"))).astype(np.int32)), b.column("point"), b.column("v")], names=["cell", "point", "v"])

    return run


def _probe(index: MultiIndex, reach: int):
    """Cells that each query visits: by summed distance until those before hold ``reach`` entries."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                cells, rows = [], []
                for row, (a, c) in enumerate(zip(*index.halves(matrix(part.column("v"))), strict=True)):
                    for cell, before in index.walk(a, c):
                        if before >= reach:
                            break
                        cells.append(cell)
                        rows.append(row)
                out = part.take(pa.array(rows, pa.int32()))
                yield pa.record_batch([pa.array(cells, pa.int32()), out.column("query"), out.column("v")], names=["cell", "query", "v"])

    return run


def _search(k: int):
    """Answers of the queries of a chunk among the entries of a block: query, points, scores."""

    def run(entries, queries):
        import pyarrow as pa

        if not entries.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "points": pa.array([], pa.list_(pa.int64())), "scores": pa.array([], pa.list_(pa.float64()))})
        found = list(best_of(matrix(entries.column("v")), entries.column("point").to_numpy(), matrix(queries.column("v")), k))
        points, scores = _lists(pa, [np.concatenate(c) for c in zip(*found, strict=True)], [len(p) for p, _ in found])
        return pa.table([queries.column("query"), points, scores], names=["query", "points", "scores"])

    return run


def _all_of(index: MultiIndex, ids: np.ndarray, q: np.ndarray, k: int):
    """Nearest entries of a few queries among all of a task, compared without the index: query, point, cell, score."""

    def run(batches):
        import pyarrow as pa

        held: list[np.ndarray] = []
        for b in batches:
            if b.num_rows:
                points, cells = b.column("point").to_numpy(), b.column("cell").to_numpy()
                at = dict(zip(points.tolist(), cells.tolist(), strict=True))
                for query, (near, score) in zip(ids, best_of(matrix(b.column("v")), points, q, k), strict=True):
                    held.append(np.rec.fromarrays([np.full(len(near), query), near, np.array([at[p] for p in near.tolist()]), score], names="query,point,cell,score"))
        if held:
            rows = thinned(np.concatenate(held), k)
            yield pa.record_batch([pa.array(rows[c]) for c in ("query", "point", "cell", "score")], names=["query", "point", "cell", "score"])

    return run


def thinned(rows: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` first rows of each query by score and point."""
    rows = rows[np.lexsort((rows["point"], rows["score"], rows["query"]))]
    starts = np.flatnonzero(np.concatenate([[True], rows["query"][1:] != rows["query"][:-1]]))
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    return rows[place < k]


def _merge(k: int):
    """The ``k`` best answers of each query in a task; handed on early where a task meets many queries."""

    def out(pa, rows):
        return pa.record_batch([pa.array(rows[c]) for c in ("query", "point", "score")], names=["query", "point", "score"])

    def run(batches: Iterable):
        import pyarrow as pa

        held: list[np.ndarray] = []
        for b in batches:
            points, scores = b.column("points"), b.column("scores")
            query = np.repeat(b.column("query").to_numpy(), points.value_lengths().to_numpy())
            held.append(np.rec.fromarrays([query, points.flatten().to_numpy(), scores.flatten().to_numpy()], names="query,point,score"))
            if sum(map(len, held)) > HELD:
                rows = thinned(np.concatenate(held), k)
                held = [rows]
                if len(rows) > HELD // 2:
                    yield out(pa, rows)
                    held = []
        if held:
            yield out(pa, thinned(np.concatenate(held), k))

    return run


def _fit(points: DataFrame, n: int, width: int) -> MultiIndex:
    """Centroids of both halves, from a bounded sample drawn by hash of the id."""
    k = max(1, min(MOST_CENTROIDS, round((n / CELL_ENTRIES) ** 0.5)))
    rows = max(k, min(k * SAMPLE_A_CENTROID, SAMPLE_BYTES // (8 * width)))
    # only about twice the sample is sorted
    drawn = points.withColumn("h", F.xxhash64("point")).where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * rows / n + 1e-4)))
    x = np.array([r.v for r in drawn.orderBy("h", "point").limit(rows).select("v").collect()], np.float64)
    half = -(-width // 2)
    return MultiIndex(fit_centroids(x[:, :half], k, 1), fit_centroids(x[:, half:], k, 2))


def _reach(index: MultiIndex, entries: DataFrame, asked: DataFrame, k: int, target: float) -> int:
    """Entries that a search has to pass so that ``target`` of the true neighbours of the calibration queries are met."""
    drawn = asked.orderBy(F.xxhash64("query"), "query").limit(CALIBRATION).collect()
    ids, q = np.array([r.query for r in drawn]), np.array([r.v for r in drawn], np.float64)
    first = W.partitionBy("query").orderBy("score", "point")
    true = entries.mapInArrow(_all_of(index, ids, q, k + 1), "query long, point long, cell long, score double")
    true = true.withColumn("k", F.row_number().over(first)).where(F.col("k") <= k + 1).where("point <> query").collect()
    cells: dict[int, list[int]] = {}
    for r in true:
        cells.setdefault(r.query, []).append(r.cell)
    passed: list[int] = []
    for query, a, b in zip(ids.tolist(), *index.halves(q), strict=True):
        own = cells.get(query, [])
        before = dict(index.entries_before(a, b, set(own)))
        passed += [before[c] for c in own]
    return 1 + (int(np.quantile(passed, target, method="higher")) if passed else 0)


def _of_width(points: DataFrame, asked: DataFrame, width: int, k: int, target: float) -> DataFrame | None:
    """(query, point, score) of the queries of one dimension."""
    points, asked = points.where(F.size("v") == width), asked.where(F.size("v") == width)
    n = points.count()
    if not n or asked.isEmpty():
        return None
    kind = points.schema["v"].dataType.simpleString()
    index = _fit(points, n, width)
    entries = cut(points.select("point", "v").mapInArrow(_assign(index), f"cell int, point long, v {kind}"), "cells")
    for cell, held in entries.groupBy("cell").count().collect():
        index.held[cell] = held
    reach = max(_reach(index, entries, asked, k, target), k + 1)

    probes = cut(asked.select("query", "v").mapInArrow(_probe(index, reach), f"cell int, query long, v {kind}"), "probes")
    blocks = entries.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    per_cell = probes.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).join(blocks, "cell")
    per_cell = F.broadcast(per_cell)  # at most MOST_CENTROIDS ** 2 rows of three numbers
    block, chunk = F.pmod(F.xxhash64("point"), "blocks").cast("int"), F.pmod(F.xxhash64("query"), "chunks").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = entries.join(per_cell, "cell").select("cell", block.alias("block"), every("chunks").alias("chunk"), "point", "v")
    right = probes.join(per_cell, "cell").select("cell", every("blocks").alias("block"), chunk.alias("chunk"), "query", "v")
    keys = ["cell", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k + 1), "query long, points array<long>, scores array<double>")
    merged = found.mapInArrow(_merge(k + 1), "query long, point long, score double")
    first = W.partitionBy("query").orderBy("score", "point")
    return merged.withColumn("k", F.row_number().over(first)).where(F.col("k") <= k + 1).drop("k")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, target: float = TARGET) -> DataFrame:
    """The ``k`` vectors nearest to each query in Euclidean distance, by an inverted multi-index.

    ``vectors`` and ``queries``: vec_id (integer), embedding (array of numbers). Returns query_id, rank (from 1),
    vec_id, score (the distance of the vectors as given, in double precision), nearest first, ties to the smaller vec_id; the
    query's own id is no answer.

    * The halves of the vectors are quantised separately, by centroids fitted on a bounded sample (``SAMPLE_A_CENTROID``
      vectors a centroid, ``MOST_CENTROIDS`` a half, ``SAMPLE_BYTES`` in all). Every vector is an entry of the cell of its two centroids.
    * A query takes the cells by the sum of its two distances from a heap until those before hold ``reach`` entries, and
      its candidates are ranked by their distances. ``reach`` is one for all: so many entries that ``target`` of
      the true neighbours of ``CALIBRATION`` queries, found by comparison with all vectors, lie in the cells visited. On
      vectors without any structure that is a large part of the table, on clustered ones a small part.
    * Entries of a cell meet its queries in groups of about ``BLOCK`` and ``CHUNK`` rows, so a hot cell is
      spread over tasks. Equal vectors are one entry; of its ids only the k + 1 smallest can be answers.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do null ids. A
    query's candidates are the vectors of its dimension. Rows that repeat an id count once (its least vector). With
    at most ``k`` candidates all are returned. Empty tables give an empty result; other columns are ignored.
    """
    asked = cut(valid(queries), "asked")
    first_ids = W.partitionBy("v").orderBy("vec_id")
    least = valid(vectors).withColumn("k", F.row_number().over(first_ids)).where(F.col("k") <= k + 1)
    points = cut(least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("v", "ids", F.col("ids")[0].alias("point")), "points")
    unique = cut(asked.groupBy("v").agg(F.min("vec_id").alias("query")), "unique")
    widths = [r[0] for r in unique.select(F.size("v")).distinct().collect()]
    found = [f for w in widths if (f := _of_width(points, unique, w, k, target)) is not None]
    if not found:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    answers = reduce(DataFrame.union, found).join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    own = asked.join(unique, "v").select(F.col("vec_id").alias("query_id"), "query")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    out = own.join(answers, "query").where("query_id <> vec_id").withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
