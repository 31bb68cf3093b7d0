"""Near-duplicate groups by a chosen-path set similarity join over minwise sketches."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import WordHashes, cut, shingle_sequence, slices, text_bytes, words_of
from tradelens.llm.components import connected_components

#: Minima of a sketch at least.
COORDINATES = 128
#: Most depths below a root branch; each takes a coordinate of its own per tree.
DEPTHS = 4
#: Trees that deeper branching may ask for; where a threshold needs more, oversized nodes count as masses earlier.
MOST_TREES = 32
#: Share of pairs at the threshold that no tree brings together on its deepest level, at most.
MISSED = 1e-5
#: Standard deviations, at least, that a sketch may fall below the threshold before its pair is not verified.
DEVIATIONS = 5
NODE_LIMIT = 64
PIVOTS = 4
#: Members of an oversized node that all its members are compared with to find the most central ones.
SAMPLE = 32
#: Members of a block that are compared with another block at once, about, and one-bit minima of their fine sketches.
BLOCK_MEMBERS, FINE_BITS = 1024, 1024
#: Members of a block that meets another with full sets.
SET_MEMBERS = 128
#: Rows of a hot key that one task gets, about.
SALTED_ROWS = 250
#: Rows of a small table that are broadcast at most (some ten bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_BLOCK = 2048


class Plan(NamedTuple):
    """Trees, depths below their roots, coordinates of a sketch, and the share of them that a pair must agree on."""

    trees: int
    depths: int
    coordinates: int
    least: float


def plan(percent: int) -> Plan:
    """Enough trees that a pair at the threshold misses all of them on the deepest level with ``MISSED`` at most.

    A pair survives a tree down to depth d with J^(d + 1), since every level takes one more coordinate. The
    filter on sketches loses no more of the pairs at the threshold than that either.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be above 0 and at most 100, not {percent}")
    j = percent / 100

    def needed(depths: int) -> int:
        stays = j ** (depths + 1)
        return 1 if stays == 1 else math.ceil(math.log(MISSED) / math.log1p(-stays))

    depths = max((d for d in range(DEPTHS + 1) if needed(d) <= MOST_TREES), default=0)
    trees = needed(depths)
    coordinates = max(COORDINATES, trees * (depths + 1))
    agreed, below = -1, 0.0
    while below <= MISSED and agreed < coordinates:
        agreed += 1
        below += math.comb(coordinates, agreed) * j**agreed * (1 - j) ** (coordinates - agreed)
    return Plan(trees, depths, coordinates, min(agreed / coordinates, j - DEVIATIONS * math.sqrt(j * (1 - j) / coordinates)))


def _permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 2**32, coordinates, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, coordinates, dtype=np.uint32)


def sketch(tokens: np.ndarray, trees: int, mul: np.ndarray, add: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minwise tokens of the first ``trees`` coordinates and 16 bits of each coordinate's minimum."""
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    chosen = np.zeros(trees, np.uint64)
    for i in range(0, len(x), _BLOCK):
        values = x[i : i + _BLOCK, None] * mul + add
        least = values.min(axis=0)
        better = np.flatnonzero(least[:trees] < low[:trees])
        if len(better):
            chosen[better] = tokens[i + values[:, better].argmin(axis=0)]
        low = np.minimum(low, least)
    return chosen, ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).view(np.int16)


def _signatures(trees: int, coordinates: int):
    def run(batches):
        import pyarrow as pa

        hashes, (mul, add) = WordHashes(), _permutations(coordinates)
        for batch in slices(batches, 300):
            n, s1, s2, roots, sketches = [], [], [], [], []
            for text in text_bytes(batch, "text"):
                tokens = np.unique(shingle_sequence(words_of(text), hashes))
                n.append(len(tokens))
                if not len(tokens):
                    s1.append(0), s2.append(0), roots.append(None), sketches.append(None)
                    continue
                one, two = _sums(tokens)
                s1.append(one), s2.append(two)
                chosen, bits = sketch(tokens, trees, mul, add)
                roots.append(chosen.view(np.int64)), sketches.append(bits)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(roots, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int16()))],
                names=["doc_id", "n_shingles", "s1", "s2", "roots", "sketch"],
            )

    return run


def _sums(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set of tokens along with its size."""
    s1 = int(tokens.sum(dtype=np.uint64).view(np.int64))
    return s1, int(np.bitwise_xor.reduce(tokens * np.uint64(0xD6E8FEB86659FD93) ^ (tokens >> np.uint64(31))).view(np.int64))


def _token_sets(batches):
    """Sets of the rows whose text is the one that the representative stands for; another text of the same id is not."""
    import pyarrow as pa

    hashes = WordHashes()
    for batch in slices(batches, 300):
        rids, sets = [], []
        for rid, s1, s2, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "s1", "s2")), text_bytes(batch, "text"), strict=True):
            tokens = np.unique(shingle_sequence(words_of(text), hashes))
            if _sums(tokens) == (s1, s2):
                rids.append(rid), sets.append(tokens.tobytes())
        yield pa.record_batch([pa.array(rids, pa.int64()), pa.array(sets, pa.binary())], names=["rid", "tokens"])


def _matrix(column) -> np.ndarray:
    """A list column whose lists have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best_in_nodes(least: float):
    """In small nodes, every member b gives the smaller member a that agrees with it best: (a, b, agreement), if that is at least ``least``."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 500):
            a, b, agreement = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
            members = batch.column("members")
            bounds, flat = members.offsets.to_numpy(), members.values
            rid, m = flat.field("rid").to_numpy(), _matrix(flat.field("sketch"))
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                order = s + np.argsort(rid[s:e])
                group, own = m[order], rid[order]
                agree = np.triu((group[:, None, :] == group[None, :, :]).mean(axis=2, dtype=np.float32), 1)
                agree[own[:, None] == own[None, :]] = 0
                i, j = agree.argmax(axis=0), np.arange(len(own))
                ok = agree[i, j] >= least
                a.append(own[i[ok]]), b.append(own[j[ok]]), agreement.append(agree[i[ok], j[ok]])
            yield pa.record_batch([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64()), pa.array(np.concatenate(agreement).astype(np.float64))], names=["a", "b", "agreement"])

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    merged = np.sort(np.concatenate([x, y]), kind="stable")
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _joining_links(i: np.ndarray, j: np.ndarray, rid: np.ndarray, part: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Exact links among candidates (i, j), in their order, that join parts which no link before has joined."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        p, q = find(int(part[x])), find(int(part[y]))
        if p != q and _similar(sets[x], sets[y], percent):
            parent[max(p, q)] = min(p, q)
            out.append((min(int(rid[x]), int(rid[y])), max(int(rid[x]), int(rid[y]))))
    return out


def _alive_in_nodes(least: float):
    """Members of each small node that have a candidate in another part, in order."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 500):
            out = []
            members = batch.column("members")
            bounds, flat = members.offsets.to_numpy(), members.values
            rid, part, m = flat.field("rid").to_numpy(), flat.field("part").to_numpy(), _matrix(flat.field("sketch"))
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                group = m[s:e]
                agree = (group[:, None, :] == group[None, :, :]).mean(axis=2, dtype=np.float32)
                agree[part[s:e, None] == part[None, s:e]] = 0
                alive = (agree >= least).any(axis=1)
                if alive.any():
                    out.append(np.sort(rid[s:e][alive]))
            yield pa.record_batch([pa.array(out, pa.list_(pa.int64()))], names=["rids"])

    return run


def _links_in_nodes(least: float, percent: int):
    """Small nodes with members of different parts: candidates between parts are compared on their full sets, the best first."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 20):
            found = []
            members = batch.column("members")
            bounds, flat = members.offsets.to_numpy(), members.values
            rid, part, m, raw = flat.field("rid").to_numpy(), flat.field("part").to_numpy(), _matrix(flat.field("sketch")), flat.field("tokens")
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                group = m[s:e]
                agree = np.triu((group[:, None, :] == group[None, :, :]).mean(axis=2, dtype=np.float32), 1)
                agree[part[s:e, None] == part[None, s:e]] = 0
                i, j = np.nonzero(agree >= least)
                order = np.argsort(-agree[i, j], kind="stable")
                sets = [np.frombuffer(t, np.uint64) for t in raw.slice(s, e - s).to_pylist()]
                found += _joining_links(i[order], j[order], rid[s:e], part[s:e], sets, percent)
            yield pa.record_batch([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return run


def _nearest_pivots(least: float):
    """For each member the pivot of its node that agrees with it best, if that is at least ``least``."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 1000):
            a, b, agreement = [], [], []
            mine, pivots, rids = _matrix(batch.column("sketch")), batch.column("pivots"), batch.column("rid").to_pylist()
            bounds, p, flat = pivots.offsets.to_numpy(), pivots.values.field("p").to_numpy(), _matrix(pivots.values.field("sketch"))
            for k, rid in enumerate(rids):
                agree = (flat[bounds[k] : bounds[k + 1]] == mine[k]).mean(axis=1)
                agree[p[bounds[k] : bounds[k + 1]] == rid] = 0
                best = int(agree.argmax())
                if agree[best] >= least:
                    other = int(p[bounds[k] + best])
                    a.append(min(rid, other)), b.append(max(rid, other)), agreement.append(float(agree[best]))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(agreement, pa.float64())], names=["a", "b", "agreement"])

    return run


def _verify(percent: int):
    """Rows come sorted by (a, salt, side): first the set of a, then those of its partners."""

    def run(batches):
        import pyarrow as pa

        own, hub = None, np.empty(0, np.uint64)
        for batch in slices(batches, 500):
            kept = []
            for a, b, tokens in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "tokens")), strict=True):
                other = np.frombuffer(tokens, np.uint64)
                if b is None:
                    own, hub = a, other
                    continue
                if a != own:
                    raise RuntimeError(f"no set of {a} before its partners")
                if _similar(hub, other, percent):
                    kept.append((a, b))
            yield pa.record_batch([pa.array([k[c] for k in kept], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return run


def _few(rows: DataFrame) -> DataFrame:
    """A small table, to be broadcast where its count allows it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows.hint("shuffle_merge")


def _sets_of(docs: DataFrame, first: DataFrame, rids: DataFrame) -> DataFrame:
    """Shingle sets (rid, tokens) of some representatives. Up to ``BROADCAST_IDS`` of them travel to the texts; beyond that the texts are shuffled."""
    wanted = cut(first.join(rids.distinct(), "rid").select("doc_id", "rid", "s1", "s2"), "ids")
    sets = docs.join(_few(wanted), "doc_id").select("rid", "s1", "s2", "text").mapInArrow(_token_sets, "rid long, tokens binary")
    return cut(sets.groupBy("rid").agg(F.first("tokens").alias("tokens")), "sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rid")).union(pairs.select("b"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of representatives that pass the exact test on their full shingle sets.

    The set of each a meets those of its partners in a sorted pass, so a task holds two sets at a time. An a
    with many partners is dealt to several tasks.
    """
    counts = cut(pairs.groupBy("a").agg(F.ceil(F.count("*") / SALTED_ROWS).alias("salts")), "hubs")
    hot = _few(counts.where("salts > 1"))
    salted = pairs.join(hot, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))))
    partners = salted.join(sets.select(F.col("rid").alias("b"), "tokens"), "b").select("a", "salt", F.lit(1).alias("side"), "b", "tokens")
    hubs = counts.join(sets.select(F.col("rid").alias("a"), "tokens"), "a")
    hubs = hubs.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("b"), "tokens")
    met = hubs.union(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", "side").select("a", "b", "tokens")
    return cut(met.mapInArrow(_verify(percent), "a long, b long"), "links")


def _links_across(nodes: DataFrame, parts: DataFrame, sketches: DataFrame, docs: DataFrame, first: DataFrame, least: float, percent: int) -> DataFrame:
    """Links between members of small nodes that are in different parts so far, at most one less than a node has members.

    Sketches tell which members have a candidate in another part at all; trees that agree on these members give one
    group of them, and only groups meet their full sets.
    """
    labelled = cut(nodes.join(parts.withColumnRenamed("node", "rid"), "rid", "left").select("node", "rid", F.coalesce("component", "rid").alias("part")), "labelled")
    several = labelled.groupBy("node").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("node")
    gathered = labelled.join(several, "node").join(sketches, "rid").groupBy("node").agg(F.collect_list(F.struct("rid", "part", "sketch")).alias("members")).select("members")
    groups = gathered.mapInArrow(_alive_in_nodes(least), "rids array<long>").distinct()
    members = cut(groups.select(F.xxhash64("rids").alias("group"), F.explode("rids").alias("rid")), "groups")
    held = members.join(labelled.select("rid", "part").distinct(), "rid").join(sketches, "rid").join(_sets_of(docs, first, members.select("rid")), "rid")
    met = held.groupBy("group").agg(F.collect_list(F.struct("rid", "part", "sketch", "tokens")).alias("members")).select("members")
    return cut(met.mapInArrow(_links_in_nodes(least, percent), "a long, b long").distinct(), "links")


def _branch(rows: DataFrame, sketches: DataFrame, depth: int, trees: int) -> DataFrame:
    """Children of oversized nodes: members go on by the depth's coordinate of their tree."""
    child = F.xxhash64("node", F.element_at("sketch", ((depth + 1) * trees + F.col("tree") + 1).cast("int")))
    return rows.join(sketches, "rid").select("tree", child.alias("node"), "rid")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Group documents whose distinct 5-word shingles have 100 * intersection >= ``percent`` * union.

    ``docs`` needs doc_id (integer) and text; other columns are ignored. Returns a row per input row:
    doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id).

    * Documents with equal sets share one representative, found by aggregation, so copies meet no pair stage.
    * Independent trees branch representatives by minwise tokens. Nodes of up to ``NODE_LIMIT`` members are
      compared exhaustively on their 16-bit minima; larger ones branch on a further coordinate for each of up to
      ``DEPTHS`` levels. ``plan`` derives the number of trees from the threshold: on the deepest level, the worst,
      a pair at 0.85 misses all 20 trees with 8.1e-6, a pair at 0.80 all 29 with 1.0e-5 (by calculation). The sketch
      filter before the exact test loses another 2.8e-6 and 1.2e-6 of such pairs, and pairs above the threshold less.
    * What is still oversized is one mass of near copies or of texts from a template: members are compared with its few
      most central members first. Members that this leaves outside the node's main part are then compared with all
      its members by fine sketches of ``FINE_BITS`` bits, block by block; this is quadratic in their number, at about
      0.1 microseconds a pair, and loses less than 1e-6 of the pairs at the threshold. Nothing is capped.
    * Every candidate is confirmed on the full sets before it becomes a link. The best candidate of every document comes
      first; then nodes with members of different parts give all their candidates between the parts, since links inside a
      part change nothing. So a large group of copies makes no more candidates than it has members.

    Hot keys never meet in one task: sizes of nodes are aggregated before a shuffle, members of oversized nodes and
    partners of a central member are salted, and copies join their representative in the same way.

    Null or empty texts and texts of white space have no shingles and link with nothing: component_id is
    their own id. A null doc_id gets a null component_id and kept = false. Rows that repeat a doc_id are
    one node; any of their texts may link it. An empty table gives an empty result.
    """
    trees, depths, coordinates, least = plan(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = docs.mapInArrow(_signatures(trees, coordinates), "doc_id long, n_shingles long, s1 long, s2 long, roots array<long>, sketch array<short>")
    base = cut(signed.withColumn("uid", F.monotonically_increasing_id()), "signatures")
    key = ["n_shingles", "s1", "s2"]
    named = base.where("n_shingles > 0 and doc_id is not null")
    least_id = F.min(F.struct("doc_id", "uid")).alias("least")
    first = cut(named.groupBy(*key).agg(least_id, F.count("*").alias("copies")).select(*key, "copies", "least.doc_id", F.col("least.uid").alias("rid")), "representatives")
    reps = cut(named.join(first.select(F.col("rid").alias("uid")), "uid").select(F.col("uid").alias("rid"), "roots", "sketch"), "sketches")
    sketches = reps.select("rid", "sketch")

    rows = reps.select(F.posexplode("roots").alias("tree", "token"), "rid").select("tree", F.xxhash64("tree", "token").alias("node"), "rid")
    small, masses = [], None
    for depth in range(depths + 1):
        sizes = cut(rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1"), f"sizes{depth}")
        small.append(cut(rows.join(sizes.where(F.col("members") <= NODE_LIMIT).select("node"), "node").select("node", "rid"), f"depth{depth}"))
        large = sizes.where(F.col("members") > NODE_LIMIT)
        if large.isEmpty():
            break
        rows = rows.join(_few(large), "node")
        if depth < depths:
            rows = cut(_branch(rows, sketches, depth, trees), f"branch{depth}")
        else:
            masses = cut(rows.select("node", "rid", "members", F.ceil(F.col("members") / SALTED_ROWS).alias("salts")), "masses")
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.union(more)
    gathered = nodes.join(sketches, "rid").groupBy("node").agg(F.collect_list(F.struct("rid", "sketch")).alias("members")).select("members")
    near = gathered.mapInArrow(_best_in_nodes(least), "a long, b long, agreement double")
    if masses is not None:
        near = near.union(_near_pivots(masses, sketches, least))
    best = cut(near.groupBy("b").agg(F.max_by("a", F.struct("agreement", "a")).alias("a")).select("a", "b"), "best")
    # representatives of one document are linked through it
    several = first.groupBy("doc_id").agg(F.min("rid").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = cut(first.join(_few(several), "doc_id").where("rid <> a").select("a", F.col("rid").alias("b")), "same")
    links = links.union(_links(best, _sets_of(docs, first, _ends(best)), percent))
    parts = connected_components(links)
    more = _links_across(nodes, parts, sketches, docs, first, least, percent)
    if not more.isEmpty():
        links = links.union(more)
        parts = connected_components(links)
    if masses is not None:
        open_nodes = _open(masses, parts)
        if not open_nodes.isEmpty():
            more = _links_in_masses(open_nodes, _sets_of(docs, first, open_nodes.select("rid")), percent)
            if not more.isEmpty():
                parts = connected_components(links.union(more))
    placed = first.join(parts.withColumnRenamed("node", "rid"), "rid", "left").withColumn("part", F.coalesce("component", "rid"))
    reached = cut(placed.groupBy("part").agg(F.min("doc_id").alias("component")), "reached")
    placed = cut(placed.drop("component").join(reached, "part").select(*key, "copies", "component"), "placed")
    return _spread(base.select("doc_id", *key), placed, key)


def _spread(rows: DataFrame, placed: DataFrame, key: list[str]) -> DataFrame:
    """Every row with the component of its set. Sets with many copies, at most one for every ``limit`` rows, are broadcast."""
    limit = max(SALTED_ROWS, rows.count() // 100_000)
    hot = _few(placed.where(F.col("copies") > limit))
    of = lambda name: placed_id.alias(name)
    own = F.when(F.col("doc_id").isNotNull(), F.col("doc_id"))
    placed_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    among = rows.join(hot, key, "left")
    met = among.where("component is not null").select("doc_id", "n_shingles", of("component_id"))
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", own.alias("component_id"))
    rest = among.where("component is null and n_shingles > 0 and doc_id is not null").select("doc_id", *key).join(placed.where(F.col("copies") <= limit), key)
    rest = rest.select("doc_id", "n_shingles", of("component_id"))
    out = met.where("doc_id is not null").union(rest).union(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near-duplicates is kept; all columns stay.

    The document with the smallest doc_id of a group stays, before those without one. Rows are told apart by doc_id and
    text: rows that repeat an id with different texts are different documents, equal rows are one, and documents
    without words all stay. Only keys of the rows that go travel to the texts, so no text is shuffled, but for those that
    stand in several equal rows. An empty table gives an empty result.
    """
    row_key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.select(row_key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    groups = cut(near_duplicates(keyed, percent).select(F.col("doc_id").alias("key"), "component_id").distinct(), "groups")
    names = cut(docs.select(row_key.alias("key"), F.col("doc_id").cast("long").alias("id")).groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "names")
    keeper = groups.join(names, "key").groupBy("component_id").agg(F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "key")).alias("keeper"))
    gone = cut(groups.join(keeper, "component_id").where("key <> keeper.key").select("key"), "gone")
    again = cut(names.where("rows > 1").select("key").join(gone, "key", "left_anti"), "again")
    own = [F.col(f"docs.{c}") for c in docs.columns]
    kept = docs.alias("docs").join(_few(gone), row_key == gone["key"], "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(_few(again), row_key == again["key"], "left_anti")
    more = kept.join(_few(again), row_key == again["key"], "left_semi").withColumn("key of the row", row_key)
    return once.select(own).unionByName(more.dropDuplicates(["key of the row"]).select(*docs.columns))


def _salted(masses: DataFrame, per_node: DataFrame) -> DataFrame:
    """Members of oversized nodes with what ``per_node`` has for their node; every salt of a node gets a copy of it."""
    salts = F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)
    spread = per_node.join(masses.groupBy("node").agg(F.max("salts").alias("salts")), "node").withColumn("salt", F.explode(salts)).drop("salts")
    return masses.withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts"))).join(spread, ["node", "salt"])


def _near_pivots(masses: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, agreement) of each member and that of its oversized node's most central members that agrees with it best.

    Central are those that agree best with a sample of the node.
    """
    held = cut(masses.join(sketches, "rid"), "members")
    spread = W.partitionBy("node").orderBy(F.xxhash64("rid"))
    sample = held.withColumn("k", F.row_number().over(spread)).where(F.col("k") <= SAMPLE).groupBy("node").agg(F.collect_list("sketch").alias("sample"))
    central = _salted(held, cut(sample, "samples")).select("node", "rid", "sketch", "sample").mapInArrow(_agreement, "node long, rid long, agreement double")
    best = W.partitionBy("node").orderBy(F.desc("agreement"), "rid")
    central = cut(central.withColumn("k", F.row_number().over(best)).where(F.col("k") <= PIVOTS).select("node", "rid"), "pivots")
    pivots = central.join(sketches, "rid").groupBy("node").agg(F.collect_list(F.struct(F.col("rid").alias("p"), "sketch")).alias("pivots"))
    met = _salted(held, cut(pivots, "pivots")).select("rid", "sketch", "pivots")
    return met.mapInArrow(_nearest_pivots(least), "a long, b long, agreement double")


def _agreement(batches):
    import pyarrow as pa

    for batch in slices(batches, 500):
        mine, sample = _matrix(batch.column("sketch")), batch.column("sample")
        bounds, flat = sample.offsets.to_numpy(), _matrix(sample.values)
        means = [float((flat[bounds[k] : bounds[k + 1]] == mine[k]).mean()) for k in range(batch.num_rows)]
        yield pa.record_batch([batch.column("node"), batch.column("rid"), pa.array(means, pa.float64())], names=["node", "rid", "agreement"])


def _open(masses: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of the oversized nodes that links do not connect yet: node, rid, part, members, and whether outside the node's largest part."""
    labelled = masses.join(parts.withColumnRenamed("node", "rid"), "rid", "left").select("node", "rid", "members", F.coalesce("component", "rid").alias("part"))
    labelled = cut(labelled, "labelled")
    main = labelled.groupBy("node", "part").count().groupBy("node").agg(F.max_by("part", F.struct("count", "part")).alias("main"), F.count("*").alias("parts"))
    main = _few(cut(main.where("parts > 1").select("node", "main"), "main"))
    return cut(labelled.join(main, "node").withColumn("stray", F.col("part") != F.col("main")).drop("main"), "open")


def _fine_sketches(batches):
    """One bit of the minimum of each of ``FINE_BITS`` hash functions."""
    import pyarrow as pa

    rng = np.random.default_rng(17)
    mul, add = rng.integers(0, 2**32, FINE_BITS, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, FINE_BITS, dtype=np.uint32)
    for batch in slices(batches, 500):
        bits = []
        for raw in batch.column("tokens").to_pylist():
            x = (np.frombuffer(raw, np.uint64) >> np.uint64(32)).astype(np.uint32)
            low = np.full(FINE_BITS, 0xFFFFFFFF, np.uint32)
            for i in range(0, len(x), 256):
                low = np.minimum(low, (x[i : i + 256, None] * mul + add).min(axis=0))
            bits.append(np.packbits(((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8)).tobytes())
        yield pa.record_batch([batch.column("rid"), pa.array(bits, pa.binary())], names=["rid", "fine"])


def _meetings(members: DataFrame, size: int, fields: list[str]) -> DataFrame:
    """Pairs of blocks of a node's members (node, stray, members, ``fields``), of about ``size`` each, one of strays: strays, members."""
    block = F.pmod(F.xxhash64("rid"), F.ceil(F.col("members") / size))
    blocks = members.select("node", "stray", block.alias("block"), F.struct(*fields).alias("member")).groupBy("node", "stray", "block").agg(F.collect_list("member").alias("members"))
    blocks = cut(blocks, "blocks")
    left = blocks.where("stray").select("node", F.col("block").alias("own"), F.col("members").alias("strays"))
    return left.join(blocks, "node").where("not stray or block >= own").select("node", "strays", "members")


def _links_in_masses(open_nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different parts of oversized nodes, one end a stray.

    Fine sketches, block by block, tell which members have a candidate at all; those then meet in smaller blocks with
    their full sets. Each meeting of blocks gives only links that join parts, so fewer than it has members.
    """
    same = (1 + percent / 100) / 2
    most = (1 - same + DEVIATIONS * math.sqrt(same * (1 - same) / FINE_BITS)) * FINE_BITS
    held = cut(open_nodes.join(sets.mapInArrow(_fine_sketches, "rid long, fine binary"), "rid"), "fine")
    alive = cut(_meetings(held, BLOCK_MEMBERS, ["rid", "part", "fine"]).mapInArrow(_alive(most), "node long, rid long").distinct(), "alive")
    counts = alive.groupBy("node").agg(F.count("*").alias("members"))
    active = held.drop("members").join(alive, ["node", "rid"]).join(_few(cut(counts, "counts")), "node").join(sets, "rid")
    met = _meetings(active, SET_MEMBERS, ["rid", "part", "fine", "tokens"]).select("strays", "members")
    return cut(met.mapInArrow(_links_of_blocks(most, percent), "a long, b long").distinct(), "links")


def _unpack(lists, k: int):
    """Ids, parts and fine sketches of one block, and the block itself."""
    s, e = lists.offsets[k].as_py(), lists.offsets[k + 1].as_py()
    own = lists.values.slice(s, e - s)
    fine = np.frombuffer(b"".join(own.field("fine").to_pylist()), np.uint64).reshape(e - s, -1)
    return own.field("rid").to_numpy(), own.field("part").to_numpy(), fine, own


def _candidates(one, other, most: float):
    """Places (i, j) and distances of members of two blocks in different parts whose fine sketches differ in at most ``most`` bits."""
    (_, part, fine, _), (_, other_part, other_fine, _) = one, other
    for i in range(0, len(part), 64):
        differ = np.bitwise_count(fine[i : i + 64, None, :] ^ other_fine[None]).sum(axis=2, dtype=np.int64)
        x, y = np.nonzero((differ <= most) & (part[i : i + 64, None] != other_part[None]))
        yield i + x, y, differ[x, y]


def _alive(most: float):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 20):
            nodes, rids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for k, node in enumerate(batch.column("node").to_pylist()):
                one, other = _unpack(batch.column("strays"), k), _unpack(batch.column("members"), k)
                for i, j, _ in _candidates(one, other, most):
                    found = np.unique(np.concatenate([one[0][i], other[0][j]]))
                    rids.append(found), nodes.append(np.full(len(found), node))
            yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in (nodes, rids)], names=["node", "rid"])

    return run


def _links_of_blocks(most: float, percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 4):
            found = []
            for k in range(batch.num_rows):
                one, other = _unpack(batch.column("strays"), k), _unpack(batch.column("members"), k)
                sets = [np.frombuffer(t, np.uint64) for own in (one, other) for t in own[3].field("tokens").to_pylist()]
                i, j, d = (np.concatenate(c) for c in zip(*_candidates(one, other, most), strict=True))
                order = np.argsort(d, kind="stable")
                rid, part = np.concatenate([one[0], other[0]]), np.concatenate([one[1], other[1]])
                found += _joining_links(i[order], j[order] + len(one[0]), rid, part, sets, percent)
            yield pa.record_batch([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return run
