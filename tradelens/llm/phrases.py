"""Collocations: phrases counted by Rabin-Karp fingerprints, then verified and materialised where they are frequent."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import cut, mix

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
#: Bytes of text that are hashed together, and fingerprints that a task counts before it hands them on.
BLOCK_BYTES, HELD = 1 << 19, 1 << 19
#: Bits of a filter for each frequent fingerprint, and of a filter at most; a full one lets more pass, which costs time only.
FILTER_BITS_EACH, FILTER_BITS = 16, 1 << 28
PROBES = (0, 18, 36)
#: Frequent phrases of a bucket, about, whose counts are gathered together.
BUCKET_PHRASES = 512
BASE_OF_BYTES, BASE_OF_WORDS = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

WORD, BLANK, BREAK = range(3)
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = BLANK
CLASS[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
#: Lower case of A-Z; a tab becomes a space, as words of a phrase are joined by one.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[0x09] = 0x20


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2 ** 64 and their inverses, 2 ** ``bits`` of each."""
    size, inverse = 1 << bits, pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Prefix:
    """Prefix polynomials of a sequence: the hash of any run of it is a difference, shifted to the front."""

    def __init__(self, values: np.ndarray, base: int):
        up, self.down = _powers(base, max(16, len(values).bit_length()))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


class Block:
    """Words of some texts, with their pieces, languages and fingerprints."""

    def __init__(self, texts: list[tuple[bytes, str, int]]):
        """``texts``: bytes, language, and how many words at the front were counted before."""
        raw = np.frombuffer(b"\n".join(t for t, _, _ in texts), np.uint8)
        kind = CLASS[raw]
        self.low = LOWER[raw]
        edges = np.diff(np.concatenate([[0], (kind == WORD).view(np.int8), [0]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kind == BREAK, dtype=np.int32)[self.starts]
        lengths = np.array([len(t) + 1 for t, _, _ in texts])
        text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(lengths)]))))
        self.langs = sorted({lang for _, lang, _ in texts})
        codes = {lang: k for k, lang in enumerate(self.langs)}
        self.lang = np.array([codes[lang] for _, lang, _ in texts], np.int32)[text_of]
        seeds = np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.langs], np.uint64)
        self.fresh = np.ones(len(self.starts), bool)
        for k in [k for k, t in enumerate(texts) if t[2]]:
            first = np.searchsorted(text_of, k)
            self.fresh[first : first + texts[k][2]] = False
        self.words = mix(Prefix(self.low + np.uint64(1), BASE_OF_BYTES).runs(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))
        self.prefix = Prefix(self.words, BASE_OF_WORDS)
        self.seed = seeds[self.lang] if len(self.starts) else np.empty(0, np.uint64)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the ``n`` words from each word on, and whether they lie in one piece and were not counted before."""
        count = max(0, len(self.starts) - n + 1)
        first = np.arange(count)
        keys = mix(self.prefix.runs(first, first + n) + self.seed[:count] + np.uint64(n))
        return keys, (self.piece[:count] == self.piece[n - 1 :]) & self.fresh[n - 1 :] if count else np.empty(0, bool)

    def exact_words(self) -> np.ndarray:
        """Numbers of the words: equal for equal bytes only. Hashes propose, bytes are compared."""
        _, first, number = np.unique(self.words, return_index=True, return_inverse=True)
        size, same = self.ends - self.starts, first[number]
        if (size == size[same]).all():
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (self.low[np.repeat(self.starts, size) + within] == self.low[np.repeat(self.starts[same], size) + within]).all():
                return number
        known: dict[bytes, int] = {}
        text = self.low.tobytes()
        return np.array([known.setdefault(text[s:e], len(known)) for s, e in zip(self.starts.tolist(), self.ends.tolist(), strict=True)])

    def phrases(self, text: bytes, pointers: np.ndarray, n: int) -> list[bytes]:
        """The ``n`` words from each pointer on, joined by one space."""
        ends = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        s, e = self.starts[pointers], self.ends[pointers + n - 1]
        plain = e - s == ends[pointers + n] - ends[pointers] + n - 1
        out = [text[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        for k in np.flatnonzero(~plain).tolist():
            out[k] = b" ".join(out[k].split())
        return out


def _sections(text: bytes, lang: str, overlap: int) -> Iterator[tuple[bytes, str, int]]:
    """A long text in parts of about ``BLOCK_BYTES``, cut after a break, or else between words with ``overlap`` words repeated."""
    at, skip, begin = 0, 0, 0
    while len(text) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        window = np.frombuffer(text, np.uint8)[at:end]
        breaks = np.flatnonzero(CLASS[window] == BREAK)
        if len(breaks):
            end, following, next_skip = at + int(breaks[-1]) + 1, None, 0
        else:
            blanks = np.flatnonzero(CLASS[np.frombuffer(text, np.uint8)[end:]] != WORD)
            end = end + int(blanks[0]) if len(blanks) else len(text)
            # the last words before the cut come again, so that runs across it are seen
            following, next_skip = end, 0
            while next_skip < overlap and following > begin:
                stop = len(text[begin:following].rstrip(b" \t")) + begin
                if stop == begin:
                    break
                space = max(text.rfind(b" ", begin, stop), text.rfind(b"\t", begin, stop)) + 1
                following, next_skip = max(space, begin), next_skip + 1
        yield text[begin:end], lang, skip
        begin, at, skip = (end if following is None else following), end, next_skip
    yield text[begin:], lang, skip


def _blocks(batches: Iterable, overlap: int) -> Iterator[Block]:
    held: list[tuple[bytes, str, int]] = []
    size = 0
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast("large_binary").to_pylist(), strict=True):
            for part in _sections(text, lang, overlap):
                if size + len(part[0]) > BLOCK_BYTES and held:
                    yield Block(held)
                    held, size = [], 0
                held.append(part)
                size += len(part[0]) + 1
    if held:
        yield Block(held)


class Filter:
    """Fingerprints that may be among some: a Bloom filter of bounded size, whose places are the low bits of the shifted fingerprint."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for shift in PROBES:
            left = np.flatnonzero(out)
            at = (keys[left] >> np.uint64(shift)) & self.mask
            out[left] = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out

    @classmethod
    def of(cls, frequent: DataFrame) -> Filter:
        """From a table with a column ``key``; what reaches the driver is the bitmap's words that are not zero, of which there are 2 ** 22 at most."""
        n = frequent.count()
        size = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (n * FILTER_BITS_EACH).bit_length()))
        places = frequent.select(F.explode(F.array(*[F.expr(f"shiftrightunsigned(key, {shift}) & {size - 1}L") for shift in PROBES])).alias("at"))
        words = places.select(F.expr("shiftright(at, 6) as word"), F.expr("shiftleft(1L, cast(at & 63 as int)) as bit"))
        found = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toPandas()
        bits = np.zeros(size >> 6, np.int64)
        bits[found["word"].to_numpy()] = found["bits"].to_numpy()
        return cls(bits.view(np.uint8))


def _counted(sizes: list[int], overlap: int, pairs=None):
    """Counts of the fingerprints of runs of ``sizes`` words: key, count. With ``pairs`` (a broadcast filter) only of runs whose adjacent pairs all pass it."""

    def merged(held):
        keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[at], np.add.reduceat(counts, at)

    def run(batches):
        import pyarrow as pa

        def out(keys, counts):
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "count"])

        held, size = [], 0
        for block in _blocks(batches, overlap):
            may = pairs.value.passes(block.grams(2)[0]) if pairs else None
            for n in sizes:
                keys, valid = block.grams(n)
                if pairs and len(keys):
                    valid = valid & np.logical_and.reduce([may[k : k + len(keys)] for k in range(n - 1)])
                found = np.unique(keys[valid], return_counts=True)
                if len(found[0]):
                    held.append(found)
                    size += len(found[0])
            if size > HELD:
                keys, counts = merged(held)
                held, size = [(keys, counts)], len(keys)
                if size > HELD // 2:
                    for k in range(0, size, 1 << 18):
                        yield out(keys[k : k + (1 << 18)], counts[k : k + (1 << 18)])
                    held, size = [], 0
        if held:
            keys, counts = merged(held)
            for k in range(0, len(keys), 1 << 18):
                yield out(keys[k : k + (1 << 18)], counts[k : k + (1 << 18)])

    return run


def _written(longest: int, frequent, buckets: int):
    """Phrases of fingerprints that pass the filter, read where they occur, with verified counts: a row of lists (lang, words, phrase, count) for each bucket of phrases. Words of 0: all words of the language."""

    def run(batches):
        import pyarrow as pa

        def out():
            sizes = [len(own) for own in held.values()]
            columns = [pa.array(np.repeat(np.arange(len(sizes)), sizes)), pa.array(np.repeat([n for _, n in held], sizes).astype(np.int32))]
            columns += [pa.array([p for own in held.values() for p in own], pa.binary()), pa.array(np.fromiter((c for own in held.values() for c in own.values()), np.int64, sum(sizes)))]
            bucket = np.fromiter((zlib.crc32(p) % buckets for own in held.values() for p in own), np.int32, sum(sizes))
            order = np.argsort(bucket, kind="stable")
            columns = [c.take(pa.array(order)) for c in columns]
            columns[0] = pa.array([lang for lang, _ in held], pa.string()).take(columns[0])
            columns[2] = columns[2].cast(pa.string())
            found, starts = np.unique(bucket[order], return_index=True)
            offsets = pa.array(np.append(starts, sum(sizes)).astype(np.int32))
            return pa.record_batch([pa.array(found), *[pa.ListArray.from_arrays(offsets, c) for c in columns]], names=["bucket", "lang", "words", "phrase", "count"])

        held: dict[tuple[str, int], dict[bytes, int]] = {}
        for block in _blocks(batches, longest - 1):
            number, text = block.exact_words(), block.low.tobytes()
            for k, count in enumerate(np.bincount(block.lang[block.fresh], minlength=len(block.langs)).tolist()):
                own = held.setdefault((block.langs[k], 0), {b"": 0})
                own[b""] += count
            for n in range(1, longest + 1):
                keys, valid = block.grams(n)
                at = np.flatnonzero(valid & frequent.value.passes(keys)) if len(keys) else np.empty(0, np.int64)
                if not len(at):
                    continue
                _, first, same, counts = np.unique(keys[at], return_index=True, return_inverse=True, return_counts=True)
                exact = [block.lang[at], *[number[at + k] for k in range(n)]]
                # every occurrence is held to the one its fingerprint points to
                if not all((c == c[first][same]).all() for c in exact):
                    _, first, counts = np.unique(np.stack(exact, 1), axis=0, return_index=True, return_counts=True)
                pointers = at[first]
                for k in np.unique(block.lang[pointers]).tolist():
                    mine = block.lang[pointers] == k
                    own = held.setdefault((block.langs[k], n), {})
                    for phrase, count in zip(block.phrases(text, pointers[mine], n), counts[mine].tolist(), strict=True):
                        own[phrase] = own.get(phrase, 0) + count
            if sum(map(len, held.values())) > HELD:
                yield out()
                held = {}
        if held:
            yield out()

    return run


def _gathered(least: int):
    """Lists of counts, sorted by bucket, to the phrases that occur ``least`` times; a task holds the phrases of one bucket at a time."""

    def run(batches):
        import pyarrow as pa

        def out(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["lang", "words", "phrase", "count"])

        held: dict[tuple[str, int, str], int] = {}
        bucket, rows = None, []
        for b in batches:
            for own, *lists, counts in zip(*[b.column(c).to_pylist() for c in ("bucket", "lang", "words", "phrase", "count")], strict=True):
                if own != bucket:
                    rows += [(*key, count) for key, count in held.items() if count >= least or not key[1]]
                    bucket, held = own, {}
                for key, count in zip(zip(*lists, strict=True), counts, strict=True):
                    held[key] = held.get(key, 0) + count
            if len(rows) > 10_000:
                yield out(rows)
                rows = []
        rows += [(*key, count) for key, count in held.items() if count >= least or not key[1]]
        if rows:
            yield out(rows)

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """All phrases of up to ``longest`` words that a language has ``least`` times: lang, words, phrase, count; words = 0 is the language's number of words.

    Three scans of the texts. Words and pairs are counted by fingerprint; then longer runs whose pairs are all frequent
    (none other can be); both hand on (fingerprint, count) only. The third scan looks for frequent fingerprints, keeps an occurrence of each as its pointer,
    compares all others with it, and counts phrases by their text. So a collision of fingerprints costs time, never a wrong count.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def frequent(sizes: list[int], pairs=None) -> DataFrame:
        counted = docs.mapInArrow(_counted(sizes, longest - 1, pairs), "key long, count long")
        return counted.groupBy("key").agg(F.sum("count").alias("count")).where(F.col("count") >= least).select("key")

    short = cut(frequent([1, 2][:longest]), "short")
    keys = short
    if longest > 2:
        keys = short.union(cut(frequent(list(range(3, longest + 1)), spark.sparkContext.broadcast(Filter.of(short))), "long"))
    buckets = max(16, min(1 << 20, keys.count() // BUCKET_PHRASES))
    lists = "bucket int, lang array<string>, words array<int>, phrase array<string>, count array<long>"
    written = docs.mapInArrow(_written(longest, spark.sparkContext.broadcast(Filter.of(keys)), buckets), lists)
    gathered = written.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_gathered(least), "lang string, words int, phrase string, count long")
    return cut(gathered, "phrases")


def _part(first, last):
    """Words ``first`` to ``last`` (from 1) of the phrase."""
    return F.array_join(F.slice("split", first, last - first + 1), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    ``docs``: lang (null: ``und``), text (null: empty). A-Z count as lower case; texts are split at ``[.,;:!?]`` and line ends into pieces, those at spaces and tabs
    into words. n: the language's words. Candidates are phrases of 2 to ``longest`` words with a >= ``least`` occurrences within
    pieces; cut after its first k words, a candidate's parts occur l and r times, and its score is the least of floor(2000000 * a / (l + r)) over k (ties:
    the smallest k). A candidate is left out if a longer one that holds it occurs at least ``covered`` percent as often. Order: score and a descending, phrase ascending by bytes.

    Repeated rows count as often as they stand there. Empty tables give an empty result; other columns are ignored.
    """
    phrases = frequent_phrases(docs, least, longest)
    counts = phrases.where("words > 0").select("lang", "phrase", "count")
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("count").alias("a"), F.split("phrase", " ").alias("split"))

    cuts = candidates.select("lang", "phrase", "a", "split", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words")).alias("right"))
    left, right = (counts.select("lang", F.col("phrase").alias(side), F.col("count").alias(c)) for side, c in (("left", "l"), ("right", "r")))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumns({"wide_a": wide("a"), "parts": wide("l") + wide("r")})
    scored = scored.withColumn("score", F.expr("cast(wide_a * 2000000 div parts as bigint)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.score", "best.l", "best.r")

    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    longer = candidates.where("words > 2").select("lang", "split", "words", "a", size)
    inner = longer.select("lang", "a", "split", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("first")).select("lang", "a", _part(F.col("first"), F.col("first") + F.col("size") - 1).alias("phrase"))
    holders = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(holders, ["lang", "phrase"], "left").where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * covered))

    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
