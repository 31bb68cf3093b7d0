"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a string of words, each followed by a space, and an end, which is a space alone. Every byte has a prefix
code, and every bit of it is predicted in six hashed contexts: one, two and three bytes before it in the word, the word
so far, the word so far after the word before, and the word so far after the last frequent word. A seventh input
is the bit of the word that followed the same word earlier in the text. The predictions are mixed in the logistic
domain by weights that a gate selects by how much the contexts have seen, and the mixture is refined adaptively: in every text
the weights go on learning, chunk by chunk, from the bits before. The probability of a text is the product over its bits, so the
probabilities of all words after any text sum to at most 1.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import WordHashes, cut, mix, slices, text_bytes, words_of

#: Contexts inside a word and across words; inputs are these, the followed word and a constant.
INSIDE, ACROSS = 4, 2
CONTEXTS = INSIDE + ACROSS
#: Inputs that a text's own weights scale: the contexts inside the word, two across words, the followed word.
INPUTS = 2 + ACROSS
#: Slots of a context's table: eight for every distinct word, within these powers of two.
LEAST_SLOTS, MOST_SLOTS = 16, 21
#: Bits of a word's head, which has gates of its own.
HEAD = 20
#: Frequent words that the last context remembers.
FREQUENT = 256
#: One training text in so many, by hash, teaches the mixing weights instead of the tables.
WEIGHTS_EVERY = 32
#: Gates of the weights inside words: by how much the two longest contexts have seen, in a word's head or behind it.
GATES = 32
BLOCK_BYTES = 3 << 20
#: Tokens that a text is refined after, at first and at most; their number doubles.
FIRST_CHUNK, LAST_CHUNK = 48, 3072
#: How firmly a text holds to the learned weights.
PRIOR = 30.0
#: Texts whose words are counted together, bits of word pairs and of single words that are expanded at once.
_TEXTS, _PAIR_BITS, _BITS = 4000, 2_000_000, 1 << 18
_END = b""
_SPACE = 0x20
_SPREAD = np.uint32(0x9E3779B1)


def prefix_code(frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes, bits and length of each byte's code in a Huffman tree over all 256 bytes."""
    heap = [(float(f), i, i) for i, f in enumerate(frequency)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    inner = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[2]], parent[b[2]] = (inner, 0), (inner, 1)
        heapq.heappush(heap, (a[0] + b[0], inner, inner))
        inner += 1
    paths = []
    for i in range(256):
        path = []
        while i in parent:
            i, bit = parent[i]
            path.append((i - 256, bit))
        paths.append(path[::-1])
    length = np.array([len(p) for p in paths])
    nodes, bits = np.zeros((256, length.max()), np.int64), np.zeros((256, length.max()), np.uint8)
    for i, path in enumerate(paths):
        nodes[i, : len(path)], bits[i, : len(path)] = zip(*path, strict=True)
    return nodes, bits, length


class Spelling:
    """Bits of distinct words with the hash of the word so far, which gives the slots of the other contexts."""

    def __init__(self, words: list[bytes], code, slot_bits: int):
        nodes, bits, length = code
        s = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        own = np.fromiter(map(len, words), np.int64, len(words)) + 1
        begin = np.cumsum(own) - own
        word = np.repeat(np.arange(len(words)), own)
        place = np.arange(len(s)) - begin[word]
        before = np.full((3, len(s)), _SPACE, np.uint64)
        for k in range(3):
            at = np.flatnonzero(place > k)
            before[k, at] = s[at - k - 1]
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(len(s), 0x9E3779B97F4A7C15, np.uint64))
            back = np.cumprod(np.full(len(s), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((s.astype(np.uint64) + np.uint64(1)) * power)])
            so_far = (total[np.arange(len(s))] - total[begin[word]]) * back[begin[word]] + place.astype(np.uint64)
            del power, back, total
        contexts = [before[0], before[0] << np.uint64(8) | before[1], before[0] << np.uint64(16) | before[1] << np.uint64(8) | before[2], so_far]
        for k, c in enumerate(contexts):
            contexts[k] = (mix((c + np.uint64(k + 1)) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype(np.uint32)
        del before, so_far, c, word, place
        n = length[s]
        ends = np.cumsum(n)
        self.count = np.add.reduceat(n, begin)
        self.first = np.cumsum(self.count) - self.count
        self.shift = np.uint32(32 - slot_bits)
        self.bit, self.path = np.empty(ends[-1], np.uint8), np.empty(ends[-1], np.uint32)
        spread = np.arange(256, dtype=np.uint32) * _SPREAD
        # the bits of some bytes at a time, as a place or a step of all bits would outweigh what is kept
        byte = 0
        while byte < len(s):
            start = ends[byte] - n[byte]
            stop = max(byte + 1, int(np.searchsorted(ends, start + _BITS, side="right")))
            part = np.repeat(np.arange(byte, stop), n[byte:stop])
            step = np.arange(len(part)) - np.repeat(ends[byte:stop] - n[byte:stop] - start, n[byte:stop])
            at, here = s[part], slice(start, start + len(part))
            self.bit[here] = bits[at, step]
            self.path[here] = contexts[-1].take(part) + spread.take(nodes[at, step])
            byte = stop
        self.lengths, self.differ = n, [c - contexts[-1] for c in contexts]

    def inside(self, k: int) -> np.ndarray:
        """Slots of all bits in a context inside the word."""
        slots = np.repeat(self.differ[k], self.lengths)
        slots += self.path
        slots >>= self.shift
        return slots

    def parts(self, ids: np.ndarray, most: int):
        """Ranges of tokens with at most so many bits together, or of one token that has more."""
        ends, i = np.cumsum(self.count[ids]), 0
        while i < len(ids):
            stop = max(i + 1, int(np.searchsorted(ends, most + (ends[i - 1] if i else 0), side="right")))
            yield slice(i, stop)
            i = stop

    def bits_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all bits of tokens: the token of each bit, and the bit's place here."""
        n = self.count[ids]
        token = np.repeat(np.arange(len(ids), dtype=np.int32), n)
        at = (self.first[ids] - (np.cumsum(n) - n)).astype(np.int32)[token]
        at += np.arange(len(token), dtype=np.int32)
        return token, at

    def across(self, at: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Slots of bits after a context (32 bits)."""
        slots = self.path[at]
        slots ^= context
        slots *= _SPREAD
        slots >>= self.shift
        return slots


def before_of(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of the word before each token, and of the last frequent word before it.

    ``h``: hashes of a text's words, without the end; ``known``: which of them are frequent.
    """
    last = np.zeros(len(h) + 1, np.uint64)
    last[1:] = h
    where = np.maximum.accumulate(np.where(known, np.arange(1, len(h) + 1), 0)) if len(h) else np.empty(0, np.int64)
    recent = np.zeros(len(h) + 1, np.uint64)
    recent[1:] = np.where(where > 0, h[where - 1], 0) if len(h) else 0
    as32 = lambda x, salt: (mix(x + np.uint64(salt)) >> np.uint64(32)).astype(np.uint32)
    return as32(last, 1), as32(recent, 2)


def indexed(texts) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """Places of distinct words in order of appearance, and each text's words as places; no text's words are kept."""
    index: dict[bytes, int] = {}
    places = []
    for text in texts:
        ws = words_of(text)
        places.append(np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int32, len(ws)))
    return index, places


class Counter:
    """How often the slots of each context saw a 0 and a 1, over batches of texts."""

    def __init__(self, code, slot_bits: int, frequent: np.ndarray):
        self.code, self.slot_bits, self.frequent = code, slot_bits, frequent
        self.counts = np.zeros((CONTEXTS, 2 << slot_bits), np.uint16)
        self.hashes = WordHashes()

    def _add(self, k: int, slots: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        at = slots.astype(np.int64)
        at <<= 1
        at |= bit
        total = np.bincount(at, weight, 2 << self.slot_bits)
        del at
        total += self.counts[k]
        np.minimum(total, 65535, out=total)
        self.counts[k] = total

    def add(self, texts: list[bytes | None]) -> None:
        index, places = indexed(texts)
        distinct = [*index, _END]
        end, h = len(index), self.hashes.of(list(index))
        del index
        known = np.isin(h, self.frequent)
        ids, contexts = [], ([], [])
        for own in places:
            ids.append(np.append(own, np.int32(end)))
            for held, c in zip(contexts, before_of(h[own], known[own]), strict=True):
                held.append(c)
        ids = np.concatenate(ids)
        spelling = Spelling(distinct, self.code, self.slot_bits)
        weight = np.bincount(ids, minlength=len(distinct)).astype(float)
        del distinct, places
        of_bit = np.repeat(weight, spelling.count)
        for k in range(INSIDE):
            self._add(k, spelling.inside(k), spelling.bit, of_bit)
        del of_bit
        for k, c in enumerate(contexts):
            pairs, n = np.unique(np.concatenate(c).astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_counts=True)
            context, word = (pairs >> np.uint64(32)).astype(np.uint32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)
            for own in spelling.parts(word, _PAIR_BITS):
                token, at = spelling.bits_of(word[own])
                self._add(INSIDE + k, spelling.across(at, context[own][token]), spelling.bit[at], n[own].astype(float)[token])


def tables_of(counts: np.ndarray) -> np.ndarray:
    """Log odds of a 1 in quarters (upper six bits) and how much the slot has seen, from 0 to 3 (lower two bits)."""
    pairs = counts.reshape(len(counts), -1, 2)
    out = np.empty(pairs.shape[:2], np.int8)
    for k, own in enumerate(pairs):
        zeros, ones = own[:, 0].astype(np.float32), own[:, 1].astype(np.float32)
        n = zeros + ones
        odds = np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))).clip(-7.9, 7.9)
        out[k] = (np.round(odds * 4).clip(-32, 31).astype(np.int8) << 2) | ((n > 0).astype(np.int8) + (n > 2) + (n > 15))
    return out


class Weights:
    """Mixing weights: inside words by gate, across words by how much the slot has seen, and of the followed word."""

    def __init__(self):
        self.inside = np.tile(np.array([0.05, 0.1, 0.2, 0.4, 0.0], np.float32), (GATES, 1))
        self.across = np.tile(np.array([0.0, 0.1, 0.2, 0.3], np.float32), (ACROSS, 1))
        self.followed = np.float32(2.0)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.inside.ravel(), self.across.ravel(), [self.followed]])

    def set(self, flat: np.ndarray) -> Weights:
        n = self.inside.size
        self.inside, self.across = flat[:n].reshape(GATES, -1).astype(np.float32), flat[n:-1].reshape(ACROSS, -1).astype(np.float32)
        self.followed = np.float32(flat[-1])
        return self


class Mixer:
    """Tables, weights and code; scores texts of one set of distinct words."""

    def __init__(self, code, slot_bits: int, frequent: np.ndarray, tables: np.ndarray, weights: Weights | None = None):
        self.code, self.slot_bits, self.frequent, self.tables = code, slot_bits, frequent, tables
        self.weights = weights or Weights()

    def spell(self, words: list[bytes]) -> None:
        """Prepare the distinct words of a block, whose last is the end: their bits, and how they are predicted inside words."""
        self.spelling = s = Spelling(words, self.code, self.slot_bits)
        self.h = WordHashes().of(words)
        self.known = np.isin(self.h, self.frequent)
        seen = [self.tables[k].take(s.inside(k)) for k in range(INSIDE)]
        s.lengths = s.differ = None
        place = np.arange(len(s.bit), dtype=np.int32)
        place -= np.repeat(s.first.astype(np.int32), s.count)
        self.gate = ((seen[3] & 3) << 2 | (seen[2] & 3)).astype(np.uint8) + (place >= HEAD).astype(np.uint8) * np.uint8(GATES // 2)
        del place
        self.odds = [v >> 2 for v in seen]
        self.refresh()

    def refresh(self) -> None:
        """Log odds of each bit by the contexts inside words."""
        w = self.weights
        z = w.inside[:, INSIDE].take(self.gate)
        for k in range(INSIDE):
            z += w.inside[:, k].take(self.gate) * (self.odds[k] * np.float32(0.25))
        self.z = z
        self.refresh_across()

    def refresh_across(self) -> None:
        """Log odds by every state of a slot across words."""
        w = self.weights
        levels, odds = np.arange(256, dtype=np.uint8).view(np.int8) & 3, (np.arange(256, dtype=np.uint8).view(np.int8) >> 2) * np.float32(0.25)
        self.lookup = [w.across[k][levels] * odds for k in range(ACROSS)]

    def inputs(self, ids: np.ndarray, contexts, guess: np.ndarray):
        """All bits of tokens, their four inputs and the slots' states; ``guess``: the followed word or -1."""
        s = self.spelling
        token, at = s.bits_of(ids)
        bit = s.bit[at]
        x = np.zeros((INPUTS, len(at)), np.float32)
        x[0] = self.z[at]
        seen = []
        for k, c in enumerate(contexts):
            v = self.tables[INSIDE + k].take(s.across(at, c[token])).view(np.uint8)
            x[1 + k] = self.lookup[k].take(v)
            seen.append(v)
        sure = guess >= 0
        if sure.any():
            k = np.flatnonzero(sure[token])
            own = token[k]
            begin = np.cumsum(s.count[ids]) - s.count[ids]
            offset = k - begin[own]
            length = s.count[guess[own]]
            there = s.bit[s.first[guess[own]] + np.minimum(offset, length - 1)]
            differ = (offset >= length) | (there != bit[k])
            passed = np.cumsum(differ) - differ
            start = np.flatnonzero(offset == 0)
            alike = (passed == np.repeat(passed[start], np.diff(np.append(start, len(k))))) & (offset < length)
            x[INPUTS - 1, k[alike]] = np.where(there[alike] > 0, self.weights.followed, -self.weights.followed)
        return bit, x, at, seen

    def text(self, own: np.ndarray, learner: Learner | None = None, spelled: int | None = None) -> float:
        """Bits of a text, given as its words' places without the end; with ``spelled``, of the token at that place alone."""
        contexts = before_of(self.h[own], self.known[own])
        ids = np.append(own, len(self.h) - 1)
        guess = followed_word(ids)
        scale, firm, at, size = np.ones(INPUTS, np.float32), np.full(INPUTS, PRIOR, np.float32), 0, FIRST_CHUNK
        total = 0.0
        while at < len(ids):
            # a chunk of very long words ends early
            stop = at + next(self.spelling.parts(ids[at : at + size], _BITS)).stop
            bit, x, place, seen = self.inputs(ids[at:stop], [c[at:stop] for c in contexts], guess[at:stop])
            if learner is not None:
                x[0] = learner.inside(self, place)
            side = bit.astype(np.float32) * 2 - 1
            e = np.exp(np.clip(-side * (scale @ x), -20, 20))
            if spelled is not None and at <= spelled < stop:
                n = self.spelling.count[ids[at:stop]]
                first = int(n[: spelled - at].sum())
                return float(np.log1p(e)[first : first + n[spelled - at]].sum()) / np.log(2)
            total += float(np.log1p(e).sum())
            miss = e / (1 + e)
            error = side * miss
            if learner is not None:
                learner.learn(self, place, x, seen, error)
            firm += (x * x) @ (miss * (1 - miss))
            scale = np.maximum(scale + (x @ error) / firm, 0).astype(np.float32)
            at, size = stop, min(2 * size, LAST_CHUNK)
        return total / np.log(2)


def followed_word(ids: np.ndarray) -> np.ndarray:
    """For each token, the one that followed the last earlier occurrence of the token before it, if the same held for that one; else -1."""
    by = np.argsort(ids, kind="stable")
    last = np.full(len(ids), -1)
    last[by[1:]] = np.where(ids[by[1:]] == ids[by[:-1]], by[:-1], -1)
    guess = np.full(len(ids), -1)
    guess[1:] = np.where(last[:-1] >= 0, ids[last[:-1] + 1], -1)
    right = np.zeros(len(ids), bool)
    right[1:] = guess[:-1] == ids[:-1]
    return np.where(right, guess, -1)


class Learner:
    """Online learning of the mixing weights over texts, by steps that each weight's own gradients size."""

    def __init__(self, rate: float = 0.02):
        self.rate, self.spread, self.steps = rate, None, 0

    def _step(self, weights: Weights, grad: np.ndarray) -> None:
        self.spread = np.full(len(grad), 1e-3) if self.spread is None else 0.99 * self.spread + 0.01 * grad * grad
        self.steps += 1
        weights.set(weights.flat() + self.rate / (1 + self.steps / 200) * grad / (np.sqrt(self.spread) + 1e-3))

    @staticmethod
    def inside(mixer: Mixer, place: np.ndarray) -> np.ndarray:
        w = mixer.weights.inside[mixer.gate[place]]
        return w[:, INSIDE] + sum(w[:, k] * mixer.odds[k][place] for k in range(INSIDE)) * np.float32(0.25)

    def learn(self, mixer: Mixer, place: np.ndarray, x: np.ndarray, seen, error: np.ndarray) -> None:
        gate, n = mixer.gate[place], max(1, len(place))
        inside = [np.bincount(gate, error * mixer.odds[k][place] * 0.25, GATES) for k in range(INSIDE)] + [np.bincount(gate, error, GATES)]
        across = [np.bincount(v & 3, error * ((v.view(np.int8) >> 2) * 0.25), 4) for v in seen]
        sure = np.sign(x[INPUTS - 1])
        self._step(mixer.weights, np.concatenate([np.stack(inside, axis=1).ravel(), *across, [(error * sure).sum()]]) / n)
        mixer.refresh_across()

    def behind(self, mixer: Mixer, weight: np.ndarray, turns: int = 12) -> None:
        """First weights of the gates behind the heads, by Newton steps on the words of the texts, ``weight`` times each, and the contexts inside words."""
        s = mixer.spelling
        of = np.repeat(weight, s.count)
        for g in range(GATES // 2, GATES):
            k = np.flatnonzero(mixer.gate == g)
            x = np.stack([mixer.odds[c][k] * 0.25 for c in range(INSIDE)] + [np.ones(len(k))], axis=1)
            w, start = mixer.weights.inside[g].astype(float), mixer.weights.inside[g].astype(float)
            for _ in range(turns):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -20, 20)))
                grad = x.T @ (of[k] * (s.bit[k] - p)) - 20 * (w - start)
                w += np.linalg.solve((x * (of[k] * p * (1 - p))[:, None]).T @ x + 20 * np.eye(len(w)), grad)
            mixer.weights.inside[g] = w


def _count_words(batches):
    """Words of training texts with their counts, summed over each task's batches."""
    from collections import Counter as Counts

    import pyarrow as pa

    hashes, held = WordHashes(), Counts()

    def flush():
        words = list(held)
        return pa.record_batch([pa.array(hashes.of(words).view(np.int64)), pa.array(words, pa.binary()), pa.array(list(held.values()), pa.int64())], names=["h", "word", "c"])

    for batch in slices(batches, 1000):
        for text in text_bytes(batch, "text"):
            held.update(words_of(text))
            held[_END] += 1
        if len(held) > 300_000:
            yield flush()
            held = Counts()
    if held:
        yield flush()


def _count_bytes(batches):
    """How often each byte is written: of the words, a space after each."""
    import pyarrow as pa

    total = np.zeros(256, np.int64)
    for batch in slices(batches, 20_000):
        words, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy()
        s = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        own = np.fromiter(map(len, words), np.int64, len(words)) + 1
        total += np.bincount(s, np.repeat(counts, own), 256).astype(np.int64) if len(words) else 0
    yield pa.record_batch([pa.array(range(256), pa.int32()), pa.array(total)], names=["byte", "n"])


#: Slots of one row of a count table on its way, and tables that are summed at once.
_PIECE, _FAN_IN = 1 << 18, 32


def _count_contexts(held):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        code, slot_bits, frequent = held.value
        counter, texts, size = None, [], 0
        for batch in slices(batches, 500):
            counter = counter or Counter(code, slot_bits, frequent)
            for text in text_bytes(batch, "text"):
                texts.append(text)
                size += len(text)
                if len(texts) >= _TEXTS or size >= BLOCK_BYTES:
                    counter.add(texts)
                    texts, size = [], 0
        if texts:
            counter.add(texts)
        if counter is not None:
            task = TaskContext.get().partitionId()
            for k in range(CONTEXTS):
                for piece, i in enumerate(range(0, counter.counts.shape[1], 2 * _PIECE)):
                    raw = zlib.compress(counter.counts[k, i : i + 2 * _PIECE].tobytes(), 1)
                    yield pa.record_batch([pa.array([k], pa.int32()), pa.array([piece], pa.int32()), pa.array([task], pa.int64()), pa.array([raw], pa.binary())], names=["context", "piece", "task", "counts"])

    return run


def _sum_counts(table):
    import pyarrow as pa

    total = 0
    for part in table.column("counts"):
        total = total + np.frombuffer(zlib.decompress(part.as_py()), np.uint16).astype(np.uint32)
    raw = zlib.compress(np.minimum(total, 65535).astype(np.uint16).tobytes(), 1)
    first = lambda c: table.column(c)[0].as_py()
    return pa.table([pa.array([first("context")], pa.int32()), pa.array([first("piece")], pa.int32()), pa.array([first("task")], pa.int64()), pa.array([raw], pa.binary())], names=["context", "piece", "task", "counts"])


def _learn_weights(held):
    """Weights learned on the texts of a task, and on how many bits."""

    def run(batches):
        import pyarrow as pa

        code, slot_bits, frequent, tables = held.value
        mixer, learner, texts = Mixer(code, slot_bits, frequent, tables), Learner(), []

        def learn():
            index, places = indexed(texts)
            mixer.spell([*index, _END])
            weight = np.zeros(len(index) + 1)
            for own in places:
                weight += np.bincount(np.append(own, len(index)), minlength=len(weight))
            if not learner.steps:
                learner.behind(mixer, weight)
            for own in places:
                mixer.text(own, learner)
            return int((weight * mixer.spelling.count).sum())

        seen = 0
        for batch in slices(batches, 500):
            for text in text_bytes(batch, "text"):
                texts.append(text)
                if sum(map(len, texts)) >= BLOCK_BYTES:
                    seen += learn()
                    texts.clear()
        if texts:
            seen += learn()
        if seen:
            yield pa.record_batch([pa.array([mixer.weights.flat().tolist()], pa.list_(pa.float64())), pa.array([seen], pa.int64())], names=["weights", "bits"])

    return run


def _block_words(table):
    import pyarrow as pa

    hashes = WordHashes()
    h = {_END}
    for text in table.column("text"):
        h.update(words_of(text.as_py().encode()))
    h = hashes.of(list(h)).view(np.int64)
    return pa.table([pa.array(np.full(len(h), table.column("block")[0].as_py()), pa.int64()), pa.array(h)], names=["block", "h"])


def _score_block(held, n_train: int, v_train: int):
    def run(docs, counts):
        import pyarrow as pa

        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in _SCORE_TYPES()], names=_SCORE_NAMES)
        texts = docs.column("text").cast(pa.large_binary())
        index: dict[bytes, int] = {}
        ids, sizes = [], []
        for text in texts:
            ws = words_of(text.as_py())
            ids.append(np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int32, len(ws)))
            sizes.append(sum(map(len, ws)) + len(ws) + 1)
        mixer = held.value
        mixer.spell([*index, _END])
        known = counts.column("h").to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, count = known[order], np.zeros(len(mixer.h), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, mixer.h), len(known) - 1)
            count = np.where(known[at] == mixer.h, counts.column("c").to_numpy()[order][at], 0)
        base = np.log10((count + 1) / (n_train + v_train + 1))
        out = []
        for own, size in zip(ids, sizes, strict=True):
            bits = mixer.text(own)
            end = len(index)
            out.append((len(own) + 1, int((count[own] > 0).sum() + (count[end] > 0)), float(base[own].sum() + base[end]), -bits * float(np.log10(2)), bits / size))
        columns = [docs.column("doc_id"), *zip(*out, strict=True)]
        return pa.table([pa.array(x, t) if isinstance(x, tuple) else x.cast(t) for x, t in zip(columns, _SCORE_TYPES(), strict=True)], names=_SCORE_NAMES)

    return run


def _SCORE_TYPES():
    import pyarrow as pa

    return [pa.int64()] * 3 + [pa.float64()] * 3


_SCORE_NAMES = ["doc_id", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"]


def lm_scores(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Score every whole text by a model of the ``training`` texts.

    ``docs``: doc_id, text; ``training``: text. Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case,
    then one end. Returns doc_id, n_tokens, n_known (tokens that occur in training), train_tokens,
    base_score (add-one unigram, log10), score (the model's log10 probability), bits_per_byte (of the
    words, a space after each and the end).

    Word and byte counts cover all training texts; words are counted by task and summed by a shuffle. Context counts cover all
    but one in ``WEIGHTS_EVERY`` texts, chosen by hash, on which the mixing weights are learned, by task and averaged; both
    grow with the training texts. Tables have eight slots for a distinct word, at most 2 ** ``MOST_SLOTS`` for a context, since
    they are broadcast (one byte each); they are summed in a tree of bounded fan-in. Texts are dealt to blocks of about
    ``BLOCK_BYTES``; a block meets only the counts of its own words, so no vocabulary is broadcast.

    Null and empty texts have one token, the end. Null ids and repeated rows keep their rows. Without
    training texts every bit is as likely as not. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    training = training.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = training.mapInArrow(_count_words, "h long, word binary, c long")
    vocabulary = cut(counted.groupBy("h").agg(F.sum("c").alias("c"), F.min("word").alias("word")), "vocabulary")
    v_train, n_train = vocabulary.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    frequency = np.ones(256)
    for r in vocabulary.mapInArrow(_count_bytes, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        frequency[r.byte] += r.n
    top = vocabulary.where(F.octet_length("word") > 0).orderBy(F.desc("c"), "h").limit(FREQUENT).select("h").collect()
    frequent = np.sort(np.array([r.h for r in top], np.int64).view(np.uint64))
    code = prefix_code(frequency)
    slot_bits = int(np.clip(np.ceil(np.log2(max(1, 8 * v_train))), LEAST_SLOTS, MOST_SLOTS))

    for_weights = F.pmod(F.xxhash64("text"), F.lit(WEIGHTS_EVERY)) == 0
    parts = training.where(~for_weights).mapInArrow(_count_contexts(share((code, slot_bits, frequent))), _COUNTS)
    tasks = training.rdd.getNumPartitions()
    while True:
        tasks = -(-tasks // _FAN_IN)
        parts = parts.withColumn("task", F.floor(F.col("task") / _FAN_IN)).groupBy("context", "piece", "task").applyInArrow(_sum_counts, _COUNTS)
        if tasks <= 1:
            break
    counts = np.zeros((CONTEXTS, 2 << slot_bits), np.uint16)
    for r in parts.toLocalIterator():
        own = np.frombuffer(zlib.decompress(bytes(r.counts)), np.uint16)
        counts[r.context, r.piece * 2 * _PIECE : r.piece * 2 * _PIECE + len(own)] = own
    tables = tables_of(counts)
    del counts
    learned = training.where(for_weights).mapInArrow(_learn_weights(share((code, slot_bits, frequent, tables))), "weights array<double>, bits long")
    summed = learned.select("bits", F.posexplode("weights").alias("k", "w")).groupBy("k").agg((F.sum(F.col("w") * F.col("bits")) / F.sum("bits")).alias("w")).orderBy("k").collect()
    weights = Weights().set(np.array([r.w for r in summed])) if summed else Weights()
    held = share(Mixer(code, slot_bits, frequent, tables, weights))

    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    met = dealt.groupBy("block").applyInArrow(_block_words, "block long, h long").join(vocabulary.select("h", "c"), "h")
    scored = dealt.groupBy("block").cogroup(met.select("block", "h", "c").groupBy("block")).applyInArrow(
        _score_block(held, n_train, v_train), "doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
    )
    return scored.withColumn("train_tokens", F.lit(n_train).cast("long"))


_COUNTS = "context int, piece int, task long, counts binary"
