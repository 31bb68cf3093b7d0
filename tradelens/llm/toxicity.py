"""Toxicity by a bidirectional gated recurrent network with attention pooling over character and word inputs."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import labelled_sample, mix, slices

#: Labelled rows used for fitting, at most, with label 1 and with label 0; those of least hash of the id are taken.
FIT_TOXIC, FIT_CLEAN = 2500, 3500
WINDOW, STRIDE = 32, 16
HIDDEN = 8
ATTENTION = 8
GRAMS = (3, 4, 5)
TABLE_BITS = 19
INPUTS = 2 + 2 * len(GRAMS)
EPOCHS, BATCH, RATE = 6, 64, 0.03
#: Documents of a label in which a word or run of characters must occur to count.
LEAST_DOCS = 4
_WORDS = re.compile(r"[^\W_]+")
_CACHE = 300_000


def words_in(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def _grams(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start of each word in the joined ``<word>`` characters, and for each run length the table slot at every position (-1 across words)."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    room = np.repeat(starts + lengths, lengths) - np.arange(len(chars))
    slots = []
    for n in GRAMS:
        h = np.full(len(chars), n, np.uint64)
        for k in range(n):
            h[: len(chars) - k] = h[: len(chars) - k] * np.uint64(0x100000001B3) + chars[k:]
        slot = (mix(h) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        slot[room < n] = -1
        slots.append(slot)
    return starts, slots


def _word_slots(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) >> (64 - TABLE_BITS) for w in words), np.int64, len(words))


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """How much likelier a slot is in a toxic document; 0 where it is rare or not likelier."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    odds *= toxic / (toxic + 4.0)
    odds[toxic < LEAST_DOCS] = 0
    return np.maximum(odds, 0).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class ToxicityNet:
    """Input tables, recurrent layers, attention and calibration. Character and word inputs are evidence tables
    counted on the labelled texts; the network learns what runs of them mean."""

    def __init__(self, word_table: np.ndarray, gram_tables: list[np.ndarray], seed: int = 3):
        self.word_table, self.gram_tables = word_table, gram_tables
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * (0.5 / np.sqrt(s[0]))).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p[f"W{d}"], self.p[f"U{d}"], self.p[f"c{d}"] = draw(INPUTS, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN), np.zeros(3 * HIDDEN, np.float32)
        self.p["A"], self.p["v"] = draw(2 * HIDDEN, ATTENTION), draw(ATTENTION, 1)
        self.p["o"], self.p["k"] = draw(2 * HIDDEN, 1), np.zeros(1, np.float32)
        self.scale = np.array([1.0, 0.0])

    def inputs(self, words: list[str]) -> np.ndarray:
        """Inputs of distinct words: the word's evidence, its length, and the largest and mean evidence of its character runs."""
        x = np.zeros((len(words), INPUTS), np.float32)
        if not words:
            return x
        x[:, 0] = self.word_table[_word_slots(words)]
        x[:, 1] = np.minimum([len(w) for w in words], 20) / np.float32(20)
        starts, slots = _grams(words)
        for k, (table, slot) in enumerate(zip(self.gram_tables, slots, strict=True)):
            value = np.where(slot < 0, 0, table[slot])
            count = np.maximum(np.add.reduceat(slot >= 0, starts, dtype=np.int64), 1)
            x[:, 2 + 2 * k] = np.maximum.reduceat(value, starts)
            x[:, 3 + 2 * k] = np.add.reduceat(value, starts) / count
        return x

    # forward and backward over windows: rows of WINDOW word positions, ``mask`` marks the real ones

    def _run(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (time, window, HIDDEN) of one direction from input gates (time, window, 3 * HIDDEN)."""
        steps, n, _ = gates.shape
        u, h = self.p[f"U{d}"], np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = 2 * _sigmoid(2 * (gates[t, :, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])) - 1
            new = h + mask[t][:, None] * z * (c - h)
            if keep is not None:
                keep.append((t, h, z, r, c))
            out[t] = h = new
        return out

    def _head(self, states: np.ndarray, mask: np.ndarray):
        a = np.tanh(states @ self.p["A"])
        e = (a @ self.p["v"])[..., 0] + np.where(mask > 0, 0, -1e9).astype(np.float32)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = (e[..., None] * states).sum(axis=0)
        return a, e, pooled, (pooled @ self.p["o"])[:, 0] + self.p["k"][0]

    def gates_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]

    def logits(self, gates: tuple[np.ndarray, np.ndarray], at: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Logit of each window, given the input gates of the words and the word at each (time, window)."""
        both = [self._run(g[at], mask, d, None) for g, d in zip(gates, "fb", strict=True)]
        return self._head(np.concatenate(both, axis=2), mask)[3]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the log loss over windows with inputs x (time, window, INPUTS); toxic ones weigh three times."""
        p, g, kept, hidden = self.p, {}, {}, []
        for d in "fb":
            kept[d] = []
            hidden.append(self._run(x @ p[f"W{d}"] + p[f"c{d}"], mask, d, kept[d]))
        states = np.concatenate(hidden, axis=2)
        a, e, pooled, logit = self._head(states, mask)
        dl = ((_sigmoid(logit) - y) * np.where(y > 0, 3, 1) / len(y)).astype(np.float32)[:, None]
        g["o"], g["k"] = pooled.T @ dl, dl.sum(axis=0)
        dp = dl @ p["o"].T
        de = (states * dp).sum(axis=2)
        ds = e[..., None] * dp
        de = e * (de - (e * de).sum(axis=0))
        da = de[..., None] * p["v"][:, 0] * (1 - a * a)
        g["v"] = np.einsum("tna,tn->a", a, de)[:, None]
        g["A"] = np.einsum("tnh,tna->ha", states, da)
        ds = ds + da @ p["A"].T
        for k, d in enumerate("fb"):
            u, dw, du, dc = p[f"U{d}"], np.zeros_like(p[f"W{d}"]), np.zeros_like(p[f"U{d}"]), np.zeros_like(p[f"c{d}"])
            back = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, z, r, c in reversed(kept[d]):
                dh = back + ds[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                m = mask[t][:, None]
                gz = dh * m * (c - h) * z * (1 - z)
                gc = dh * m * z * (1 - c * c)
                drh = gc @ u[:, 2 * HIDDEN :].T
                gr = drh * h * r * (1 - r)
                gates = np.concatenate([gz, gr, gc], axis=1)
                dw += x[t].T @ gates
                dc += gates.sum(axis=0)
                du[:, : 2 * HIDDEN] += h.T @ gates[:, : 2 * HIDDEN]
                du[:, 2 * HIDDEN :] += (r * h).T @ gc
                back = dh * (1 - m * z) + drh * r + gates[:, : 2 * HIDDEN] @ u[:, : 2 * HIDDEN].T
            g[f"W{d}"], g[f"U{d}"], g[f"c{d}"] = dw, du, dc
        return g

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale[0] * np.asarray(logit, float) + self.scale[1])


def windows_of(n: int) -> list[int]:
    """Starts of the overlapping windows that cover ``n`` words; one empty window without words."""
    return list(range(0, max(1, n - STRIDE), STRIDE))


class Scorer:
    """Scores texts window by window; the input gates of words that come again are kept, up to a bound."""

    def __init__(self, net: ToxicityNet):
        self.net, self.index = net, {}
        self.gates = [np.zeros((1, 3 * HIDDEN), np.float32) for _ in "fb"]
        self._grow([])

    def _grow(self, words: list[str]) -> None:
        known = len(self.index)
        if known + len(words) + 1 > len(self.gates[0]):
            size = 1 << max(14, (known + len(words) + 1).bit_length())
            self.gates = [np.concatenate([g[: known + 1], np.empty((size - known - 1, 3 * HIDDEN), np.float32)]) for g in self.gates]
        if words:
            for own, new in zip(self.gates, self.net.gates_of(self.net.inputs(words)), strict=True):
                own[known + 1 : known + 1 + len(words)] = new
            self.index.update(zip(words, range(known + 1, known + 1 + len(words)), strict=True))

    def logits(self, texts: list[str | None]) -> list[np.ndarray]:
        """The logits of each text's windows."""
        words = [words_in(t) for t in texts]
        new = list({w for ws in words for w in ws}.difference(self.index))
        if len(self.index) + len(new) > _CACHE:
            self.index.clear()
            new = list({w for ws in words for w in ws})
        self._grow(new)
        get, rows, counts = self.index.__getitem__, [], []
        for ws in words:
            starts = windows_of(len(ws))
            ids = np.zeros(starts[-1] + WINDOW, np.int32)
            ids[: len(ws)] = np.fromiter(map(get, ws), np.int32, len(ws))
            rows.append(np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[::STRIDE][: len(starts)])
            counts.append(len(starts))
        at = np.concatenate(rows)
        out = np.empty(len(at), np.float32)
        for i in range(0, len(at), 4096):
            part = np.ascontiguousarray(at[i : i + 4096].T)
            out[i : i + 4096] = self.net.logits(self.gates, part, (part > 0).astype(np.float32))
        return np.split(out, np.cumsum(counts)[:-1])


def train_toxicity(toxic: list[str], clean: list[str], share: float, seed: int = 3) -> ToxicityNet:
    """Train on toxic and clean texts; ``share`` is the true share of toxic ones, for the calibration.

    A toxic text has a toxic passage somewhere: of each, the window with the most evidence is the first
    example, then the one that the network itself ranks highest. Of clean texts, random windows and the
    highest-ranked one are examples.
    """
    rng = np.random.default_rng(seed)
    counts = {}
    for label, texts in ((1, toxic), (0, clean)):
        word_docs, gram_docs = np.zeros(1 << TABLE_BITS), [np.zeros(1 << TABLE_BITS) for _ in GRAMS]
        for text in texts:
            words = list(set(words_in(text)))
            if words:
                word_docs[np.unique(_word_slots(words))] += 1
                for table, slot in zip(gram_docs, _grams(words)[1], strict=True):
                    table[np.unique(slot[slot >= 0])] += 1
        counts[label] = [word_docs, *gram_docs]
    word_table, *gram_tables = (_log_odds(t, c, len(toxic), len(clean)) for t, c in zip(counts[1], counts[0], strict=True))
    net = ToxicityNet(word_table, gram_tables, seed)
    if not toxic or not clean:
        net.scale = np.array([1e-3, np.log(share / (1 - share))])
        return net
    texts, labels = toxic + clean, np.array([1] * len(toxic) + [0] * len(clean))
    vocabulary: dict[str, int] = {}
    ids = [np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_in(t)), np.int32) for t in texts]
    x = np.concatenate([np.zeros((1, INPUTS), np.float32), net.inputs(list(vocabulary))])
    evidence = x[:, [0, *range(2, INPUTS, 2)]].max(axis=1)

    starts = [windows_of(len(own)) for own in ids]
    every = np.zeros((sum(map(len, starts)), WINDOW), np.int32)
    first = np.cumsum([0, *map(len, starts)])
    for k, own in enumerate(ids):
        padded = np.zeros(starts[k][-1] + WINDOW, np.int32)
        padded[: len(own)] = own
        every[first[k] : first[k + 1]] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE][: len(starts[k])]

    def highest(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The window of the largest value in each text, and that value."""
        order = np.lexsort((-value, np.repeat(np.arange(len(texts)), np.diff(first))))
        return order[first[:-1]], value[order[first[:-1]]]

    m, v, step = {k: 0.0 for k in net.p}, {k: 0.0 for k in net.p}, 0
    best, top = highest(evidence[every].max(axis=1))
    for epoch in range(EPOCHS):
        random = first[:-1] + (rng.random(len(texts)) * np.diff(first)).astype(np.int64)
        rows, y = np.concatenate([every[best], every[random[labels == 0]]]), np.concatenate([labels, np.zeros((labels == 0).sum(), int)]).astype(np.float32)
        for take in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            at = rows[take].T
            step += 1
            for name, grad in net.gradients(x[at], (at > 0).astype(np.float32), y[take]).items():
                m[name] = 0.9 * m[name] + 0.1 * grad
                v[name] = 0.999 * v[name] + 0.001 * grad * grad
                rate = RATE * (1 - epoch / EPOCHS)
                net.p[name] = (net.p[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
        gates = net.gates_of(x)
        z = np.concatenate([net.logits(gates, np.ascontiguousarray(every[i : i + 4096].T), (every[i : i + 4096].T > 0).astype(np.float32)) for i in range(0, len(every), 4096)])
        best, top = highest(z)
    weight = np.where(labels == 1, share / max(1, len(toxic)), (1 - share) / max(1, len(clean))) * len(labels)
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * top + b)
        grad = np.array([(weight * (p - labels) * top).sum() + 0.1 * (a - 1), (weight * (p - labels)).sum() + 0.1 * b])
        w = weight * p * (1 - p)
        hess = np.array([[(w * top * top).sum() + 0.1, (w * top).sum()], [(w * top).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(hess, grad)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    net.scale = np.array([max(a, 1e-3), b])
    return net


def fit_toxicity(docs: DataFrame, labels: DataFrame, n_toxic: int = FIT_TOXIC, n_clean: int = FIT_CLEAN) -> ToxicityNet:
    """Train on documents (doc_id, text) with labels (doc_id, label): at most ``n_toxic`` and ``n_clean`` rows, those of least hash.

    Rows without a label or text are left out. With no toxic or no clean row the evidence tables are empty
    and the score is about their share.
    """
    texts, counts = labelled_sample(docs, labels, {1: n_toxic, 0: n_clean})
    share = (counts[1] + 1) / (sum(counts.values()) + 2)
    return train_toxicity(texts[1], texts[0], share)


def _score(held):
    def run(batches):
        import pyarrow as pa

        scorer = Scorer(held.value)
        for batch in slices(batches, 200):
            if not batch.num_rows:
                continue
            parts = scorer.logits(batch.column("text").to_pylist())
            score = scorer.net.probability([z.max() for z in parts])
            at = [int(z.argmax()) * STRIDE for z in parts]
            yield pa.record_batch([batch.column("doc_id"), pa.array(score), pa.array([len(z) for z in parts], pa.int64()), pa.array(at, pa.int64())], names=["doc_id", "score", "n_windows", "worst_word"])

    return run


def toxicity_scores(docs: DataFrame, net: ToxicityNet) -> DataFrame:
    """doc_id, score (0 to 1: the most toxic window's), n_windows and worst_word (where that window starts) of every whole text.

    All overlapping windows are scored. A null, empty or wordless text has one empty window. Rows are only
    mapped: null ids and repeated rows keep their rows, an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_score(held), "doc_id long, score double, n_windows long, worst_word long")


def _reject(held, threshold: float):
    def run(batches):
        import pyarrow as pa

        scorer = Scorer(held.value)
        for batch in slices(batches, 200):
            if batch.num_rows:
                top = [z.max() for z in scorer.logits(batch.column("text").to_pylist())]
                yield batch.filter(pa.array(scorer.net.probability(top) < threshold))

    return run


def toxicity_mask(docs: DataFrame, net: ToxicityNet, threshold: float) -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns; nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(net)
    return docs.mapInArrow(_reject(held, threshold), docs.schema)
