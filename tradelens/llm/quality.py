"""Quality by compression: two zstandard dictionaries, and a calibrated score from how much better one compresses."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.common import labelled_sample, slices, text_bytes

#: Labelled rows used for fitting, at most, of each label; those of least hash of the id are taken.
FIT_ROWS = 3000
#: Dictionaries are trained on samples of so many bytes, about eight from each text, spread over it.
SAMPLE = 1024
#: Bytes that are compressed at once; a text is the sum of its blocks.
BLOCK = 4096
DICTIONARY = 64 << 10
LEVEL = 3


def _blocks(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


class CompressionClassifier:
    """Two dictionaries and the coefficients of a logistic calibration."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray):
        self.good, self.bad, self.weights = good, bad, weights
        self._ready = None

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "weights": self.weights, "_ready": None}

    def _compressors(self):
        import zstandard as zstd

        if self._ready is None:
            plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            own = []
            for raw in (self.good, self.bad):
                d = zstd.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                own.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, **plain))
            self._ready = own
        return self._ready

    def features(self, text: bytes | None) -> np.ndarray:
        """1, the normalised difference of the compressed sizes, and the log of the smaller size per byte.

        The difference carries the score; how far it must go depends on how well the text compresses at all (junk of
        repeated words leaves either dictionary little to do), which the last term calibrates.
        """
        text = text or b""
        good, bad = self._compressors()
        g = b = 0
        for block in _blocks(text, BLOCK):
            g += len(good.compress(block))
            b += len(bad.compress(block))
        n = len(text) + 16.0
        diff = (b - g) / max(g, b, 1)
        return np.array([1.0, diff, np.log(max(1, min(g, b)) / n)])

    def score(self, text: bytes | None) -> float:
        """Probability of label 1."""
        z = float(self.features(text) @ self.weights)
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> CompressionClassifier:
    """Fit on documents (doc_id, text) with labels (doc_id, label 0 or 1): at most ``rows`` of each label, those of least hash.

    Half of the rows build the dictionaries, the other half the calibration, so that no text is compressed
    with a dictionary that has seen it; the calibration is weighted back to the labels' true shares. With one label missing or
    too little text, the score is the share of label 1.
    """
    import zstandard as zstd

    texts, counts = labelled_sample(docs, labels, {0: rows, 1: rows})
    share = (counts[1] + 1) / (sum(counts.values()) + 2)
    flat = CompressionClassifier(b"\0" * 8, b"\0" * 8, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    taken = {label: [t.encode() for t in own] for label, own in texts.items()}
    if not taken[0] or not taken[1]:
        return flat
    dictionaries = []
    for label in (1, 0):
        samples = [t[i : i + SAMPLE] for t in taken[label][::2] for i in range(0, len(t), max(SAMPLE, len(t) // 8))]
        size = min(DICTIONARY, sum(map(len, samples)) // 10)
        try:
            dictionaries.append(zstd.train_dictionary(size, samples).as_bytes())
        except (zstd.ZstdError, ValueError):
            if sum(map(len, samples)) < 64:
                return flat
            dictionaries.append(b"".join(samples)[-DICTIONARY:])
    model = CompressionClassifier(*dictionaries, np.zeros(3))
    x, y, weight = [], [], []
    for label in (0, 1):
        held = taken[label][1::2] or taken[label]
        for text in held:
            x.append(model.features(text)), y.append(label), weight.append(counts[label] / len(held))
    weight = np.array(weight)
    model.weights = _logistic(np.array(x), np.array(y, float), weight / weight.sum() * len(weight))
    return model


def _score(model):
    def run(batches):
        import pyarrow as pa

        own = model.value
        for batch in slices(batches, 1000):
            scores = [own.score(t) for t in text_bytes(batch, "text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, model: CompressionClassifier) -> DataFrame:
    """doc_id and score (0 to 1, higher: good) of every whole text.

    Null texts count as empty; an empty text gets the score of its features like any other. Rows are only
    mapped: null ids and repeated rows keep their rows, an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_score(held), "doc_id long, score double")


def _accept(model, threshold: float):
    def run(batches):
        import pyarrow as pa

        own = model.value
        for batch in slices(batches, 1000):
            yield batch.filter(pa.array([own.score(t) >= threshold for t in text_bytes(batch, "text")], pa.bool_()))

    return run


def quality_mask(docs: DataFrame, model: CompressionClassifier, threshold: float) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns; nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accept(held, threshold), docs.schema)
