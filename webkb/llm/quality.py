"""Quality classifier: a byte-level convolutional network in numpy.

Filters over ``WIDTH`` consecutive bytes run along every position of the whole
document, which is read in overlapping chunks (each chunk repeats the
``WIDTH - 1`` bytes before it, so no position is missed or seen twice). Each
filter is max-pooled over all chunks; dense layers combine the pooled responses
and the length they were pooled over into one probability. A filter is a table of a weight per place and
byte value, that is, a convolution over one-hot bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import fold, text_column, utf8
from webkb.llm.labelled import sample

WIDTH = 8
FILTERS = 8
HIDDEN = 8
#: Positions convolved at once: the buffers stay in the processor's cache.
CHUNK = 1 << 14


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    hidden: np.ndarray  # (FILTERS + 1, HIDDEN)
    hidden_bias: np.ndarray  # (HIDDEN,)
    dense: np.ndarray  # (HIDDEN,)
    offset: np.ndarray  # (1,)

    @classmethod
    def random(cls, rng: np.random.Generator) -> Network:
        draw = [rng.normal(0, s, d).astype(np.float32) for s, d in
                ((0.3, (WIDTH, 256, FILTERS)), (0.5, (FILTERS + 1, HIDDEN)), (0.5, HIDDEN))]
        return cls(draw[0], np.full(FILTERS, -1, np.float32), draw[1], np.zeros(HIDDEN, np.float32), draw[2],
                   np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.dense, self.offset]

    def pooled(self, text: bytes, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter over the document, and its place.

        A document shorter than a filter is padded with zero bytes.
        """
        data = np.frombuffer(text + bytes(max(0, WIDTH - len(text))), np.uint8)
        size = min(CHUNK, len(data) - WIDTH + 1)
        total, part = np.empty((2, size, FILTERS), np.float32)
        best, at = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS, np.int64)
        for start in range(0, len(data) - WIDTH + 1, CHUNK):
            chunk = data[start:start + CHUNK + WIDTH - 1].astype(np.intp)
            n = len(chunk) - WIDTH + 1
            np.take(self.filters[0], chunk[:n], axis=0, out=total[:n], mode="clip")
            for k in range(1, WIDTH):
                np.take(self.filters[k], chunk[k:k + n], axis=0, out=part[:n], mode="clip")
                np.add(total[:n], part[:n], out=total[:n])
            top = total[:n].max(axis=0)
            if where:
                at = np.where(top > best, start + total[:n].argmax(axis=0), at)
            best = np.maximum(best, top)
        return best, at if where else None

    def combine(self, best: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Dense layers over the pooled responses and the length they were pooled over."""
        seen = np.append(np.tanh(best + self.bias), np.log1p(n) / 5 - 1)
        inner = np.tanh(seen @ self.hidden + self.hidden_bias)
        logit = float(inner @ self.dense + self.offset[0])
        return seen, inner, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def score(self, text: bytes) -> float:
        return float(self.combine(self.pooled(text)[0], len(text))[2])


def train(texts: list[bytes], labels: list[int], odds: float = 1.0, epochs: int = 10, rate: float = 0.02,
          seed: int = 42) -> Network:
    """Adam on the logistic loss with both labels weighed alike; ``odds`` of
    label 1 are put back at the end. The gradient of a max runs to the bytes
    at the largest response alone."""
    rng = np.random.default_rng(seed)
    net = Network.random(rng)
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        # nothing to tell apart: the same for every text
        net.dense[:] = 0
        net.offset[:] = 0.0 if not len(y) else 1.0 if y[0] else -1.0
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    params = net.parameters()
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step, places = 0, np.arange(WIDTH)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for batch in np.array_split(order, max(1, len(order) // 32)):
            grads = [np.zeros_like(p) for p in params]
            for i in batch:
                best, at = net.pooled(texts[i], where=True)
                seen, inner, p = net.combine(best, len(texts[i]))
                slope = weight[i] * (p - y[i]) / len(batch)
                inward = slope * net.dense * (1 - inner ** 2)
                back = (net.hidden @ inward)[:FILTERS] * (1 - seen[:FILTERS] ** 2)
                padded = texts[i] + bytes(max(0, WIDTH - len(texts[i])))
                for f in range(FILTERS):
                    grads[0][places, list(padded[at[f]:at[f] + WIDTH]), f] += back[f]
                for g, change in zip(grads[1:], (back, np.outer(seen, inward), inward, slope * inner, slope)):
                    g += change
            step += 1
            pace = rate * (1 if epoch < epochs * 2 // 3 else 0.3)
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.offset += np.float32(np.log(odds))
    return net


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, rows: int = 1500, most_bytes: int = 16_384) -> Network:
    """Network fitted on at most ``rows`` documents of each label, none longer
    than ``most_bytes``. Scoring has no such bounds."""
    chosen, odds = sample(docs, labels, "quality", train_rows, rows, most_bytes)
    return train(list(chosen["text"]), list(chosen["label"]), odds)


def scores(net: Network):
    """The probability of label 1 as a column of ``text``."""

    return text_column("double", lambda: lambda text: net.score(utf8(text)))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 4,
                    test_fold: int = 2, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out, score,
    predicted``. Labels are learned from the folds that are not held out.

    A NULL text is scored as the empty text; a NULL doc_id is scored like any
    other. Without labels of both kinds every text gets the same score. An empty table gives an empty result.
    """
    net = fit(docs, labels, fold(F.col("doc_id"), folds) != test_fold, **settings)
    return docs.select("doc_id", (fold(F.col("doc_id"), folds) == test_fold).alias("held_out"),
                       scores(net).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 4,
              test_fold: int = 2, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    net = fit(docs, labels, fold(F.col("doc_id"), folds) != test_fold, **settings)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*names, scores(net).alias("__score")).filter(F.col("__score") >= threshold).select(*names)
