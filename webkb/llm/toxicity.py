"""Toxicity by compression distance with zstandard dictionaries.

One dictionary is trained on toxic text, one on ordinary text. A window that
compresses shorter with the toxic dictionary resembles toxic text. Every
window of the whole document is compressed with both; the largest gains, the
mean gain and the number of windows are calibrated into one score, shifted so
that 0.5 is the threshold that tells the two labels apart best.

Most of a toxic document reads like any other, so each dictionary is trained
on what sets its side apart: the runs of bytes whose ``GRAM``-byte grams occur
in ``TIMES`` times as many of its sample's texts as of the other side's. Both are followed by the same base, trained on all
of the ordinary sample, which explains common text alike on both sides and so
keeps it out of the difference.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import fold, text_column, utf8
from webkb.llm.labelled import sample

#: Bytes of a window, and from one window's start to the next.
WINDOW, STRIDE = 96, 72
#: Bytes of a side's own dictionary and of the base that both share.
OWN, BASE = 2048, 16384
GRAM = 5
#: How much more frequent a gram must be among a side's texts to belong to it.
TIMES = 3


def windows(text: bytes) -> list[bytes]:
    """Overlapping windows that cover the whole text; one empty window of an empty text."""
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - (WINDOW - STRIDE)), STRIDE)]


def grams(texts: list[bytes]) -> Counter:
    """In how many of the texts each gram occurs."""
    out: Counter = Counter()
    for t in texts:
        out.update({t[i:i + GRAM] for i in range(len(t) - GRAM + 1)})
    return out


def apart(text: bytes, wanted: set[bytes]) -> list[bytes]:
    """The runs of ``text`` that ``wanted`` grams cover, with a byte on either side."""
    keep = np.zeros(len(text) + 2, np.int64)
    for i in range(len(text) - GRAM + 1):
        if text[i:i + GRAM] in wanted:
            keep[max(0, i - 1)] += 1
            keep[min(len(text), i + GRAM + 1)] -= 1
    inside = np.concatenate([[False], np.cumsum(keep[:len(text)]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


def _dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """Content of a trained dictionary (its last bytes; the tables before it
    are left out, as both sides share one base); the samples themselves where
    they are too few to train on."""
    try:
        return zstandard.train_dictionary(size + 1000, samples, k=segment, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(dictionary: bytes):
    settings = zstandard.ZstdCompressionParameters(
        window_log=16, chain_log=14, hash_log=14, search_log=4, min_match=4, target_length=8,
        strategy=zstandard.STRATEGY_LAZY2, write_checksum=False, write_content_size=False, write_dict_id=False)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings).compress


def _features(gains: list[int]) -> list[float]:
    top = sorted(gains, reverse=True)[:3]
    top += [0] * (3 - len(top))
    return [top[0], top[1], top[2], sum(gains) / len(gains), float(np.log1p(len(gains)))]


@dataclass
class Model:
    """Dictionaries as bytes and the calibration; compressors are made where it is used."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def features(self):
        with_toxic, with_ordinary = _compressor(self.toxic), _compressor(self.ordinary)

        def of(text: bytes) -> list[float]:
            return _features([len(with_ordinary(w)) - len(with_toxic(w)) for w in windows(text)])

        return of

    def scorer(self):
        features = self.features()

        def score(text: bytes) -> float:
            x = np.append((np.array(features(text)) - self.mean) / self.scale, 1.0)
            return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))

        return score


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps on the ridge logistic loss; the last column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _dictionaries(part: dict[int, list[bytes]]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary of the texts of label 1 and 0."""
    known = {v: grams(part[v]) for v in part}
    own = {}
    for v in part:
        scale = TIMES * len(part[v]) / (len(part[1 - v]) + 1)
        wanted = {g for g, n in known[v].items() if n > 1 and n >= scale * (known[1 - v][g] + 1)}
        own[v] = _dictionary([r for t in part[v] for r in apart(t, wanted)], OWN, 10)
    base = _dictionary(part[0], BASE, 32)
    return own[1] + base, own[0] + base


def train(texts: list[bytes], labels: list[int], odds: float = 1.0, parts: int = 3) -> Model:
    """Dictionaries from all texts; the calibration from each text's gains
    under dictionaries that were trained without its part of the texts."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        bias = 0.0 if not len(y) else 1.0 if y[0] else -1.0
        return Model(b"toxic" * 9, b"ordinary" * 9, np.zeros(5), np.ones(5), np.array([0, 0, 0, 0, 0, bias]))
    part = {v: [t for t, label in zip(texts, y) if label == v] for v in (0, 1)}
    model = Model(*_dictionaries(part), np.zeros(5), np.ones(5), np.zeros(6))
    x, z = [], []
    for k in range(parts):
        rest = {v: [t for i, t in enumerate(p) if i % parts != k] or p for v, p in part.items()}
        features = Model(*_dictionaries(rest), model.mean, model.scale, model.weights).features()
        for v, p in part.items():
            x += [features(t) for t in p[k::parts]]
            z += [v] * len(p[k::parts])
    x, z = np.array(x), np.array(z, float)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(z == 1, odds / (1 + odds) / z.mean(), 1 / (1 + odds) / (1 - z.mean()))
    x = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    model.weights = _logistic(x, z, weight)
    model.weights[-1] -= _threshold(x @ model.weights, z, weight)
    return model


def _threshold(logits: np.ndarray, z: np.ndarray, weight: np.ndarray) -> float:
    """The logit at which precision and recall of label 1 are best together (F1)."""
    order = np.argsort(-logits, kind="stable")
    hits, all_ones = np.cumsum((weight * z)[order]), (weight * z).sum()
    best = int(np.argmax(2 * hits / (np.cumsum(weight[order]) + all_ones)))
    after = logits[order[best + 1]] if best + 1 < len(order) else logits[order[best]] - 1
    return float((logits[order[best]] + after) / 2)


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, rows: int = 1000, most_bytes: int = 16_384) -> Model:
    """Model fitted on at most ``rows`` documents of each label, none longer
    than ``most_bytes``. Scoring has no such bounds."""
    chosen, odds = sample(docs, labels, "toxic", train_rows, rows, most_bytes)
    return train(list(chosen["text"]), list(chosen["label"]), odds)


def scores(model: Model):
    """The probability of label 1 as a column of ``text``."""

    def make():
        score = model.scorer()
        return lambda text: score(utf8(text))

    return text_column("double", make)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5,
                    test_fold: int = 0, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out, score,
    predicted``. Labels are learned from the folds that are not held out.

    A NULL text is scored as the empty text; a NULL doc_id is scored like any
    other. Without labels of both kinds every text gets the same score. An
    empty table gives an empty result.
    """
    model = fit(docs, labels, fold(F.col("doc_id"), folds) != test_fold, **settings)
    return docs.select("doc_id", (fold(F.col("doc_id"), folds) == test_fold).alias("held_out"),
                       scores(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
