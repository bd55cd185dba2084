"""Quality rules with a hashed n-gram logistic regression.

A text's features are the relative frequencies of its words and of the byte
3-grams of its words, each hashed into half of the feature space.  The
regression is trained on a bounded sample of labelled rows and calibrated on
rows it hasn't seen.  Its logit is a mean over words of a sum that depends on
the word alone, so scoring looks up one number a word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulary.llm.common import held, in_slices

_BLANK = b" \t\n\x0b\x0c\r"                 # bytes.split() parts at these
_SYMBOLS = b"#*$%&|<>"
_SIZE = 1 << 14                             # features of words, and as many of 3-grams


def word_features(word: bytes) -> list[int]:
    """The word's feature and those of its 3-grams, ends marked."""
    marked = b"\x02" + word + b"\x03"
    return [zlib.crc32(word) % _SIZE, *(_SIZE + zlib.crc32(marked[i:i + 3]) % _SIZE for i in range(len(marked) - 2))]


def text_features(text: str) -> tuple[list[int], list[float]]:
    """Sparse features of a text, sorted."""
    words = text.encode().split()
    flat = [f for w in words for f in word_features(w)]
    index, count = np.unique(np.array(flat, np.int64), return_counts=True)
    return index.tolist(), (count / max(1, len(words))).tolist()


@dataclass(frozen=True)
class Model:
    weights: bytes                          # float64 of 2 * _SIZE features
    bias: float
    slope: float                            # calibration: sigmoid(slope * logit + shift)
    shift: float

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -500, 500)))


def fit(rows: list[tuple[list[int], list[float], int]], steps: int = 200, rate: float = 0.2,
        decay: float = 1e-4) -> Model:
    """Logistic regression by Adam on three quarters of the rows, calibrated
    on the last quarter.  Without both labels the prior alone is left."""
    labels = np.array([y for *_, y in rows], float)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(2 * _SIZE).tobytes(), 0.0, 0.0, 10.0 if not len(labels) or labels[0] else -10.0)
    fold = np.arange(len(rows)) % 4 == 3
    index = np.concatenate([np.array(i, np.int64) for i, _, _ in rows])
    value = np.concatenate([np.array(v, float) for _, v, _ in rows])
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _, _ in rows])
    own = ~fold[row]
    index_t, value_t, row_t = index[own], value[own], row[own]
    train = np.flatnonzero(~fold)
    weights, bias = np.zeros(2 * _SIZE), 0.0
    m, v, mb, vb = np.zeros(2 * _SIZE), np.zeros(2 * _SIZE), 0.0, 0.0
    share = labels[train].mean()
    balance = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) * ~fold
    for step in range(1, steps + 1):
        logit = np.bincount(row_t, weights[index_t] * value_t, len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - labels) * balance / len(train)
        grad = np.bincount(index_t, error[row_t] * value_t, 2 * _SIZE) + decay * weights
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.999 * vb + 0.001 * error.sum() ** 2
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        weights = weights - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    logit = np.bincount(row, weights[index] * value, len(rows)) + bias
    x, y = logit[fold], labels[fold]
    slope, shift = 1.0, 0.0
    if len(set(y.tolist())) == 2:           # Newton steps on the two numbers, a little damped
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -500, 500)))
            w = np.maximum(p * (1 - p), 1e-6)
            g = np.array([((p - y) * x).sum() + 1e-2 * (slope - 1), (p - y).sum() + 1e-2 * shift])
            h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
            d = np.linalg.solve(h, g)
            d *= min(1.0, 2 / max(1e-9, float(np.abs(d).max())))
            slope, shift = slope - d[0], shift - d[1]
            if np.abs(d).max() < 1e-9:
                break
    return Model(weights.tobytes(), float(bias), float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 3000) -> Model:
    """Fit on the labelled documents of least hash, ``most_rows`` at most.

    Features are made in the tasks; the driver gets at most most_rows sparse
    rows of at most 2**15 features.  Rows without a label or a word are left out.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL") \
        .groupBy("doc_id").agg(F.max("quality").alias("quality")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id") \
        .where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]")).select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, part in in_slices(batch):
                index, value = zip(*map(text_features, texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("quality").cast(pa.int64()),
                     pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                    ["doc_id", "quality", "i", "v"])

    rows = chosen.mapInArrow(run, "doc_id long, quality long, i array<int>, v array<float>") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "i").collect()
    return fit([(r.i, r.v, r.quality) for r in rows])


class _WordScores(dict):
    """The logit's part of each word."""

    def __init__(self, model: Model, most: int = 600_000):
        super().__init__()
        self._weights, self._most = np.frombuffer(model.weights).tolist(), most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self._most:
            self.clear()
        weights = self._weights
        score = self[word] = sum([weights[f] for f in word_features(word)])
        return score


def _scores(model: Model) -> _WordScores:
    return held(("scores", model), lambda: _WordScores(model))


def repeated_words(words: list[list[bytes]], ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, the words in 3-word windows that it has twice or more;
    and all texts' word numbers."""
    lengths = np.array(list(map(len, words)), np.int64)
    get = ids.__getitem__
    flat = np.fromiter((i for w in words for i in map(get, w)), np.int64, int(lengths.sum()))
    of = np.repeat(np.arange(len(words)), lengths)
    if len(flat) < 3:
        return np.zeros(len(words), np.int64), flat
    inside = np.flatnonzero(of[2:] == of[:-2])
    keys = (flat[inside + 2], flat[inside + 1], flat[inside], of[inside])
    if len(ids) < 1 << 21:                  # three numbers fit into one
        keys = (keys[2] << 42 | keys[1] << 21 | keys[0], keys[3])
    order = np.lexsort(keys)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    starts = inside[order[again]]
    mark = np.zeros(len(flat), bool)
    for k in range(3):
        mark[starts + k] = True
    return np.bincount(of[mark], minlength=len(words)), flat


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_BLANK.decode())]
    return len(lines) - len(set(lines))


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")


def judge(docs: DataFrame, model: Model, least_words: int = 50, most_repeated: int = 50,
          threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, the calibrated probability of
    quality, and kept: not base_failed and a probability of at least ``threshold``.

    Words are runs of other characters than ASCII white space.  A null text
    has none and fails; repeated rows give repeated results; only doc_id and
    text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(model)
        for batch in batches:
            for texts, part in in_slices(batch):
                raw = [t.encode() for t in texts]
                words = [r.split() for r in raw]
                ids = {w: k for k, w in enumerate(set().union(*words))}
                per_word = np.array([scores[w] for w in ids] or [0.0])
                n = np.array(list(map(len, words)), np.int64)
                repeat, flat = repeated_words(words, ids)
                total = np.bincount(np.repeat(np.arange(len(words)), n), per_word[flat], len(words))
                chance = model.probability(total / np.maximum(n, 1) + model.bias)
                failed = (n < least_words) | (100 * repeat > most_repeated * n)
                chars = [len(t) - len(r) + len(r.translate(None, _BLANK)) for t, r in zip(texts, raw, strict=True)]
                symbols = [len(r) - len(r.translate(None, _SYMBOLS)) for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
                     pa.array(list(map(duplicate_lines, texts)), pa.int64()), pa.array(repeat.astype(np.int64)),
                     pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= threshold))],
                    [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
