"""Quality classifier: a linear support vector machine on naive-Bayes-scaled n-gram indicators."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import linear

THRESHOLD = 0.3
# Letters of a token's shape, so that n-grams speak of form as well as of words.
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")
LEVELS = 7


def _shape(token: str) -> str:
    if token.isalpha():
        if token.isupper() and len(token) > 1:
            return "A"
        return "Aa" if token[0].isupper() else "a"
    return "0" if token.isdigit() else token[:4]


def features(text: str) -> np.ndarray:
    """Hashed indicators of a text's n-grams.

    One- and two-grams of token shapes and of repetition (a token equal to the one before,
    a line or a word seen earlier) are told apart by how much of the text they make up:
    level j says at least 2**-j of it. Words are plain indicators.
    """
    tokens = _TOKEN.findall(text)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    shapes: dict[str, str] = {}
    for t in set(tokens):
        shapes[t] = _shape(t)
    seq = [shapes[t] for t in tokens]
    counts = Counter(seq)
    counts.update(zip(seq, seq[1:], strict=False))
    grams = {k: v / len(seq) for k, v in counts.items()}
    if words:
        grams["twice"] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
        grams["seen word"] = 1 - len(set(words)) / len(words)
        grams["seen line"] = 1 - len(set(lines)) / len(lines)
    found = set()
    for gram, share in grams.items():
        if share > 0:
            least = min(LEVELS, max(0, int(np.ceil(-np.log2(share)))))
            name = gram if isinstance(gram, str) else "\x00".join(gram)
            found.update(f"{name}\x01{j}" for j in range(least, LEVELS + 1))
    ids = {linear.bucket(f) for f in found}
    ids.update(linear.bucket("w\x02" + w.lower()) for w in {t for t in tokens if t.isalpha()})
    return np.fromiter(sorted(ids), np.int32, len(ids))


def class_ratio(rows: list[np.ndarray], y: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of each feature's share of the class counts."""
    total = [np.full(linear.SIZE, smoothing) for _ in range(2)]
    for k in (0, 1):
        own = [r for r, label in zip(rows, y, strict=True) if label == k]
        if own:
            total[k] += np.bincount(np.concatenate(own), minlength=linear.SIZE)
    return np.log(total[1] / total[1].sum()) - np.log(total[0] / total[0].sum())


def dual_descent(
    rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, *, cost: float = 0.02, epochs: int = 15, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss machine over features of value ``scale``.

    Dual coordinate descent: one multiplier per row, kept in [0, cost * class weight], each
    visit solving its one-variable problem exactly. The two classes weigh the same in all.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    share = np.bincount(y, minlength=2)
    top = cost * len(y) / (2.0 * np.maximum(share, 1))[y]
    norms = np.array([np.square(scale[r]).sum() + 1.0 for r in rows])
    alpha = np.zeros(len(rows))
    w, b = np.zeros(len(scale)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = scale[r]
            gradient = sign[i] * (w[r] @ x + b) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), top[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[r] += step * sign[i] * x
                b += step * sign[i]
                worst = max(worst, abs(step) / top[i])
        if worst < 1e-3:
            break
    return w, b


def fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(weight per feature, bias, slope) so that sigmoid(slope-scaled sum) is a probability of label 1.

    Without rows of both classes every text gets the smoothed share of label 1.
    """
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return np.zeros(linear.SIZE), float(np.log(share / (1 - share))), 1.0
    # Margins for the calibration come from machines that have not seen the row.
    fold = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for k in range(3):
        own = [rows[i] for i in np.flatnonzero(fold != k)]
        seen = y[fold != k]
        if len(set(seen.tolist())) < 2:
            continue
        ratio = class_ratio(own, seen)
        w, b = dual_descent(own, seen, ratio)
        w *= ratio
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]].sum() + b
    slope, shift = linear.calibration(margins, y)
    ratio = class_ratio(rows, y)
    w, b = dual_descent(rows, y, ratio)
    return slope * ratio * w, slope * b + shift, slope


def train(docs: DataFrame, labels: DataFrame, max_rows: int = linear.MAX_FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias learned from at most ``max_rows`` labelled documents."""
    rows, y = linear.fit_rows(linear.training_texts(docs, labels, "quality", max_rows), features)
    weights, bias, _ = fit(rows, y)
    return weights, bias


def scorer(spark: SparkSession, model: tuple[np.ndarray, float]) -> Callable[[str], float]:
    """What gives a text its score, the probability of good quality; the model is sent to the tasks once."""
    # One number per hash bucket, whatever the corpus.
    shared = spark.sparkContext.broadcast(model)

    def of(text: str) -> float:
        weights, bias = shared.value
        return float(linear.sigmoid(weights[features(text)].sum() + bias))

    return of


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every row."""
    return linear.score(docs, scorer(docs.sparkSession, model))
