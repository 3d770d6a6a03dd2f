"""Toxicity classifier whose scores do not depend on which group a text mentions.

A logistic model on words and word beginnings. For every labelled text that names a group,
the term is swapped for the others of its kind; the fit penalises the squared change of
the score over these swaps, so a group's name carries no weight of its own.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import linear

THRESHOLD = 0.5
SWAP_PENALTY = 10.0
RIDGE = 1e-4
# A feature takes part if it is in so many rows and tells the classes apart by this chi-square.
MIN_ROWS = 5
MIN_CHI2 = 12.0
PREFIXES = (3, 4, 5, 6)
# Terms of one kind are swapped for each other.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("immigrant", "refugee", "foreigner", "native", "citizen"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "deaf", "blind", "autistic"),
    ("mexican", "chinese", "indian", "french", "german", "spanish", "turkish", "polish", "russian"),
)
_KIND = {term: kind for kind in IDENTITY for term in kind}
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> list[int]:
    """A word and its beginnings; a beginning differs from the same letters as a whole word."""
    out = [linear.bucket("=" + word)]
    out += [linear.bucket(f"^{word[:n]}") for n in PREFIXES if len(word) >= n]
    return out


class Featurizer:
    """Hashed indicators of a text's words; keeps what it has worked out for words, as packed numbers."""

    def __init__(self, limit: int = 100_000):
        self._known: dict[str, bytes] = {}
        self._limit = limit

    def of_words(self, words: set[str]) -> np.ndarray:
        known = self._known
        if len(known) > self._limit:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = np.array(word_features(w), np.int32).tobytes()
        return np.unique(np.frombuffer(b"".join([known[w] for w in words]), np.int32))

    def __call__(self, text: str) -> np.ndarray:
        return self.of_words(_words(text))


_features = Featurizer()


def features(text: str) -> np.ndarray:
    return _features(text)


def _swapped(text: str) -> Iterator[np.ndarray]:
    words = _words(text)
    for term in sorted(words & _KIND.keys()):
        for other in _KIND[term]:
            if other not in words:
                yield _features.of_words(words - {term} | {other})


def swaps(text: str) -> list[np.ndarray]:
    """Features of the text with each group it names swapped for each other group of that kind."""
    return list(_swapped(text))


def changed(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lost, gained) features of a swap."""
    return np.setdiff1d(own, other), np.setdiff1d(other, own)


def coded(text: str) -> np.ndarray:
    """Features of a text, and those each swap loses and gains, as one array: number of parts, their lengths, the parts.

    What a swap leaves as it is would be sent over and over.
    """
    own = features(text)
    parts = [own, *(part for other in _swapped(text) for part in changed(own, other))]
    return np.concatenate([[len(parts)], [len(p) for p in parts], *parts]).astype(np.int32)


def decoded(row: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(features, (lost, gained) of each swap)."""
    n = int(row[0])
    parts = np.split(row[1 + n :], np.cumsum(row[1 : 1 + n])[:-1])
    return parts[0], list(zip(parts[1::2], parts[2::2], strict=True))


class _Sparse:
    """Rows of hashed features with values; products with a weight vector."""

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray]):
        self.at = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate(values) if rows else np.zeros(0)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n = len(rows)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at] * self.value, minlength=self.n)

    def back(self, z: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, z[self.row] * self.value, minlength=size)


def telling(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which features are frequent enough and associated with the label."""
    if not rows:
        return np.zeros(linear.SIZE, bool)
    n, n1 = len(rows), int(y.sum())
    seen = np.bincount(np.concatenate(rows), minlength=linear.SIZE).astype(float)
    pos = [r for r, label in zip(rows, y, strict=True) if label]
    both = np.bincount(np.concatenate(pos), minlength=linear.SIZE) if pos else np.zeros(linear.SIZE)
    gap = both * n - seen * n1
    chi2 = n * gap**2 / np.maximum(seen * (n - seen) * n1 * (n - n1), 1e-9)
    return (seen >= MIN_ROWS) & (chi2 >= MIN_CHI2)


def fit(
    rows: list[np.ndarray],
    y: np.ndarray,
    swapped: list[list[np.ndarray | tuple[np.ndarray, np.ndarray]]],
    *,
    penalty: float = SWAP_PENALTY,
    ridge: float = RIDGE,
    rounds: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and bias: mean logistic loss + ridge + penalty * mean squared change of a swap's margin.

    A swap is given by its features, or by those it loses and gains. Only ``telling`` features get a weight. Minimised by limited-memory quasi-Newton steps
    with backtracking.
    """
    kept = telling(rows, y)

    def own(r: np.ndarray) -> np.ndarray:
        return r[kept[r]]

    x = _Sparse([own(r) for r in rows], [np.ones(kept[r].sum()) for r in rows])
    gaps, signs = [], []
    for r, others in zip(rows, swapped, strict=True):
        for other in others:
            lost, gained = other if isinstance(other, tuple) else changed(r, other)
            gaps.append(np.concatenate([lost, gained]))
            signs.append(np.concatenate([np.ones(len(lost)), -np.ones(len(gained))]))
    d = _Sparse(gaps, signs)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    w, b = np.zeros(linear.SIZE), float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return w, b
    n, m = len(rows), max(1, d.n)

    def loss(w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
        z = x.dot(w) + b
        p = linear.sigmoid(z)
        change = d.dot(w)
        value = np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * w @ w + penalty / (2 * m) * change @ change
        g = x.back((p - y) / n, linear.SIZE) + ridge * w + penalty / m * d.back(change, linear.SIZE)
        return float(value), g, float(np.mean(p - y))

    pairs: deque = deque(maxlen=10)
    value, g, gb = loss(w, b)
    for _ in range(rounds):
        full = np.append(g, gb)
        q, steps = full.copy(), []
        for s, t, rho in reversed(pairs):
            a = rho * (s @ q)
            steps.append(a)
            q -= a * t
        if pairs:
            s, t, _ = pairs[-1]
            q *= (s @ t) / (t @ t)
        for (s, t, rho), a in zip(pairs, reversed(steps), strict=True):
            q += (a - rho * (t @ q)) * s
        rate = 1.0 if pairs else 1.0 / max(1.0, np.linalg.norm(full))
        slope = -(full @ q)
        while True:
            nw, nb = w - rate * q[:-1], b - rate * q[-1]
            new, ng, ngb = loss(nw, nb)
            if new <= value + 1e-4 * rate * slope or rate < 1e-8:
                break
            rate /= 2
        s, t = -rate * q, np.append(ng, ngb) - full
        if s @ t > 1e-12:
            pairs.append((s, t, 1.0 / (s @ t)))
        done = abs(value - new) < 1e-7 * max(1.0, abs(value))
        w, b, value, g, gb = nw, nb, new, ng, ngb
        if done:
            break
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = linear.MAX_FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias learned from at most ``max_rows`` labelled documents and their swaps."""
    rows, y = linear.fit_rows(linear.training_texts(docs, labels, "toxic", max_rows), coded)
    parts = [decoded(r) for r in rows]
    return fit([p[0] for p in parts], y, [p[1] for p in parts])


def scorer(spark: SparkSession, model: tuple[np.ndarray, float]) -> Callable[[str], float]:
    """What gives a text its score, the probability of being toxic; the model is sent to the tasks once."""
    # One number per hash bucket, whatever the corpus.
    shared = spark.sparkContext.broadcast(model)

    def of(text: str) -> float:
        weights, bias = shared.value
        return float(linear.sigmoid(weights[features(text)].sum() + bias))

    return of


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every row."""
    return linear.score(docs, scorer(docs.sparkSession, model))
