"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other; each model sees, besides the
words of a text, the probabilities of the categories before it.  For training,
those probabilities are out-of-fold predictions, so that a later model learns
from the kind of errors it will meet.

A feature is the presence of a word, or of the first few bytes of a word, in a
text.  Each model keeps the features whose association with its category is
beyond chance (a likelihood ratio) and fits logistic weights to them.

Only training looks at a sample: at most ``per_class`` labelled rows with and
as many without the last category, chosen by a hash of their id.  Scoring runs
over every whole text and nothing is shuffled.

Null and empty texts have no features: their probability is what the models
give to a text without words.  Rows are independent.  Without labelled rows of
both kinds a category gets the share of its positives as constant probability
(0 without labels) and nothing is rejected.  Labels that are null are not
used; of several labels of a document the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import ALNUM, append_columns, byte_view, lowered, slices, span_hashes, word_bounds

PREFIXES = (4, 5, 6, 7, 8)
SLICE = 1 << 20  # bytes of text at once
PER_CLASS = 2500
FOLDS = 4
LEAST_PRECISION = 0.8
EVIDENCE = 30.0  # least likelihood ratio of a feature
LEAST_ROWS = 3  # with a feature among the sample
MOST_FEATURES = 4096
STEPS = 150


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts, repeated ones included, and the text of each."""
    data, offsets = byte_view(column)
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    hashed = span_hashes(data, starts, ends, PREFIXES)
    found, of = [hashed[0]], [rows]
    for length, values in zip(PREFIXES, hashed[1:]):
        longer = ends - starts > length
        found.append(values[longer] ^ np.uint64(length))
        of.append(rows[longer])
    return (np.concatenate(found) >> np.uint64(32)).astype(np.uint32), np.concatenate(of)


@dataclass
class Linear:
    """Weights of the features, of earlier probabilities, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, features: np.ndarray, rows: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        logit = self.bias + earlier @ self.earlier
        if len(self.features) and len(features):
            at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
            hit = self.features[at] == features
            pairs = np.unique(rows[hit] * np.int64(len(self.features)) + at[hit])
            logit += np.bincount(pairs // len(self.features), self.weights[pairs % len(self.features)], len(earlier))
        return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def fit(features: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, earlier: np.ndarray) -> Linear:
    """``features``, ``rows``: distinct features of the texts.  Logistic regression with a small ridge."""
    positive = float((y * weight).sum() / max(weight.sum(), 1e-9))
    none = Linear(np.zeros(0, np.uint32), np.zeros(0), np.zeros(earlier.shape[1]), float(np.log((positive + 1e-6) / (1 - positive + 1e-6))))
    if y.min(initial=1) == y.max(initial=0) or len(y) == 0:
        return none
    names, column, count = np.unique(features, return_inverse=True, return_counts=True)
    with_y = np.bincount(column, y[rows], len(names))
    n, p = len(y), y.sum()

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = 2 * (
        part(with_y, count * p / n)
        + part(count - with_y, count * (n - p) / n)
        + part(p - with_y, (n - count) * p / n)
        + part(n - p - count + with_y, (n - count) * (n - p) / n)
    )
    good = np.flatnonzero((ratio >= EVIDENCE) & (count >= LEAST_ROWS))
    good = np.sort(good[np.argsort(-ratio[good], kind="stable")[:MOST_FEATURES]])
    place = np.full(len(names), -1)
    place[good] = np.arange(len(good))
    column = place[column]
    rows, column = rows[column >= 0], column[column >= 0]

    size = len(good) + earlier.shape[1] + 1
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    theta[-1] = none.bias
    for step in range(1, STEPS + 1):  # Adam
        logit = theta[-1] + earlier @ theta[len(good) : -1] + np.bincount(rows, theta[column], n)
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y)
        gradient = np.concatenate([np.bincount(column, error[rows], len(good)), error @ earlier, [error.sum()]]) / weight.sum()
        gradient[:-1] += 1e-5 * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Linear(names[good], theta[: len(good)], theta[len(good) : -1], float(theta[-1]))


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    threshold: float  # of the last category

    def predict(self, features: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
        known = np.zeros((count, 0))
        for model in self.models:
            known = np.column_stack([known, model.predict(features, rows, known)])
        return known


def train(features: np.ndarray, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, categories: list[str]) -> Chain:
    """``labels``: one column of 0 and 1 for each category."""
    fold = np.arange(len(labels)) % FOLDS
    earlier, models = np.zeros((len(labels), 0)), []
    for k in range(labels.shape[1]):
        y, held_out = labels[:, k].astype(float), np.zeros(len(labels))
        for f in range(FOLDS if len(labels) >= 2 * FOLDS else 0):
            inside, outside = fold != f, fold == f
            number = np.cumsum(inside) - 1
            kept = inside[rows]
            model = fit(features[kept], number[rows[kept]], y[inside], weight[inside], earlier[inside])
            number = np.cumsum(outside) - 1
            kept = outside[rows]
            held_out[outside] = model.predict(features[kept], number[rows[kept]], earlier[outside])
        models.append(fit(features, rows, y, weight, earlier))
        earlier = np.column_stack([earlier, held_out])
    return Chain(categories, models, best_threshold(earlier[:, -1], labels[:, -1], weight))


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the cut with the best F1 on the held-out predictions, among
    those of which ``LEAST_PRECISION`` are right; without one nothing is rejected."""
    order = np.argsort(-p, kind="stable")
    p, y, weight = p[order], y[order], weight[order]
    right, every = np.cumsum(weight * y), np.cumsum(weight)
    below = np.append(p[1:], 0.0)
    good = np.flatnonzero((p > below) & (right >= LEAST_PRECISION * every))
    if not len(good):
        return 1.1
    best = good[int(np.argmax(2 * right[good] / (every[good] + right[-1])))]
    return float((p[best] + below[best]) / 2)


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], text: str = "text", key: str = "doc_id", per_class: int = PER_CLASS) -> Chain:
    """Fit the chain on a bounded sample of labelled rows; the last category is the one that is decided."""
    last = categories[-1]
    known = labels.select(F.col(key).alias("_id"), *categories).dropna().groupBy("_id").agg(*[F.max(c).alias(c) for c in categories])
    sizes = {bool(r[0]): r[1] for r in known.groupBy(F.col(last) > 0).count().collect()}
    picked = [known.filter((F.col(last) > 0) == F.lit(kind)).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for kind in (True, False)]
    sample = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(picked[0].unionByName(picked[1]), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                features, rows = word_features(part.column("_text"))
                pairs = np.unique(rows.astype(np.uint64) << np.uint64(32) | features)
                at = np.searchsorted(pairs, np.arange(part.num_rows + 1, dtype=np.uint64) << np.uint64(32))
                low = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                blobs = [low[a:b].tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(blobs, pa.binary()), *(part.column(c) for c in categories)], names=["_id", "found", *categories])

    kind = dict(known.dtypes)
    schema = f"_id {kind['_id']}, found binary, " + ", ".join(f"`{c}` {kind[c]}" for c in categories)
    got = sorted(sample.select("_id", "_text", *categories).mapInArrow(run, schema).collect(), key=lambda r: (str(r[0]), bytes(r[1])))
    found = [np.frombuffer(r[1], np.uint32) for r in got]
    y = np.array([[int(x > 0) for x in r[2:]] for r in got], int).reshape(len(got), len(categories))
    drawn = {kind: max(1, int((y[:, -1] == kind).sum())) for kind in (0, 1)}
    weight = np.array([sizes.get(bool(x), 1) / drawn[int(x)] for x in y[:, -1]])
    weight = weight / weight.mean() if len(weight) else weight
    rows = np.repeat(np.arange(len(got)), [len(f) for f in found]) if got else np.zeros(0, int)
    return train(np.concatenate(found) if found else np.zeros(0, np.uint32), rows, y, weight, categories)


def score_chain(docs: DataFrame, chain: Chain, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``p_<category>`` for each category, and ``rejected``: the last one is at or over the threshold."""
    own = T.StructType()
    for c in chain.categories:
        own = own.add(f"p_{c}", T.DoubleType())
    own = own.add("rejected", T.BooleanType())
    models, threshold, categories = chain.models, chain.threshold, chain.categories

    def make():
        local = Chain(categories, models, threshold)

        def run(column: pa.Array) -> list[pa.Array]:
            p = local.predict(*word_features(column), len(column))
            return [*(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array(p[:, -1] >= threshold)]

        return run

    return append_columns(docs, text, make, own, keep, SLICE)
