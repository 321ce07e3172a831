"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax output.

Features of a text are its words, the byte n-grams inside them and its word pairs (a word said twice in a row is one
feature, whatever the word), hashed to buckets. Each bucket has a learned vector; a document is the mean of its features' vectors, and a softmax layer turns it into label probabilities.
Both are trained together by stochastic gradient descent in numpy. Because the output layer is linear, scoring
multiplies every bucket's vector with it once and averages the products, which is the same number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import BLANK_BYTE, U64, Hasher, Slice, runs, slices
from .common import column


@dataclass(frozen=True)
class Settings:
    bits: int = 17                    # buckets are 2 ** bits
    size: int = 12                    # length of a vector
    grams: tuple[int, ...] = (3, 4)   # bytes in an n-gram
    epochs: int = 6
    rate: float = 0.25                # first step size; falls linearly to 0
    per_label: int = 1500             # bound of the sample that is fitted on, per label
    longest: int = 32_768             # longest text fitted on, in characters


def features(part: Slice, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a slice, and how many features each text has; grouped by text."""
    inside = ~BLANK_BYTE[part.data]
    begin, end = runs(inside, part.offsets)
    of = Hasher(part.data)
    at = np.flatnonzero(inside)
    left = np.repeat(end, end - begin) - at
    word = of(begin, end)
    hashes = [(begin, word)] + [(at[left >= n], of(at[left >= n], at[left >= n] + n)) for n in settings.grams]
    first = np.searchsorted(begin, part.offsets)
    second = np.ones(len(begin), bool)
    second[first[:-1][first[:-1] < len(begin)]] = False
    second = np.flatnonzero(second)
    pair = np.where(word[second] == word[second - 1], U64(1), word[second] * U64(3) + word[second - 1])
    hashes.append((begin[second], pair))
    shift, found, place = U64(64 - settings.bits), [], []
    for kind, (a, value) in enumerate(hashes):
        salt = U64(kind * 0xA0761D6478BD642F & (1 << 64) - 1)
        found.append(((value * U64(0xD6E8FEB86659FD93) + salt) >> shift).astype(np.int32))
        place.append(np.searchsorted(a, part.offsets))
    return found, place


def _per_text(found: list[np.ndarray], place: list[np.ndarray], row: int) -> np.ndarray:
    return np.concatenate([f[p[row]:p[row + 1]] for f, p in zip(found, place)])


class QualityModel:
    """Weights of the buckets after the output layer, and the prior of label 1."""

    def __init__(self, weights: np.ndarray, offset: float, settings: Settings):
        self.weights, self.offset, self.settings = weights, offset, settings

    def score(self, part: Slice) -> np.ndarray:
        """Probability of label 1 of every text of a slice."""
        total = np.zeros(len(part.offsets) - 1)
        count = np.zeros(len(part.offsets) - 1)
        for buckets, place in zip(*features(part, self.settings)):
            running = np.concatenate([[0.0], np.cumsum(self.weights[buckets], dtype=np.float64)])
            total += np.diff(running[place])
            count += np.diff(place)
        logit = self.offset + np.divide(total, count, out=np.zeros_like(total), where=count > 0)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit(sample: list[tuple[str, int]], counts: tuple[int, int], settings: Settings = Settings()) -> QualityModel:
    """Train on a sample with labels; ``counts`` of all labels correct for the sample's own balance.

    With one label only, or none, every text scores the share of label 1 (one half when nothing is known).
    """
    share = (counts[1] + 1) / (sum(counts) + 2)
    prior = float(np.log(share / (1 - share)))
    labels = np.array([label for _, label in sample], int)
    if not 0 < labels.sum() < len(labels):
        return QualityModel(np.zeros(1 << settings.bits, np.float32), prior, settings)
    rows = []
    for part in slices(pa.array([text for text, _ in sample], pa.string())):
        found, place = features(part, settings)
        for k in range(len(part.offsets) - 1):
            buckets, times = np.unique(_per_text(found, place, k), return_counts=True)
            rows.append((buckets, (times / max(times.sum(), 1)).astype(np.float32)))
    rng = np.random.default_rng(7)
    vectors = ((rng.random((1 << settings.bits, settings.size), np.float32) - 0.5) / settings.size).astype(np.float32)
    output = np.zeros((2, settings.size), np.float32)
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            buckets, weight = rows[i]
            if not len(buckets):
                continue
            mean = weight @ vectors[buckets]
            logits = output @ mean
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            error *= balance[labels[i]]
            back = error @ output
            output -= rate * np.outer(error, mean).astype(np.float32)
            vectors[buckets] -= (rate * len(buckets) ** 0.5) * np.outer(weight, back).astype(np.float32)
    return QualityModel((vectors @ (output[1] - output[0])).astype(np.float32), prior, settings)


def score(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and score: one row per input row. Null and empty texts score the prior; repeated rows score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.last - part.first), pa.array(own.score(part))],
                    ["doc_id", "score"])

    chosen = docs.select(column(id_column).alias("doc_id"), column(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, score double")
