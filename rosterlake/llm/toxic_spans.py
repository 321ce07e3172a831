"""Toxic spans by a linear-chain conditional random field over tokens.

Tokens are runs of letters and digits in lower case. Labels exist per document only, so tokens are labelled first:
a feature (the word, a prefix or a suffix of it) that is many times more frequent in toxic documents than in clean
ones marks its tokens in toxic documents. The field has two states, emission weights on hashed features and a
transition matrix, and is trained on labelled windows by gradient descent on its likelihood. Forward-backward gives
the probability of each token; a document's score is a logistic function of the highest and the summed ones, and
tokens of at least one half are reported with their offsets. Chains are cut every ``length`` tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import LOWERED, U64, Hasher, Slice, runs, slices
from .common import column

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
PREFIXES = (4, 5, 6, 7)
SUFFIX = 4
KINDS = 2 + len(PREFIXES)


@dataclass(frozen=True)
class Settings:
    bits: int = 18               # features are hashed to 2 ** bits weights per chain state
    length: int = 64             # tokens in a chain
    least_documents: int = 4     # toxic documents a marking feature must occur in
    ratio: float = 20.0          # how much more frequent it must be in toxic documents
    windows: int = 4000          # bound of labelled windows trained on
    epochs: int = 6
    per_label: int = 1500        # bound of the sample that is fitted on, per label
    longest: int = 32_768        # longest text fitted on, in characters


def tokens(part: Slice, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all tokens of a slice, their features (one row each), and where each text's tokens begin."""
    begin, end = runs(_INSIDE[part.data], part.offsets)
    of = Hasher(LOWERED[part.data])
    shift = U64(64 - bits)
    rows = np.empty((len(begin), KINDS), np.int32)
    stretches = [(begin, end)] + [(begin, np.minimum(begin + n, end)) for n in PREFIXES]
    stretches.append((np.maximum(end - SUFFIX, begin), end))
    for k, (a, b) in enumerate(stretches):
        salt = U64((k + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)
        rows[:, k] = (of(a, b) * U64(0xD6E8FEB86659FD93) + salt) >> shift
    return begin, end, rows, np.searchsorted(begin, part.offsets)


def chains(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut the tokens of every text into chains: begin and size of each."""
    sizes = np.diff(first)
    per_text = -(-sizes // length)
    text = np.repeat(np.arange(len(sizes)), per_text)
    within = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = first[:-1][text] + within * length
    return begin, np.minimum(first[1:][text] - begin, length)


def marginals(emission: np.ndarray, sizes: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Forward-backward over a batch of chains padded to one length: node and edge marginals, log normaliser.

    ``emission`` [chains, length] is the log weight of state 1 against state 0; ``start`` and ``move`` are log weights.
    """
    n, length = emission.shape
    live = np.arange(length)[None, :] < sizes[:, None]
    weight = np.ones((n, length, 2))
    weight[:, :, 1] = np.exp(np.clip(np.where(live, emission, 0), -30, 30))
    step = np.exp(move)
    forward, scale = np.empty((n, length, 2)), np.ones((n, length))
    now = np.exp(start)[None, :] * weight[:, 0]
    for t in range(length):
        if t:
            now = np.where(live[:, t, None], (forward[:, t - 1] @ step) * weight[:, t], forward[:, t - 1])
        scale[:, t] = now.sum(1)
        forward[:, t] = now / scale[:, t, None]
    backward = np.ones((n, length, 2))
    for t in range(length - 2, -1, -1):
        nxt = (backward[:, t + 1] * weight[:, t + 1] / scale[:, t + 1, None]) @ step.T
        backward[:, t] = np.where(live[:, t + 1, None], nxt, 1)
    node = forward * backward
    node /= node.sum(2, keepdims=True)
    edges = np.zeros((2, 2))
    for t in range(1, length):
        both = forward[:, t - 1, :, None] * step[None] * (backward[:, t] * weight[:, t] / scale[:, t, None])[:, None, :]
        edges += both[live[:, t]].sum(0)
    return node[:, :, 1], edges, np.log(scale)[live].sum()


class ToxicModel:
    """Weights of the field and of the document score."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.weights = np.zeros(1 << settings.bits, np.float32)
        self.bias = -4.0
        self.start, self.move = np.zeros(2), np.zeros((2, 2))
        self.document = np.array([-4.0, 0.0, 0.0])

    def _padded(self, rows: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        at = begin[:, None] + np.minimum(np.arange(self.settings.length), np.maximum(sizes[:, None] - 1, 0))
        return self.bias + self.weights[rows].sum(1, dtype=np.float64)[at]

    def token_chances(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of being toxic of every token."""
        out = np.zeros(len(rows))
        begin, sizes = chains(first, self.settings.length)
        for a in range(0, len(begin), 2048):
            b, s = begin[a:a + 2048], sizes[a:a + 2048]
            node = self._forward_backward(self._padded(rows, b, s), s)
            live = np.arange(self.settings.length)[None, :] < s[:, None]
            out[(b[:, None] + np.arange(self.settings.length))[live]] = node[live]
        return out

    def _forward_backward(self, emission: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Node marginals alone, with the odds of state 1 carried from both ends."""
        step = np.exp(self.move)
        length = emission.shape[1]
        emission = np.clip(emission, -30, 30)
        live = np.arange(length)[None, :] < sizes[:, None]
        odds = np.exp(np.where(live, emission, 0)).T.copy()
        before = np.empty_like(odds)
        now = np.full(len(sizes), np.exp(self.start[1] - self.start[0]))
        for t in range(length):
            before[t] = now
            now = now * odds[t]
            now = (step[0, 1] + now * step[1, 1]) / (step[0, 0] + now * step[1, 0])
        now = np.ones(len(sizes))
        for t in range(length - 1, -1, -1):
            both = before[t] * odds[t] * now
            before[t] = both / (1 + both)
            now = now * odds[t]
            now = (step[1, 0] + now * step[1, 1]) / (step[0, 0] + now * step[0, 1])
            now = np.where(live[:, t], now, 1.0)
        return before.T

    @staticmethod
    def summary(chance: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text: a one, the logit of the highest token probability, the log of the sum of probabilities."""
        n = len(first) - 1
        most = np.zeros(n)
        full = np.flatnonzero(np.diff(first) > 0)
        if len(full):
            most[full] = np.maximum.reduceat(chance, first[:-1][full])
        total = np.diff(np.concatenate([[0.0], np.cumsum(chance)])[first])
        most = np.clip(most, 1e-5, 1 - 1e-5)
        return np.stack([np.ones(n), np.log(most / (1 - most)), np.log1p(np.maximum(total, 0))], axis=1)

    def score(self, part: Slice):
        """Score of every text of a slice, and its tokens: begins, ends, probabilities, where each text's begin."""
        begin, end, rows, first = tokens(part, self.settings.bits)
        chance = self.token_chances(rows, first)
        logit = np.clip(self.summary(chance, first) @ self.document, -40, 40)
        return 1 / (1 + np.exp(-logit)), begin, end, chance, first


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a little shrinkage."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def fit(sample: list[tuple[str, int]], counts: tuple[int, int], settings: Settings = Settings()) -> ToxicModel:
    """Train on a sample with labels. With one label only every text scores the share of label 1 among all."""
    model = ToxicModel(settings)
    labels = np.array([label for _, label in sample], int)
    if not 0 < labels.sum() < len(labels):
        share = (counts[1] + 1) / (sum(counts) + 2)
        model.document = np.array([np.log(share / (1 - share)), 0.0, 0.0])
        return model
    read = [tokens(part, settings.bits)[2:] for part in slices(pa.array([t for t, _ in sample], pa.string()))]
    rows = np.concatenate([r for r, _ in read])
    sizes = np.concatenate([np.diff(f) for _, f in read])
    first = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(sizes)), sizes)

    # Token labels: features that mark toxic documents.
    seen = np.zeros((2, 1 << settings.bits))
    for label in (0, 1):
        of = labels[text] == label
        pairs = np.unique(text[of][:, None].astype(np.int64) << settings.bits | rows[of])
        seen[label] = np.bincount(pairs & ((1 << settings.bits) - 1), minlength=1 << settings.bits)
    share = seen / np.array([[max((labels == 0).sum(), 1)], [(labels == 1).sum()]])
    marking = (seen[1] >= settings.least_documents) & (
        share[1] >= settings.ratio * (share[0] + 0.1 / max((labels == 0).sum(), 1)))
    toxic = marking[rows].any(1) & (labels[text] == 1)

    # Windows: all with a toxic token, and as many clean ones from clean documents.
    begin, size = chains(first, settings.length)
    running = np.concatenate([[0], np.cumsum(toxic)])
    holds = running[begin + size] > running[begin]
    clean = labels[text[begin]] == 0 if len(begin) else holds
    rng = np.random.default_rng(11)
    picked = [rng.permutation(np.flatnonzero(w))[:settings.windows // 2] for w in (holds, clean)]
    chosen = rng.permutation(np.concatenate(picked))
    squares, gain, gain_bias = np.full(1 << settings.bits, 1e-3), np.full((2, 2), 1e-1), 1e-1
    for _ in range(settings.epochs):
        for a in range(0, len(chosen), 128):
            b, s = begin[chosen[a:a + 128]], size[chosen[a:a + 128]]
            node, edges, _ = marginals(model._padded(rows, b, s), s, model.start, model.move)
            live = np.arange(settings.length)[None, :] < s[:, None]
            at = (b[:, None] + np.arange(settings.length))[live]
            want = toxic[at]
            error = node[live] - want
            touched, which = np.unique(rows[at].ravel(), return_inverse=True)
            slope = np.bincount(which, np.repeat(error, KINDS)) / len(b) + 1e-5 * model.weights[touched]
            squares[touched] += slope ** 2
            model.weights[touched] -= (0.3 * slope / np.sqrt(squares[touched])).astype(np.float32)
            step = error.sum() / len(b)
            gain_bias += step ** 2
            model.bias -= 0.3 * step / gain_bias ** 0.5
            pair = at[1:] == at[:-1] + 1
            pair &= ~np.isin(at[1:], b)
            held = np.zeros((2, 2))
            np.add.at(held, (want[:-1][pair].astype(int), want[1:][pair].astype(int)), 1)
            move = (edges - held) / len(b)
            gain += move ** 2
            model.move -= 0.3 * move / np.sqrt(gain)

    x = model.summary(model.token_chances(rows, first), first)
    balance = np.array(counts) / np.maximum(np.bincount(labels, minlength=2), 1)
    model.document = _logistic(x, labels.astype(float), balance[labels] / balance[labels].mean())
    return model


def score(docs: DataFrame, model: ToxicModel, id_column: str = "doc_id", text_column: str = "text",
          least: float = 0.5) -> DataFrame:
    """doc_id, score and spans (begin and end in code points, probability) of toxic tokens: one row per input row.

    Null and empty texts have no spans and score as texts without tokens. Repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                scores, begin, end, chance, first = own.score(part)
                hit = np.flatnonzero(chance >= least)
                lead = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
                text = np.searchsorted(first, hit, "right") - 1
                base = lead[part.offsets[:-1]][text]
                spans = pa.StructArray.from_arrays(
                    [pa.array((lead[begin[hit]] - base).astype(np.int64)), pa.array((lead[end[hit]] - base).astype(np.int64)),
                     pa.array(chance[hit])], ["begin", "end", "chance"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(hit, first), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.last - part.first), pa.array(scores), lists],
                    ["doc_id", "score", "spans"])

    chosen = docs.select(column(id_column).alias("doc_id"), column(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, score double, "
                                  "spans array<struct<begin: bigint, end: bigint, chance: double>>")
