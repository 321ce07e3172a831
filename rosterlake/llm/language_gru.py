"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two recurrent layers read windows of bytes from both ends; at every position a softmax over both states names the
language. The network is trained in numpy by backpropagation through time on every position's loss. A document's
probabilities are the mean over all positions of all its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bytetext import Slice, slices
from .common import column
from .learning import chosen_rows

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    size: int = 8               # units of a recurrent layer
    window: int = 96            # bytes read in one go
    per_language: int = 300     # documents of a language fitted on
    most: int = 3000            # documents fitted on in all
    per_document: int = 4       # windows of a document fitted on
    epochs: int = 6
    batch: int = 128
    rate: float = 0.02


def windows(part: Slice, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all windows [windows, length], their sizes and the text each belongs to."""
    sizes = np.diff(part.offsets)
    per_text = -(-sizes // length)
    text = np.repeat(np.arange(len(sizes)), per_text)
    within = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = part.offsets[:-1][text] + within * length
    size = np.minimum(part.offsets[1:][text] - begin, length)
    at = begin[:, None] + np.minimum(np.arange(length), np.maximum(size[:, None] - 1, 0))
    return part.data[at], size, text


class Layer:
    """One recurrent layer: a gated unit whose input weights are a table over bytes."""

    def __init__(self, size: int, rng: np.random.Generator):
        f = np.float32
        self.gates = (rng.standard_normal((256, 2 * size)) * 0.3).astype(f)
        self.candidate = (rng.standard_normal((256, size)) * 0.5).astype(f)
        self.gates_back = (rng.standard_normal((size, 2 * size)) * size ** -0.5).astype(f)
        self.candidate_back = (rng.standard_normal((size, size)) * size ** -0.5).astype(f)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.gates, self.candidate, self.gates_back, self.candidate_back]

    def read(self, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States [length, windows, size] for bytes given as [length, windows], in reading order."""
        length, n = steps.shape
        size = self.candidate.shape[1]
        states = np.empty((length, n, size), np.float32)
        state = np.zeros((n, size), np.float32)
        for t in range(length):
            gate = self.gates[steps[t]]
            gate += state @ self.gates_back
            gate *= np.float32(0.5)
            np.tanh(gate, out=gate)
            gate += 1
            gate *= np.float32(0.5)
            held = state @ self.candidate_back
            new = gate[:, size:] * held
            new += self.candidate[steps[t]]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((gate, held, new, state))
            state = new + gate[:, :size] * (state - new)
            states[t] = state
        return states

    def learn(self, steps: np.ndarray, trace: list, slopes: np.ndarray) -> list[np.ndarray]:
        """Gradients of the parameters, given those of the states."""
        size = self.candidate.shape[1]
        grads = [np.zeros_like(p) for p in self.parameters]
        back = np.zeros_like(slopes[0])
        for t in range(len(steps) - 1, -1, -1):
            gate, held, new, state = trace[t]
            keep, reset = gate[:, :size], gate[:, size:]
            d = back + slopes[t]
            d_new = d * (1 - keep) * (1 - new * new)
            d_gate = np.concatenate([d * (state - new), d_new * held], axis=1) * gate * (1 - gate)
            d_held = d_new * reset
            back = d * keep + d_held @ self.candidate_back.T + d_gate @ self.gates_back.T
            np.add.at(grads[0], steps[t], d_gate)
            np.add.at(grads[1], steps[t], d_new)
            grads[2] += state.T @ d_gate
            grads[3] += state.T @ d_held
        return grads


class LanguageModel:
    def __init__(self, languages: list[str], settings: Settings):
        rng = np.random.default_rng(5)
        self.languages, self.settings = languages, settings
        self.forward, self.backward = Layer(settings.size, rng), Layer(settings.size, rng)
        self.output = (rng.standard_normal((2 * settings.size, len(languages))) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*self.forward.parameters, *self.backward.parameters, self.output, self.bias]

    def _label(self, read: np.ndarray, reread: np.ndarray) -> np.ndarray:
        k = self.settings.size
        chance = read @ self.output[:k]
        chance += reread @ self.output[k:]
        chance += self.bias
        chance -= chance.max(-1, keepdims=True)
        np.exp(chance, out=chance)
        chance /= chance.sum(-1, keepdims=True)
        return chance

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Language probabilities at every position [length, windows, languages]."""
        steps = np.ascontiguousarray(data.T)
        return self._label(self.forward.read(steps), self.backward.read(steps[::-1])[::-1])

    def score(self, part: Slice, at_once: int = 2048) -> np.ndarray:
        """Mean language probabilities of every text of a slice; zeros for empty texts."""
        data, size, text = windows(part, self.settings.window)
        total = np.zeros((len(part.offsets) - 1, len(self.languages)))
        live = np.arange(self.settings.window)[:, None]
        for a in range(0, len(data), at_once):
            chance = self.positions(data[a:a + at_once])
            chance *= (live < size[None, a:a + at_once])[:, :, None]
            np.add.at(total, text[a:a + at_once], chance.sum(0))
        return total / np.maximum(np.diff(part.offsets), 1)[:, None]

    def step(self, data: np.ndarray, size: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean loss over all positions of a batch of windows."""
        steps = np.ascontiguousarray(data.T)
        traces: tuple[list, list] = [], []
        read = self.forward.read(steps, traces[0])
        reread = self.backward.read(steps[::-1], traces[1])[::-1]
        error = self._label(read, reread)
        error[:, np.arange(len(label)), label] -= 1
        error *= (np.arange(len(steps))[:, None] < size[None])[:, :, None] / np.float32(max(size.sum(), 1))
        k = self.settings.size
        flat = error.reshape(-1, error.shape[2])
        output = np.concatenate([read.reshape(-1, k).T @ flat, reread.reshape(-1, k).T @ flat])
        return [*self.forward.learn(steps, traces[0], error @ self.output[:k].T),
                *self.backward.learn(steps[::-1], traces[1], (error @ self.output[k:].T)[::-1]), output, flat.sum(0)]


def fit(sample: list[tuple[bytes, str]], settings: Settings = Settings()) -> LanguageModel:
    """Train on byte windows with their language, by Adam; the same sample always gives the same network."""
    languages = sorted({language for _, language in sample})
    model = LanguageModel(languages, settings)
    if len(languages) < 2:
        return model
    data = np.zeros((len(sample), settings.window), np.uint8)
    for i, (text, _) in enumerate(sample):
        data[i, :len(text)] = np.frombuffer(text[:settings.window], np.uint8)
    size = np.array([min(len(text), settings.window) for text, _ in sample])
    label = np.array([languages.index(language) for _, language in sample])
    # The same number of windows of every language in an epoch.
    by_label = [np.flatnonzero(label == k) for k in range(len(languages))]
    each = max(len(b) for b in by_label)
    rng = np.random.default_rng(6)
    first = [np.zeros_like(p) for p in model.parameters]
    second = [np.zeros_like(p) for p in model.parameters]
    steps = -(-each * len(languages) // settings.batch) * settings.epochs
    done = 0
    for _ in range(settings.epochs):
        order = np.concatenate([rng.permutation(np.resize(rng.permutation(b), each)) for b in by_label])
        order = rng.permutation(order)
        for a in range(0, len(order), settings.batch):
            pick = order[a:a + settings.batch]
            done += 1
            rate = settings.rate * (1 - done / (steps + 1))
            for p, g, m, v in zip(model.parameters, model.step(data[pick], size[pick], label[pick]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.99 ** done)) + 1e-8)
    return model


def training_windows(docs: DataFrame, learn: Column, settings: Settings = Settings(), id_column: str = "doc_id",
                     text_column: str = "text", lang_column: str = "lang") -> list[tuple[bytes, str]]:
    """Windows of a bounded sample of documents with a language, from all over their texts.

    ``learn`` selects rows by id. At most ``per_language`` documents of a language and ``most`` in all are read,
    and ``per_document`` windows of each, so the driver receives a bounded number of bytes.
    """
    bare = docs.select(column(id_column).alias("doc_id"), column(text_column).cast("string").alias("text"),
                       column(lang_column).alias("lang")).where(learn)
    ids = chosen_rows(bare.where("doc_id is not null and lang is not null").select("doc_id", F.col("lang").alias("label")),
                      settings.per_language, settings.most)
    window, count = settings.window, settings.per_document

    def cut(batches):
        for batch in batches:
            rows = []
            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                gap = max((len(raw) - window) / max(count - 1, 1), 1)
                begins = sorted({min(int(k * gap), max(len(raw) - window, 0)) for k in range(count)})
                rows += [(raw[b:b + window], language) for b in begins]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                              pa.array([r[1] for r in rows], pa.string())], ["piece", "label"])

    texts = bare.where(F.length("text") > 0).join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    pieces = texts.select("text", F.col("lang").cast("string").alias("lang")).where("lang is not null").mapInArrow(
        cut, "piece binary, label string")
    found = pieces.orderBy(F.xxhash64("piece"), "piece", "label").limit(settings.most * count).collect()
    return [(bytes(r.piece), r.label) for r in found]


def predict(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred and score: one row per input row.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. Ties go to the
    language that sorts first; repeated rows are labelled alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        names = np.array([*own.languages, UNDETERMINED], object)
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for part in slices(batch.column(1), 1 << 18):
                judged = lettered[part.first:part.last] & bool(own.languages)
                if own.languages:
                    chance = own.score(part)
                    best, most = chance.argmax(1), np.clip(chance.max(1), 0, 1)
                else:
                    best = most = np.zeros(part.last - part.first, int)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.last - part.first),
                     pa.array(names[np.where(judged, best, -1)], pa.string()),
                     pa.array(np.where(judged, most, 0.0).astype(float))], ["doc_id", "lang_pred", "score"])

    text = column(text_column).cast("string")
    chosen = docs.select(column(id_column).alias("doc_id"), text.alias("text"),
                         F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, lang_pred string, score double")
