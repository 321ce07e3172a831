"""Learned operators: held-out accuracy on the smallest tables, gradients, and odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import language_gru, learning, quality_model, toxic_spans
from rosterlake.llm.bytetext import slices

from odd_rows import documents, empty, ODD_TEXTS  # noqa: F401  (fixtures)

SYLLABLES = {"en": "the an er th on in ing".split(), "de": "sch en ein ver ü keit".split(), "fr": "eau é ou è ment le".split()}


def prose(rng, lang="en", n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def part_of(texts):
    return next(slices(pa.array(texts, pa.string())))


def test_quality_is_learned(documents, empty):
    rng = random.Random(1)
    good = [prose(rng) for _ in range(150)]
    bad = [" ".join(w + "###" for w in prose(rng).split()) for _ in range(50)] + [" ".join(w for w in prose(rng, n=10).split() for _ in range(8)) for _ in range(50)]
    sample = [(t, 1) for t in good[:100]] + [(t, 0) for t in bad[:40] + bad[50:90]]
    model = quality_model.fit(sample, (80, 100))
    part = part_of(good[100:] + bad[40:50] + bad[90:])
    score = model.score(part)
    assert (score[:50] > 0.5).mean() > 0.95 and (score[50:] < 0.5).mean() > 0.8
    again = quality_model.fit(sample, (80, 100)).score(part)
    assert (again == score).all()
    docs = documents([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "x")], extra=("score",))
    got = [r.score for r in quality_model.score(docs, model).collect()]
    assert len(got) == len(ODD_TEXTS) + 1 and all(0 <= s <= 1 for s in got) and got[-2] == got[-3]
    assert quality_model.score(empty, model).count() == 0
    one_label = quality_model.fit([("a", 1)], (0, 8))
    assert quality_model.score(docs, one_label).select("score").distinct().count() == 1


def brute_marginals(emission, start, move):
    """State-1 probabilities of one chain by summing over all paths."""
    n, total, ones = len(emission), 0.0, np.zeros(len(emission))
    for path in range(2 ** n):
        states = [path >> t & 1 for t in range(n)]
        weight = start[states[0]] + sum(e for e, s in zip(emission, states) if s)
        weight = math.exp(weight + sum(move[a, b] for a, b in zip(states, states[1:])))
        total += weight
        ones += weight * np.array(states)
    return ones / total, math.log(total)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(2)
    emission, sizes = rng.normal(0, 2, (5, 6)), np.array([6, 1, 3, 5, 2])
    start, move = rng.normal(0, 1, 2), rng.normal(0, 1, (2, 2))
    node, edges, total = toxic_spans.marginals(emission, sizes, start, move)
    model = toxic_spans.ToxicModel(toxic_spans.Settings(length=6))
    model.start, model.move = start, move
    quick = model._forward_backward(emission, sizes)
    logs = 0.0
    for i, n in enumerate(sizes):
        want, log = brute_marginals(emission[i, :n], start, move)
        logs += log
        assert np.allclose(node[i, :n], want) and np.allclose(quick[i, :n], want)
    assert abs(total - logs) < 1e-9 and abs(edges.sum() - (sizes - 1).sum()) < 1e-9


def test_toxic_spans(documents, empty):
    rng = random.Random(3)
    words = ["idiot", "trash", "moronic"]

    def toxic():
        text = prose(rng).split()
        for _ in range(3):
            text.insert(rng.randrange(len(text)), rng.choice(words) + rng.choice(["", ".", ","]))
        return " ".join(text)

    clean, bad = [prose(rng) for _ in range(160)], [toxic() for _ in range(80)]
    model = toxic_spans.fit([(t, 0) for t in clean[:120]] + [(t, 1) for t in bad[:60]], (120, 60))
    score = model.score(part_of(clean[120:] + bad[60:]))[0]
    assert (score[:40] < 0.5).all() and (score[40:] >= 0.5).all()
    docs = documents([(1, "é thé IDIOT, an"), *[(10 + i, t) for i, t in enumerate(ODD_TEXTS)]], extra=("spans",))
    got = {r.doc_id: r for r in toxic_spans.score(docs, model).collect()}
    assert [(s.begin, s.end) for s in got[1].spans] == [(6, 11)] and got[1].spans[0].chance > 0.5
    assert all(0 <= r.score <= 1 for r in got.values()) and got[10].spans == [] and got[11].score < 0.5
    assert toxic_spans.score(empty, model).count() == 0
    nothing = toxic_spans.fit([], (0, 0))
    assert {r.score for r in toxic_spans.score(docs, nothing).collect()} == {0.5}


def test_recurrent_gradients():
    model = language_gru.LanguageModel(["a", "b"], language_gru.Settings(size=3, window=5))
    for name in ("gates", "candidate", "gates_back", "candidate_back"):
        for layer in (model.forward, model.backward):
            setattr(layer, name, getattr(layer, name).astype(np.float32))
    rng = np.random.default_rng(0)
    data, size, label = rng.integers(0, 4, (4, 5)).astype(np.uint8), np.array([5, 3, 5, 1]), np.array([0, 1, 1, 0])

    def loss():
        chance = model.positions(data)
        return -sum(np.log(chance[t, i, label[i]]) for i in range(4) for t in range(size[i])) / size.sum()

    for p, g in zip(model.parameters, model.step(data, size, label)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_language_is_learned(documents, empty):
    rng = random.Random(4)
    docs = documents([(i, prose(rng, lang, 40), lang) for i, lang in enumerate(list(SYLLABLES) * 30)])
    sample = language_gru.training_windows(docs, F.col("doc_id") < 60)
    assert len(sample) <= 60 * 4 and {s[1] for s in sample} == set(SYLLABLES)
    model = language_gru.fit(sample, language_gru.Settings(epochs=20, batch=32))
    held = language_gru.predict(docs.where("doc_id >= 60"), model).collect()
    assert np.mean([r.lang_pred == list(SYLLABLES)[r.doc_id % 3] for r in held]) >= 0.9
    odd = documents([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "12 34 !"), (99, "é")], extra=("lang_pred",))
    got = {r.doc_id: r for r in language_gru.predict(odd, model).collect()}
    assert [got[k].lang_pred for k in (0, 1, 2, None)] == ["und"] * 4 and got[99].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[0].score == 0
    assert language_gru.predict(empty, model).count() == 0
    blank = language_gru.fit(language_gru.training_windows(empty, F.lit(True)))
    assert {r.lang_pred for r in language_gru.predict(odd, blank).collect()} == {"und"}


def test_a_sample_is_bounded_and_leaves_ids_out(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(400)] + [(5, "x" * 100)])
    labels = spark.createDataFrame([(i, int(i % 9 > 0), None) for i in range(400)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    sample = learning.labelled_sample(docs, labels, "quality", F.col("doc_id") % 2 == 1, 20, 50)
    assert len(sample) == 40 and sum(y for _, y in sample) == 20
    assert all(int(t.split()[1]) % 2 == 1 and (int(t.split()[1]) % 9 > 0) == y for t, y in sample)
    assert learning.labelled_sample(docs, labels, "toxic", F.lit(True), 20, 50) == []
    assert learning.label_counts(labels, "quality", F.lit(True)) == (45, 356)
