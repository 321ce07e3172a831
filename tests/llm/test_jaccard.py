import random
import re

import pytest

from rosterlake.llm.jaccard_join import Settings, _block_links, _possible, keep_one, similar_groups
from rosterlake.llm.shingles import difference_bound, histogram, overlap
import numpy as np

from odd_rows import documents, empty, ODD_TEXTS, rows  # noqa: F401  (fixtures)


def shingles(text, n=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(len(words) - n, 0) + 1)} if len(words) >= n else {tuple(words)}


def brute(texts):
    """Ids by list place: set size and smallest reachable id."""
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]) and both:
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(texts):
        if doc_id is not None:
            smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return [(d, len(sets[i]), smallest.get(root(i))) for i, (d, _) in enumerate(texts)]


def corpus(seed, n=120):
    """Copies, chains of small changes, many near copies of one text, and a passage that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    make = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, seed_text, texts = make(30), make(60), []
    for i in range(n):
        kind = rng.randrange(5)
        if kind == 0 or not texts:
            words = make(rng.randrange(0, 80))
        elif kind == 1:
            words = list(rng.choice(texts))
        elif kind == 2:
            words = list(rng.choice(texts))
            for _ in range(rng.randrange(1, 4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 3:
            words = list(seed_text)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = make(rng.randrange(0, 15)) + passage + make(rng.randrange(0, 15))
        texts.append(words)
    return [(1000 - i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed, settings", [
    (1, Settings()), (2, Settings(hot=4, block=8, counter_bits=12)), (3, Settings(hot=1, block=4))])
def test_components_equal_comparing_everything(documents, seed, settings):
    texts = corpus(seed)
    found = similar_groups(documents(texts), settings=settings)
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute(texts))


def test_odd_rows(documents, empty):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "same text twice"), (3, "word"), (None, None), (50, "WORD"), (51, "wörd")]
    frame = documents(texts, extra=("n", "sig", "k1", "row", "component_id"))
    want = [(d, n, c if n else d) for d, n, c in brute(texts)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert rows(similar_groups(frame), "doc_id", "n_shingles", "component_id") == sorted(want, key=key)
    assert similar_groups(empty).count() == 0


def test_one_of_each_stays(documents, empty):
    texts = corpus(4)
    kept = keep_one(documents(texts, extra=("row", "group")))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "group"]
    want = {(d, t) for (d, t), (_, n, c) in zip(texts, brute(texts)) if not n or d == c}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(got) == want and len(got) == len(want)
    odd = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "A b c"), (None, "z"), (None, "z"), (7, None), (7, None), (8, "")]
    assert rows(keep_one(documents(odd)), "doc_id", "text") == [(None, "z"), (1, "a b c"), (7, None), (8, "")]
    assert keep_one(empty).count() == 0


def test_filters_never_drop_a_similar_pair():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 200)).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()],
                                      rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64)]))
        apart = len(a) + len(b) - 2 * overlap(a, b)
        assert overlap(a, b) == len(set(a.tolist()) & set(b.tolist()))
        assert difference_bound(histogram(a), histogram(b)) <= apart
        similar = 100 * overlap(a, b) >= 75 * (len(a) + len(b) - overlap(a, b))
        assert not similar or _possible([histogram(a)], [histogram(b)], 75)[0, 0]
        assert (len(_block_links([a], [b], 75)) == 1) == similar
