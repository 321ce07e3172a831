import io
import math
import random
import re
import tempfile
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import lm_trie
from rosterlake.llm.elias_fano import Children, Sequence, Trie, mapped, write
from rosterlake.llm.lm_trie import Settings, Vocabulary, build, pack, score, unpack

from odd_rows import documents, empty, ODD_TEXTS, rows  # noqa: F401  (fixtures)


# -- sequences -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n, top", [(1, 1), (1, 10**12), (5, 4), (64, 64), (1000, 3), (1000, 10**9), (4000, 4000), (9000, 70_000)])
def test_sequences_give_back_their_numbers_and_successors(n, top):
    rng = np.random.default_rng(n + top)
    values = np.sort(rng.integers(0, top, n))
    for sequence in (Sequence.of(values), Sequence.over(Sequence.of(values).arrays())):
        assert (sequence[np.arange(n)] == values).all()
        targets = np.concatenate([rng.integers(0, top + 10, 500), values, values + 1, [0, top * 3]])
        at, equal = sequence.successor(targets)
        assert (at == np.searchsorted(values, targets)).all() and (equal == np.isin(targets, values)).all()
        if n > 1:
            one, two = sequence.pairs(np.arange(n - 1))
            assert (one == values[:-1]).all() and (two == values[1:]).all()


def test_an_empty_sequence():
    sequence = Sequence.of(np.zeros(0, np.int64))
    assert [x.tolist() for x in sequence.successor(np.array([0, 5]))] == [[0, 0], [False, False]] and len(sequence[np.zeros(0, np.int64)]) == 0


def test_size_stays_near_two_bits_more_than_the_low_bits():
    values = np.sort(np.random.default_rng(1).integers(0, 10**9, 100_000))
    size = sum(a.nbytes for a in Sequence.of(values).arrays().values())
    assert size * 8 < 100_000 * (math.log2(10**9 / 100_000) + 4)


def test_children_are_found_on_the_base_of_their_node():
    rng = random.Random(4)
    nodes = [sorted(rng.sample(range(500), rng.choice([0, 1, 2, 30, 400]))) for _ in range(200)]
    starts = np.cumsum([0, *map(len, nodes)])
    children = Children.of(np.array([x for c in nodes for x in c]), starts)
    node = np.array([rng.randrange(200) for _ in range(5000)])
    number = np.array([rng.randrange(520) for _ in range(5000)])
    opened = children.open(node)
    there, at = children.find(opened, number)
    for i in range(5000):
        own = nodes[node[i]]
        assert there[i] == (number[i] in own) and opened[0][i] == starts[node[i]] and opened[1][i] == starts[node[i] + 1]
        if there[i]:
            assert at[i] == starts[node[i]] + own.index(number[i])


def test_arrays_are_mapped_from_a_file():
    arrays = {"a": np.arange(5, dtype=np.int64), "none": np.zeros(0, np.uint16), "b": np.arange(9, dtype=np.uint16)}
    with tempfile.TemporaryFile() as file:
        write(file, arrays)
        back = mapped(file)
        assert isinstance(back["a"], np.memmap) and all((back[k] == arrays[k]).all() for k in arrays)
    out = io.BytesIO()
    write(out, arrays)
    assert out.tell() % 64 == 0


def test_packed_columns():
    rng = np.random.default_rng(3)
    for columns in ([np.zeros(0, np.int64)] * 2, [np.array([7]), np.array([0])],
                    [np.sort(rng.integers(0, 10**12, 300)), rng.integers(0, 300, 300), rng.integers(0, 2**40, 300)]):
        assert all((a == b).all() for a, b in zip(unpack(pack(*columns)), columns))


# -- scores --------------------------------------------------------------------------------------


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def hash_of(word):
    return int(lm_trie.END[0]) if word is None else int(next(lm_trie.tokens(pa.array([word])))[0][0])


def by_hand(table, learns, settings):
    """(doc_id, n_tokens, n_known, train_tokens, base, score) with plain counts and probabilities that are not rounded."""
    mu = settings.smoothing
    every, one, two, three, context_1, context_2 = Counter(), Counter(), Counter(), Counter(), Counter(), Counter()

    def trigrams(text):
        words = split(text)
        padded = ["<", "<", *words]
        return zip(padded, padded[1:], words)

    for doc_id, text in table:
        for u, v, w in trigrams(text):
            every[w] += 1
            if learns(doc_id):
                one[w] += 1
                two[v, w] += 1
                three[u, v, w] += 1
                context_1[v] += 1
                context_2[u, v] += 1
    total, size = sum(one.values()), len(one)
    frequent = {w for w in sorted(every, key=lambda w: (-every[w], hash_of(w)))[:settings.frequent] if one[w]}
    rare = size - len(frequent)
    rare_share = (total - sum(one[w] for w in frequent) + 0.1 * (rare + 1)) / (rare + 1)
    out = []
    for doc_id, text in table:
        base = found = 0.0
        for u, v, w in trigrams(text):
            weight = total + 0.1 * (size + 1)
            p1 = (one[w] + 0.1 if w in frequent else rare_share) / weight
            p2 = (two[v, w] + mu * p1) / (context_1[v] + mu)
            p3 = (three[u, v, w] + mu * p2) / (context_2[u, v] + mu)
            base += math.log10((one[w] + 0.1) / weight)
            found += math.log10(p3)
        words = split(text)
        out.append((doc_id, len(words), sum(one[w] > 0 for w in words), total, base, found))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


COLUMNS = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def same(docs, table, settings=Settings()):
    learns = (lambda d: d is not None and d % 4 != 0)
    got = rows(score(docs, F.col("doc_id") % 4 != 0, settings), *COLUMNS)
    want = by_hand(table, learns, settings)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        # Half a code for each order that a token goes through.
        assert abs(a[4] - b[4]) < 1e-9 * b[1] + 1e-9 and abs(a[5] - b[5]) <= 3 * 0.5 / 4096 * b[1] + 1e-6, (a, b)


def texts(n, seed=6):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["The", "the", "THE", "é"]
    common = "shared line of words that many texts have"
    return [(i, " ".join(rng.choice(words) if rng.random() < .6 else "the" for _ in range(rng.randrange(40))) +
             (" " + common if i % 3 == 0 else "")) for i in range(n)]


@pytest.mark.parametrize("settings", [
    Settings(), Settings(2.0, 1000, 50, 100, 0), Settings(16.0, 9, 300, 60, 2), Settings(5.0, 1, 100_000, 400, 1),
    Settings(8.0, 0, 200, 90, 3)])
def test_equals_plain_counts(documents, settings):
    table = texts(120)
    same(documents(table).repartition(3), table, settings)


@pytest.mark.parametrize("settings", [
    Settings(16.0, 9, 300, 60, 2, each_rare=True), Settings(8.0, 0, 200, 90, 3, each_rare=True), Settings(4.0, 3, 300, 10**6, 2, each_rare=True)])
def test_rare_words_have_their_own_counts(documents, settings):
    table = texts(90) + [(i, f"seldom{i} seldom{i // 3} the") for i in range(90, 120)]
    got = rows(score(documents(table).repartition(3), F.col("doc_id") % 4 != 0, settings), *COLUMNS)
    want = by_hand(table, lambda d: d % 4 != 0, Settings(settings.smoothing))  # all words are frequent
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 and abs(a[5] - b[5]) <= 3 * 0.5 / 4096 * b[1] + 1e-6, (a, b)


def test_rare_words_are_told_apart_beyond_40_bits():
    words = vocabulary([3], 1)
    low = np.array([77, 77 + (1 << 41), 77 + (1 << 61)])
    assert len(set(words.ids(low).tolist())) == 3


def vocabulary(times, texts):
    """Words 0, 1, ... by number with these training tokens, all frequent."""
    times = np.array(times)
    return Vocabulary(np.arange(len(times)), np.arange(len(times)), times, times, len(times), int(times.sum()), texts, int(times.sum()), texts)


def test_words_that_fill_parts_by_themselves_are_dealt_over_several(documents):
    table = [(i, "a a a a a b a a c " * (1 + i % 3)) for i in range(60)] + [(i, "x y z") for i in range(100, 140)]
    words = vocabulary([90, 5, 5], 5)
    assert words.pieces(np.array([0, 1, 3, 4, 10**9]), 20).tolist() == [9, 1, 1, 1, 1]
    assert vocabulary([90, 5, 5], 50).split(np.array([0, 2, 3]), 20).tolist() == [True, False, True]
    same(documents(table).repartition(4), table, Settings(3.0, 100, 200, 50, 2))
    same(documents(table).repartition(4), table, Settings(3.0, 2, 200, 50, 2))


def test_messages_are_shuffled_once(documents):
    table = [(i, "a a b a c") for i in range(60)]
    scored = score(documents(table), F.lit(True), Settings(3.0, 100, 200, 50, 2))
    scored.collect()
    assert "ReusedExchange" in scored._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(documents, empty):
    table = [*enumerate(ODD_TEXTS), (5, "again again again"), (5, "again again again"), (None, "no id"), (3, "A\x0bB\x0cc\r\n")]
    docs = documents(table, extra=("chunk", "pos", "part", "own", "payload", "words", "n_tokens", "score"))
    same(docs, table)
    same(docs, table, Settings(4.0, 3, 20, 15, 1))
    assert score(empty, F.lit(True)).count() == 0 and score(empty, F.lit(True)).columns[0] == "doc_id"
    # Nothing to learn from: every token has probability 1.
    for nothing in (F.lit(False), F.lit(None).cast("boolean")):
        got = rows(score(documents([(1, "a b"), (2, None)]), nothing), *COLUMNS)
        assert [(r[0], r[1], r[2], r[3], abs(r[4]), abs(r[5])) for r in got] == [(1, 3, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]


def test_a_trigram_that_many_texts_share_is_sent_once():
    line, n = np.arange(5), 50
    w, size = np.tile(line, n), np.full(n, 5)
    u, v = lm_trie._with_contexts(w, size, 6)
    asked, asker, question, often = lm_trie.gather(u, v, w, np.repeat(np.arange(n), 5), np.arange(n) % 2 == 0, 4)
    assert len(asked.w) == 5 and asked.slot.tolist() == [n, n + 1, n + 2, n + 3, n + 4]
    assert asked.learned.tolist() == [25] * 5 and asked.times.tolist() == [1] * 5
    assert len(asker) == len(question) == 5 * n and (often == 1).all()


def test_probabilities_after_a_context_add_up():
    rng = np.random.default_rng(8)
    w = np.minimum(rng.zipf(1.5, 4000) - 1, 19)
    size = np.full(40, 100)
    counts = np.bincount(w, minlength=20)
    rank = np.argsort(np.argsort(-counts, kind="stable"), kind="stable")
    w, counts = rank[w], np.sort(counts)[::-1]
    kept = int((counts > 0).sum())
    words = vocabulary(counts[:kept], 40)
    u, v = lm_trie._with_contexts(w, size, words.start)
    asked, *_ = lm_trie.gather(u, v, w, np.repeat(np.arange(40), 100), np.ones(40, bool), 0)
    trie = build(asked.u, asked.v, asked.w, asked.learned, words, Settings(4.0), (np.zeros(0, np.int64),) * 3)
    again = Trie.over(trie.arrays())
    every = np.append(np.arange(kept), 10**6)  # with one that stands for all unknown words
    for a, b in ((0, 1), (1, 0), (words.start, words.start), (10**6, 2), (kept - 1, kept - 1)):
        code = again.look(np.full(len(every), a), np.full(len(every), b), every, lm_trie.codes(words.share(every)))
        assert abs((10.0 ** (-code / 4096)).sum() - 1) < 0.01


def test_columns_are_unpacked_one_by_one():
    columns = [np.array([1, 5, 9]), np.array([3, 0, 2]), np.array([2**60, 1, 0])]
    two, one = unpack(memoryview(pack(*columns)), (2, 0))
    assert (two == columns[2]).all() and (one == columns[0]).all()


@pytest.mark.parametrize("n, top", [(200_000, 10**12), (131_072, 1000), (65_537, 2**62)])
def test_long_sequences_are_written_in_blocks(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    sequence = Sequence.of(values)
    assert (sequence[np.arange(n)] == values).all()
    asked = rng.integers(0, top, 2000)
    at, equal = sequence.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_a_part_is_answered_in_little_memory_by_trigram():
    rng = np.random.default_rng(5)
    words = vocabulary(np.arange(1000, 0, -1), 100)
    payloads, n = [], 40_000
    for _ in range(10):
        u, v, w = (np.where(rng.random(n) < 0.3, rng.integers(2**61, 2**62, n), rng.integers(0, 1000, n)) for _ in range(3))
        order = np.lexsort((w, u, v))
        payloads.append(pack(v[order], u[order], w[order], rng.integers(0, 500, n), np.ones(n, int), rng.integers(0, 2, n)))
    messages = pa.table({
        "part": pa.array([0] * 10, pa.int32()), "chunk": pa.array(range(10), pa.int64()), "kind": pa.array([lm_trie.TRIGRAMS] * 10, pa.int32()),
        "keys": pa.nulls(10, pa.list_(pa.int64())), "payload": pa.array(payloads, pa.binary())})
    tracemalloc.start()
    try:
        lm_trie._answered(messages, (np.zeros(0, np.int64),) * 3, words, Settings(each_rare=True))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 140 * 10 * n
