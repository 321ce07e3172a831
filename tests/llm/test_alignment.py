import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterlake.llm import token_alignment
from rosterlake.llm.token_alignment import Aligned, align, byte_symbols, id_pair, links, load, with_counts

from odd_rows import documents, empty, ODD_TEXTS, rows  # noqa: F401  (fixtures)

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab z'\t\n\r\x0b\x0c\x1c\x1f\x85\xa0­é²½ºª0'slltx.,!?<|> 　漢字ıſ€–’…¼ǅʰ🎉▁"


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def by_hand(text, libraries):
    """Groups of a text as lists of ids, by going along both token lists at once."""
    first, second = libraries
    symbols = byte_symbols()
    a = [(i, bytes(symbols[c] for c in first.id_to_token(i)))
         for i in first.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
         for i in second.encode(text or "")]
    whole = b" " + (text or "").encode()
    if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    groups, i, j, at_a, at_b, left, right = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            left.append(a[i][0])
            at_a += len(a[i][1])
            i += 1
        else:
            right.append(b[j][0])
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b and left and right:
            groups.append((left, right))
            left, right = [], []
    return groups


def expected(table, libraries):
    groups = {r: by_hand(text, libraries) for r, (_, text) in enumerate(table)}
    linked = {r: Counter((x, y) for left, right in found for x in left for y in right) for r, found in groups.items()}
    counts = Counter(p for found in linked.values() for p in found)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for r, (doc_id, _) in enumerate(table):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups[r])
        out.append((doc_id, sum(len(a) for a, _ in groups[r]), sum(len(b) for _, b in groups[r]), len(groups[r]),
                    sum(linked[r].values()), hashlib.sha256(shown.encode()).hexdigest() if shown else "",
                    sum(n for (x, y), n in linked[r].items() if counts[x, y] == most[x]),
                    sum(n * counts[p] for p, n in linked[r].items())))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def digests(docs, frequent):
    kept = align(docs, FIRST, SECOND).select(
        "doc_id", "n_a", "n_b", F.size("cuts").cast("long").alias("n_groups"), "n_links",
        F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("sha"), "pairs", "times")
    return with_counts(kept, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha"], frequent)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_best", "count_sum")


@pytest.mark.parametrize("frequent", [0, 7, 65536])
def test_equals_a_walk_along_both_lists(spark, documents, libraries, frequent):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += ["It's the 3rd of May, don't panic.", "the the the", "naïve café <|endoftext|> <s> </s>", "1234567 tokens"] * 3
    table = list(enumerate(texts))
    got = rows(digests(documents(table).repartition(3), frequent), *COLUMNS)
    assert got == expected(table, libraries)


def test_odd_rows(documents, empty, libraries):
    table = [*enumerate(ODD_TEXTS), (4, "a b"), (4, "a b"), (None, "a b"), (50, "already ▁ marked")]
    docs = documents(table, extra=("pairs", "times", "groups", "n_a", "_row", "pair", "n", "best"))
    got = rows(digests(docs, 3), *COLUMNS)
    assert got == expected(table, libraries)
    none = {r[0]: r for r in got}
    assert none[0][1:] == none[1][1:] == none[50][1:] == (0, 0, 0, 0, "", 0, 0)
    assert digests(empty, 3).count() == 0 and align(empty, FIRST, SECOND).columns[0] == "doc_id"


def test_shown_groups_and_their_ends(documents):
    row = align(documents([(1, "naïve tokens")]), FIRST, SECOND).collect()[0]
    pair = load(FIRST, SECOND)
    raw, at = " naïve tokens".encode(), 0
    for group, end in zip(row.groups.split(";"), row.cuts):
        left, right = ([int(i) for i in side.split(",")] for side in group.split("|"))
        assert b"".join(pair.bytes_a[i] for i in left) == b"".join(pair.bytes_b[i] for i in right) == raw[at:end]
        at = end
    assert at == len(raw) and row.n_links == sum(row.times)


def test_the_faster_encoder_equals_the_library(libraries):
    rng = random.Random(9)
    pair = load(FIRST, SECOND)
    for _ in range(3000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
        assert pair.encode_first(text, text.encode()) == libraries[0].encode(text, add_special_tokens=False).ids


def test_long_stretches(libraries):
    pair = load(FIRST, SECOND)
    for text in ("x" * 399, "x" * 401, "a " + "b" * 400 + " c", " " * 500, "a" + "\n" * 401 + "b", "é" * 300, "1" * 70_000):
        assert pair.encode_first(text, text.encode()) == libraries[0].encode(text, add_special_tokens=False).ids


def test_links_of_large_groups(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, 90), rng.integers(0, 7, 80)
    found = Aligned(a, b, np.array([1, 60, 61, 90]), np.array([2, 50, 60, 80]), [])
    want = Counter()
    for x0, x1, y0, y1 in ((0, 1, 0, 2), (1, 60, 2, 50), (60, 61, 50, 60), (61, 90, 60, 80)):
        want.update((int(x), int(y)) for x in a[x0:x1] for y in b[y0:y1])
    for at_once in (1, 3, 50, 1 << 20):
        monkeypatch.setattr(token_alignment, "LINKS_AT_ONCE", at_once)
        keys, times, n = links(found)
        assert {(int(k) >> 20, int(k) & (1 << 20) - 1): int(t) for k, t in zip(keys, times)} == want and n == sum(want.values())


def test_ids_of_a_pair(spark):
    pair = spark.range(1).select(*[c.alias(n) for c, n in zip(id_pair(F.lit((50256 << 20) | 31999)), "ab")]).first()
    assert tuple(pair) == (50256, 31999)
