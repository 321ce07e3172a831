"""Alignment of two tokenizers over the same texts: which tokens of the one stand for which tokens of the other.

Both tokenizers see a blank and the text. The cumulative byte ends of each token list go into a dictionary from end to
index; ends that both dictionaries know cut the two lists into groups, and every token of a group is linked with every
token of the other side in it.

Id pairs are counted by the number of documents that link them. The links of a document are kept as distinct pairs
with their multiplicity, so counting adds one per document and pair, combined per task before anything is moved. Every
document is then told the counts of its pairs: those of the most frequent pairs, a fixed number, are sent to all tasks;
the others, none of which is a hot key then, are joined.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .bytetext import slices
from .common import column
from .graphs import stored

# Fixed values of the formats: the mark of a blank in pieces, and how a byte-level tokenizer cuts a text into words.
MARK = "▁"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SECOND_BITS = 20        # an id pair is one number; ids of the second tokenizer are below 2 ** 20
FREQUENT_PAIRS = 65536  # id pairs whose counts are sent to all tasks
LINKS_AT_ONCE = 1 << 22  # links of one text that are unfolded together

#: Characters and lengths of a stretch for which the library that reads the first tokenizer's file encodes a text itself.
#: The faster one for the same vocabulary takes the others: its letter classes are of another Unicode version, and long
#: stretches cost it squares.
UNUSUAL = re.compile(r"[^\x00-ɏ‐-…€]")
LONG_STRETCH = 400


def byte_symbols() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable bytes as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Aligned:
    """One text: ids of both sides, where their groups end, and its distinct id pairs with how often they are linked."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    cuts: list[int]


class TokenizerPair:
    """A byte-level tokenizer file (A) and a piece model (B) with the bytes of every id."""

    def __init__(self, first: str, second: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(first)
        self.slow.encode_special_tokens = True
        with open(first, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if all(c in symbols for c in token)}
        special = {t.content for t in self.slow.get_added_tokens_decoder().values() if t.special}
        ranks = {raw: i for raw, i in ranks.items() if raw.decode("utf-8", "replace") not in special}
        self.fast = tiktoken.Encoding("first", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for raw, i in ranks.items():
            self.bytes_a[i] = raw
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        if len(self.bytes_b) > 1 << SECOND_BITS:
            raise ValueError("the second tokenizer has too many ids")
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Decimal ids with what follows them inside a group and at its end.
        self.shown_a = np.array([f"{i}{end}" for end in ",|" for i in range(len(self.bytes_a))], object)
        self.shown_b = np.array([f"{i}{end}" for end in ",;" for i in range(len(self.bytes_b))], object)

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.second.is_control(i) else piece.replace(MARK, " ").encode()

    def encode_first(self, text: str, raw: bytes) -> list[int]:
        """Ids of A; ``raw`` is the text in bytes."""
        if not text.isascii() and UNUSUAL.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        # Places where blanks and other characters meet; code points beyond ASCII count as others.
        blank = np.frombuffer(raw, np.uint8) <= 32
        turns = np.flatnonzero(blank[1:] != blank[:-1])
        if len(raw) >= LONG_STRETCH and np.diff(turns, prepend=-1, append=len(raw) - 1).max() >= LONG_STRETCH:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def align(self, text: str, second: list[int]) -> Aligned | None:
        """The alignment of a text whose second encoding is given; None where either encoding loses bytes."""
        raw = b" " + text.encode()
        if b"".join([self.bytes_b[i] for i in second]) != raw:
            return None
        a, b = np.array(self.encode_first(" " + text, raw), np.int64), np.array(second, np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # A byte-level encoding cuts the text and changes nothing, or it has no ids for some bytes.
        if ends_a[-1] != len(raw):
            return None
        index_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1)))
        index_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1)))
        cuts = sorted(index_a.keys() & index_b.keys())
        n = len(cuts)
        ends_a = np.fromiter(map(index_a.__getitem__, cuts), np.int64, n)
        ends_b = np.fromiter(map(index_b.__getitem__, cuts), np.int64, n)
        return Aligned(a, b, ends_a, ends_b, cuts)

    def show(self, found: Aligned) -> str:
        """Groups as text: ids of A, a bar, ids of B; groups separated by semicolons."""
        sizes_a, sizes_b = np.diff(found.ends_a, prepend=0), np.diff(found.ends_b, prepend=0)
        out = np.empty(len(found.a) + len(found.b), object)
        last_a, last_b = np.zeros(len(found.a), np.int64), np.zeros(len(found.b), np.int64)
        last_a[found.ends_a - 1], last_b[found.ends_b - 1] = len(self.bytes_a), len(self.bytes_b)
        out[np.arange(len(found.a)) + np.repeat(found.ends_b - sizes_b, sizes_a)] = self.shown_a[found.a + last_a]
        out[np.arange(len(found.b)) + np.repeat(found.ends_a, sizes_b)] = self.shown_b[found.b + last_b]
        return "".join(out.tolist())[:-1]


def links(found: Aligned) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct id pairs of all links of a text, how often each is linked, and the number of links."""
    sizes_a, sizes_b = np.diff(found.ends_a, prepend=0), np.diff(found.ends_b, prepend=0)
    starts_a, starts_b = found.ends_a - sizes_a, found.ends_b - sizes_b
    products = sizes_a * sizes_b
    ends = np.cumsum(products)
    parts, done = [], 0
    while done < len(products):
        # A slice of groups; one group with more links than that is unfolded from its distinct ids.
        before = ends[done - 1] if done else 0
        upto = max(int(np.searchsorted(ends, before + LINKS_AT_ONCE, "right")), done + 1)
        if upto == done + 1 and products[done] > LINKS_AT_ONCE:
            ids_a, n_a = np.unique(found.a[starts_a[done]:found.ends_a[done]], return_counts=True)
            ids_b, n_b = np.unique(found.b[starts_b[done]:found.ends_b[done]], return_counts=True)
            parts.append((((ids_a << SECOND_BITS)[:, None] | ids_b[None, :]).ravel(), (n_a[:, None] * n_b[None, :]).ravel()))
        else:
            n = products[done:upto]
            group = np.repeat(np.arange(done, upto), n)
            at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            width = sizes_b[group]
            row = at // width
            keys = found.a[starts_a[group] + row] << SECOND_BITS | found.b[starts_b[group] + at - row * width]
            parts.append(np.unique(keys, return_counts=True))
        done = upto
    if len(parts) > 1:
        keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, back, np.concatenate([t for _, t in parts]))
    else:
        keys, times = parts[0]
    return keys, times, int(ends[-1])


_pairs: dict[tuple[str, str], TokenizerPair] = {}


def load(first: str, second: str) -> TokenizerPair:
    """Both tokenizers, read once per process."""
    if (first, second) not in _pairs:
        _pairs[first, second] = TokenizerPair(first, second)
    return _pairs[first, second]


def align(docs: DataFrame, first: str, second: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, groups, cuts, n_links, pairs, times: one row per input row.

    ``groups`` shows the ids of both sides (``a1,a2|b1;a3|b2,b3``) and ``cuts`` the byte ends of the groups in a blank
    and the text. ``pairs`` are the distinct linked id pairs as one number each (see :func:`id_pair`) and ``times`` how
    often the text links them. Texts that are null or empty, or that either tokenizer does not give back byte by byte,
    have zeros, an empty text and empty lists. Repeated rows are aligned alike; other columns are not read. A text is
    worked through as a whole, whatever its length. Both files must be readable by every executor.
    """
    kind = dict(docs.select(column(id_column).alias("k")).dtypes)["k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(first, second)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).fill_null("")
            for part in slices(texts):
                rows = texts.slice(part.first, part.last - part.first).to_pylist()
                n_a, n_b, n_links, shown, cuts, pairs, times = [], [], [], [], [], [], []
                for text, ids in zip(rows, both.second.encode(rows, num_threads=1)):
                    found = both.align(text, ids) if text else None
                    if found is None:
                        values = 0, 0, 0, "", [], [], []
                    else:
                        linked, often, total = links(found)
                        values = len(found.a), len(found.b), total, both.show(found), found.cuts, linked, often
                    for to, value in zip((n_a, n_b, n_links, shown, cuts, pairs, times), values):
                        to.append(value)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(part.first, part.last - part.first), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                     pa.array(n_links, pa.int64()), pa.array(shown, pa.large_string()).cast(pa.string()),
                     _lists(cuts, pa.int32()), _lists(pairs, pa.int64()), _lists(times, pa.int64())],
                    ["doc_id", "n_a", "n_b", "n_links", "groups", "cuts", "pairs", "times"])

    return docs.select(column(id_column).alias("doc_id"), column(text_column).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_links long, groups string, cuts array<int>, pairs array<long>, "
             "times array<long>")


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    bounds = np.cumsum([0, *[len(v) for v in values]])
    flat = np.concatenate([np.asarray(v, np.int64) for v in values]) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int64()).cast(kind))


def id_pair(pair: Column) -> tuple[Column, Column]:
    """The ids of both sides of a pair."""
    return F.shiftright(pair, SECOND_BITS), pair.bitwiseAND((1 << SECOND_BITS) - 1)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n, best: how many rows link an id pair, and whether no pair of the same A id has more."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per id of B in a window.
    most = F.max("n").over(Window.partitionBy(id_pair(F.col("pair"))[0]))
    return counted.withColumn("best", F.col("n") == most)


def with_counts(aligned: DataFrame, carried: list[str], frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """``carried`` columns, n_best and count_sum of every row of a stored table with pairs and times.

    ``n_best`` adds up the links whose pair is the most frequent of its A id, ``count_sum`` the counts of all links.
    """
    rows = stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent)
    linked = rows.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "_row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    told = linked.join(F.broadcast(top), "pair", "left")
    rest = told.where("n is null").select("pair", "_row", "times").join(counts.join(F.broadcast(top), "pair", "left_anti"), "pair")

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    both = sums(told.where("n is not null")).unionByName(sums(rest)).groupBy("_row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.select("_row", *carried).join(both, "_row", "left").select(
        *carried, F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"))
