"""Language-model scores of texts from an n-gram trie whose levels are Elias-Fano sequences.

The model has three orders. After one and after two words the count of a word is smoothed by the next shorter order,
p(w|c) = (n(c w) + mu p(w|shorter c)) / (n(c) + mu). A frequent word by itself has its add-0.1 share of all training
tokens; all other words are a class that shares its mass evenly, or, with ``each_rare``, have their own shares too. Negative logarithms are kept as 16-bit codes, so
scores are sums of whole numbers and do not depend on the order of addition.

The trie grows with the corpus, and so do the tasks: it is cut into parts by the word v before the scored one.

1. Words are counted over all texts. The most frequent ones, a fixed number, are numbered and sent to all tasks; all
   others go by a hash.
2. Texts are worked through in chunks of a bounded number of tokens. A chunk sends its trigrams to the parts, one
   message for each part, and its rare words to the parts that count those. A trigram that many texts of a chunk share
   is sent once, as a question of the chunk.
3. A part gathers the counts of its n-grams from all messages, builds its trie in a mapped file, answers the messages
   from it and sends sums per text back to the chunks.

A word that would fill a part by itself is split over several by the word that follows; the totals of its contexts,
which then lie in several parts, are counts of pairs in the parts of the words before, and are sent on from there.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bytetext import BLANK_BYTE, LOWERED, U64, Hasher, mixed, runs, slices
from .common import column
from .elias_fano import Children, Sequence, Trie, mapped, write
from .graphs import stored

END = np.array([0x5EED0E4D], np.int64)  # stands for the end of a text among the hashes of words
CODES_PER_DECADE = 4096
ROWS_AT_ONCE = 1 << 18                  # n-grams of a part for which wide numbers are held together
HASH_BITS = 62                          # bits of the hash by which n-grams name a rare word
COUNT = -1                              # in place of a context: what follows is a rare word and its count


@dataclass(frozen=True)
class Settings:
    smoothing: float = 16.0        # mu: how many observations the shorter context counts for
    frequent: int = 1 << 18        # words that are numbered and sent to all tasks
    chunk_tokens: int = 1_000_000  # tokens of a chunk; a longer text is a chunk by itself
    part_tokens: int = 2_000_000   # tokens that a part of the trie answers for
    shared_texts: int = 4          # a trigram in more texts of a chunk than this is sent once
    each_rare: bool = False        # a rare word by itself has its own share, not that of its class


# -- packed numbers ------------------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length of numbers that are not negative: byte planes, compressed. The first may increase."""
    n = len(columns[0])
    parts = [np.array([n, len(columns)], np.int64).tobytes()]
    for values in columns:
        values = np.asarray(values, np.int64)
        rising = n > 1 and bool((np.diff(values) >= 0).all())
        if rising:
            values = np.diff(values, prepend=0)
        planes = max(1, (int(values.max()).bit_length() + 7) // 8) if n else 1
        raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :planes].T) if n else np.zeros(0, np.uint8)
        # Planes repeat single bytes; longer matches are rare and cost more to look for than they save.
        packer = zlib.compressobj(1, strategy=zlib.Z_RLE)
        done = packer.compress(raw.tobytes()) + packer.flush()
        parts += [np.array([planes, rising, len(done)], np.int64).tobytes(), done]
    return b"".join(parts)


def unpack(data: bytes | memoryview, which: tuple[int, ...] | None = None) -> list[np.ndarray]:
    """The columns, or those of the places ``which``; the others are not decompressed."""
    n, count = np.frombuffer(data, np.int64, 2).tolist()
    at, out = 16, {}
    for c in range(count):
        planes, rising, size = np.frombuffer(data, np.int64, 3, at).tolist()
        if which is None or c in which:
            raw = np.frombuffer(zlib.decompress(data[at + 24:at + 24 + size]), np.uint8)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :planes] = raw.reshape(planes, n).T
            values = wide.reshape(-1).view(np.int64)
            out[c] = np.cumsum(values) if rising else values
        at += 24 + size
    return [out[c] for c in (range(count) if which is None else which)]


# -- tokens --------------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the lower-cased words of texts and of their ends in a row, and the number of tokens of each text."""
    for part in slices(texts):
        data = LOWERED[part.data]
        begin, end = runs(~BLANK_BYTE[data], part.offsets)
        words = mixed(Hasher(data)(begin, end)).view(np.int64)
        of_text = np.searchsorted(part.offsets, begin, "right") - 1
        # Empty texts share an offset; a word belongs to the last text that begins there.
        counts = np.bincount(of_text, minlength=part.last - part.first)[:part.last - part.first]
        ends = np.cumsum(counts)
        yield np.insert(words, ends, END), counts + 1


@dataclass
class Chunk:
    """Texts in a row: their keys, tokens as places in the list of different words, tokens of each, which are learned from."""

    serial: int
    keys: pa.Array
    words: np.ndarray
    body: np.ndarray
    size: np.ndarray
    learns: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Chunk]:
    """Texts (key, text, learn) of a task as chunks of about ``most`` tokens."""
    from pyspark import TaskContext

    serial = TaskContext.get().partitionId() << 33
    parts, held = [], 0

    def together() -> Chunk:
        keys, hashes, size, learns = zip(*parts)
        words, body = np.unique(np.concatenate(hashes), return_inverse=True)
        return Chunk(serial, pa.concat_arrays(keys), words, body, np.concatenate(size), np.concatenate(learns))

    for batch in batches:
        at = 0
        learns = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        for found, size in tokens(batch.column(1)):
            rows = slice(at, at + len(size))
            parts.append((batch.column(0).slice(at, len(size)), found, size, learns[rows]))
            at += len(size)
            held += len(found)
            if held >= most:
                yield together()
                serial += 1
                parts, held = [], 0
    if parts:
        yield together()


# -- 1. vocabulary -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words by number, in the order of their tokens in all texts, and totals of the training texts."""

    hashes: np.ndarray    # hashes of the frequent words, increasing
    numbers: np.ndarray   # their numbers
    times: np.ndarray     # training tokens by number
    all_times: np.ndarray  # tokens in all texts by number
    size: int             # different training words
    tokens: int           # training tokens
    texts: int            # training texts
    all_tokens: int
    all_texts: int

    @property
    def start(self) -> int:
        """Number that stands for what is before a text."""
        return len(self.times)

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Number of each hash, or what a rare word goes by."""
        if not len(self.hashes):
            return 1 + (words & ((1 << HASH_BITS) - 1))
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.numbers[at], self.start + 1 + (words & ((1 << HASH_BITS) - 1)))

    def _among(self, table: np.ndarray, before: int, ids: np.ndarray) -> np.ndarray:
        """Counts of frequent words and of what is before a text; 0 for rare words."""
        return np.append(table, [before, 0])[np.minimum(ids, self.start + 1)]

    @property
    def weight(self) -> float:
        """What add-0.1 counts are divided by."""
        return self.tokens + 0.1 * (self.size + 1)

    def share(self, ids: np.ndarray) -> np.ndarray:
        """Probability of a word by itself in the model; words that no training text has are one of the rare class."""
        rare_words = self.size - np.count_nonzero(self.times)
        rare = (self.tokens - self.times.sum() + 0.1 * (rare_words + 1)) / (rare_words + 1)
        times = self._among(self.times, 0, ids)
        return np.where(times > 0, times + 0.1, rare) / self.weight

    def pieces(self, ids: np.ndarray, part_tokens: int) -> np.ndarray:
        """Over how many parts the trigrams around a word are dealt."""
        return np.maximum(1, -(-2 * self._among(self.all_times, self.all_texts, ids) // part_tokens))

    def split(self, ids: np.ndarray, part_tokens: int) -> np.ndarray:
        return self.pieces(ids, part_tokens) > 1

    def contexts(self, ids: np.ndarray) -> np.ndarray:
        """How often frequent words, and what is before a text, come before a training token."""
        return self._among(self.times, self.texts, ids)


def vocabulary(texts: DataFrame, settings: Settings) -> tuple[Vocabulary, DataFrame | None]:
    """Words of (key, text, learn) counted, and the other words, as n-grams name them, with their training tokens (id, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, settings.chunk_tokens):
            learned = np.repeat(chunk.learns, chunk.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.words), pa.array(np.bincount(chunk.body, minlength=len(chunk.words))),
                 pa.array(np.bincount(chunk.body[learned], minlength=len(chunk.words)))], ["word", "all_times", "times"])

    counted = stored(texts.mapInArrow(count, "word long, all_times long, times long").groupBy("word").agg(
        F.sum("all_times").alias("all_times"), F.sum("times").alias("times")), "lm-words")
    end = F.col("word") == int(END[0])
    totals = counted.agg(
        F.count_if(F.col("times") > 0).alias("size"), F.sum("times").alias("tokens"), F.sum("all_times").alias("all_tokens"),
        F.max(F.when(end, F.col("times"))).alias("texts"), F.max(F.when(end, F.col("all_times"))).alias("all_texts")).first()
    top = counted.orderBy(F.desc("all_times"), "word").limit(settings.frequent).toArrow()
    word = top.column("word").to_numpy()
    order = np.argsort(word)
    words = Vocabulary(word[order], order, top.column("times").to_numpy(), top.column("all_times").to_numpy(),
                       *(totals[c] or 0 for c in ("size", "tokens", "texts", "all_tokens", "all_texts")))
    if len(word) < settings.frequent:
        return words, None
    rare = counted.where("times > 0")
    if len(word):
        least, last = int(words.all_times[-1]), int(word[-1])
        rare = rare.where((F.col("all_times") < least) | ((F.col("all_times") == least) & (F.col("word") > last)))
    name = F.col("word").bitwiseAND(F.lit((1 << HASH_BITS) - 1)) + F.lit(words.start + 1)
    return words, rare.groupBy(name.alias("id")).agg(F.sum("times").alias("n"))


def codes(probability: np.ndarray) -> np.ndarray:
    return np.rint(-np.log10(probability) * CODES_PER_DECADE).astype(np.int64)


# -- 2. messages ---------------------------------------------------------------------------------


@dataclass
class Trigrams:
    """What a chunk asks: words before, the word, and for whom; texts first, then questions of the chunk."""

    u: np.ndarray
    v: np.ndarray
    w: np.ndarray
    slot: np.ndarray
    times: np.ndarray     # how often the slot counts the answer
    learned: np.ndarray   # training occurrences


def _with_contexts(w: np.ndarray, size: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two words before every token of texts in a row."""
    v, u = np.roll(w, 1), np.roll(w, 2)
    first = np.cumsum(size) - size
    v[first] = u[first] = start
    second = first[size > 1] + 1
    u[second] = start
    return u, v


def _runs_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(sorted_columns[0]), bool)
    if len(new):
        new[0] = True
        for c in sorted_columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _order_of_small(values: np.ndarray) -> np.ndarray:
    """Order of numbers that are not negative, equal ones as they were; those of 16 bits are sorted without comparing them."""
    return np.argsort(values.astype(np.uint16) if len(values) and values.max() < 1 << 16 else values, kind="stable")


def _order(*columns: np.ndarray, kind: str | None = "stable") -> np.ndarray:
    """Order of rows by columns that are not negative, the first one first, equal rows as they were unless ``kind`` differs.

    Columns are put together in as few numbers per row as hold them.
    """
    keys, used = [], 64
    for c in columns:
        bits = int(c.max()).bit_length() if len(c) else 0
        if used + bits > 63:
            keys.append(np.asarray(c, np.int64))
            used = bits
        else:
            keys[-1] = keys[-1] << bits | c
            used += bits
    return np.argsort(keys[0], kind=kind) if len(keys) == 1 else np.lexsort(keys[::-1])


def gather(u: np.ndarray, v: np.ndarray, w: np.ndarray, text: np.ndarray, learns: np.ndarray, shared: int,
           ) -> tuple[Trigrams, np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams of a chunk, and the shared questions of its texts: text, question, how often."""
    order = _order(v, u, w)
    u, v, w, text = u[order], v[order], w[order], text[order]
    # Tokens come in the order of their texts, and both ways of sorting keep it.
    first = _runs_of(v, u, w, text)
    times = np.diff(first, append=len(text))
    u, v, w, text = u[first], v[first], w[first], text[first]
    learned = np.where(learns[text], times, 0)
    group = _runs_of(v, u, w)
    texts_in = np.diff(group, append=len(text))
    many = np.flatnonzero(texts_in > shared)
    asked = np.repeat(texts_in > shared, texts_in)
    asker, question, how_often = text[asked], np.repeat(np.arange(len(many)), texts_in[many]), times[asked]
    sums = np.add.reduceat(learned, group)[many] if len(many) else np.zeros(0, np.int64)
    kept, lead = np.flatnonzero(~asked), group[many]
    n = len(learns)
    both = np.concatenate([kept, lead])
    out = Trigrams(u[both], v[both], w[both], np.concatenate([text[kept], n + np.arange(len(many))]),
                   np.concatenate([times[kept], np.ones(len(many), np.int64)]), np.concatenate([learned[kept], sums]))
    return out, asker, question, how_often


def part_of(v: np.ndarray, w: np.ndarray, words: Vocabulary, parts: int, part_tokens: int) -> np.ndarray:
    """The part that answers for w after v."""
    return _part(v, mixed(w.astype(U64)) % words.pieces(v, part_tokens).astype(U64), parts)


def _part(v: np.ndarray, piece: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(mixed(v.astype(U64)) + piece.astype(U64)) % U64(parts)).astype(np.int64)


OWN, TRIGRAMS, RARE = range(3)


def _sent(chunk: Chunk, words: Vocabulary, parts: int, settings: Settings, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Messages of a chunk to the parts, and what it keeps for itself: counts and the questions of its texts."""
    n = len(chunk.size)
    text = np.repeat(np.arange(n), chunk.size)
    by_word = words.ids(chunk.words)
    # The different numbers in order, last what is before a text: rows are sorted by their places there.
    ids, place = np.unique(by_word, return_inverse=True)
    ids = np.append(ids, words.start)
    frequent = (by_word < words.start)[chunk.body]
    times = words._among(words.times, 0, by_word)[chunk.body]
    base = np.bincount(text[frequent], np.log10((times[frequent] + 0.1) / words.weight), n)
    known = np.bincount(text[frequent], times[frequent] > 0, n).astype(np.int64)
    messages = []

    rare = np.flatnonzero(~frequent)
    if len(rare):
        # Tokens come in the order of their texts, and sorting keeps it.
        order = rare[np.argsort(chunk.body[rare], kind="stable")]
        word, slot = chunk.body[order], text[order]
        first = _runs_of(word, slot)
        often = np.diff(first, append=len(order))
        word, slot = chunk.words[word[first]], slot[first]
        to = (word.view(U64) % U64(parts)).astype(np.int64)
        for p, mine in _dealt(to):
            halves = word[mine].view(U64)
            messages.append((p, RARE, pack((halves >> U64(32)).astype(np.int64), (halves & U64(0xFFFFFFFF)).astype(np.int64),
                                           slot[mine], often[mine], often[mine] * chunk.learns[slot[mine]])))

    w = place[chunk.body]
    u, v = _with_contexts(w, chunk.size, len(ids) - 1)
    asked, asker, question, often = gather(u, v, w, text, chunk.learns, settings.shared_texts)
    asked.u, asked.v, asked.w = ids[asked.u], ids[asked.v], ids[asked.w]
    for p, mine in _dealt(part_of(asked.v, asked.w, words, parts, settings.part_tokens)):
        messages.append((p, TRIGRAMS, pack(asked.v[mine], asked.u[mine], asked.w[mine], asked.slot[mine], asked.times[mine],
                                           asked.learned[mine])))
    own = base.tobytes(), pack(chunk.size, known), pack(question, asker, often)
    messages.append((chunk.serial % parts, OWN, b"".join([np.array([len(x) for x in own], np.int64).tobytes(), *own])))
    keys = pa.ListArray.from_arrays(pa.array([0] * len(messages) + [n], pa.int32()), chunk.keys.cast(kind))
    yield pa.RecordBatch.from_arrays(
        [pa.array([m[0] for m in messages], pa.int32()), pa.array([chunk.serial] * len(messages), pa.int64()),
         pa.array([m[1] for m in messages], pa.int32()), keys, pa.array([m[2] for m in messages], pa.binary())],
        ["part", "chunk", "kind", "keys", "payload"])


def _dealt(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows that go to each part, in their order."""
    order = _order_of_small(to)
    first = _runs_of(to[order])
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(to[order[a]]), order[a:b]


# -- 3. parts ------------------------------------------------------------------------------------


def _numbers(n: int) -> np.ndarray:
    """0 to n - 1, in 32 bits where they fit: most of what a part holds are places."""
    return np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)


def build(u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray, words: Vocabulary, settings: Settings,
          totals: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray | None = None, shares: np.ndarray | None = None) -> Trie:
    """The trie of training trigrams, distinct and ordered by (v, u, w), that occur ``n`` times.

    Occurrences of a context (v, u) are their sum. ``totals`` (v, u, n) has contexts whose words may lie in other
    parts as well: they are in the trie, with those occurrences, whether or not any of their words is. With ``ids`` all
    words are given as places there, in whose order their ``shares`` are.
    """
    firsts = _runs_of(v, u)
    pair_v, pair_u, pair_n = v[firsts], u[firsts], np.add.reduceat(n, firsts) if len(n) else n
    pair_of = np.repeat(_numbers(len(firsts)), np.diff(firsts, append=len(v)))
    if len(totals[0]):
        own = len(pair_v)
        pair_v, pair_u, pair_n = (np.concatenate(both) for both in zip((pair_v, pair_u, pair_n), totals))
        order = _order(pair_v, pair_u)
        firsts = _runs_of(pair_v[order], pair_u[order])
        sizes = np.diff(firsts, append=len(order))
        merged = _numbers(len(order))
        merged[order] = np.repeat(_numbers(len(firsts)), sizes)
        pair_of = merged[:own][pair_of]
        # A total comes after what the part itself has of the context.
        pair_v, pair_u, pair_n = pair_v[order[firsts]], pair_u[order[firsts]], pair_n[order[firsts + sizes - 1]]
    starts = _runs_of(pair_v)
    context = pair_v[starts]
    # A word that is split has only some of its contexts' occurrences here.
    context_n = np.add.reduceat(pair_n, starts) if len(starts) else pair_n
    named = context if ids is None else ids[context]
    context_n = np.where(words.split(named, settings.part_tokens), words.contexts(named), context_n)
    mu = settings.smoothing
    by_next = _order(v, w, kind=None)
    next_v, next_w = v[by_next], w[by_next]
    firsts = _runs_of(next_v, next_w)
    next_v, next_w = next_v[firsts], next_w[firsts]
    next_n = np.add.reduceat(n[by_next], firsts) if len(n) else n
    next_of = _numbers(len(v))
    next_of[by_next] = np.repeat(_numbers(len(firsts)), np.diff(firsts, append=len(v)))
    del by_next, firsts
    after_starts = np.append(np.searchsorted(next_v, context), len(next_v))
    p2 = (next_n + mu * (words.share(next_w) if shares is None else shares[next_w])) / (context_n[np.searchsorted(context, next_v)] + mu)
    third_starts = np.cumsum(np.concatenate([[0], np.bincount(pair_of, minlength=len(pair_v))]))
    p3_codes, place = np.empty(len(v), np.uint16), _numbers(len(v))
    for at in range(0, len(v), ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        p3_codes[part] = codes((n[part] + mu * p2[next_of[part]]) / (pair_n[pair_of[part]] + mu))
        # Words after (u, v) are written as places among the words after v.
        place[part] = next_of[part] - after_starts[np.searchsorted(context, v[part])]
    del pair_of, next_of
    return Trie(
        Sequence.of(context), codes(mu / (context_n + mu)).astype(np.uint16),
        Children.of(next_w, after_starts), codes(p2).astype(np.uint16),
        Children.of(pair_u, np.append(starts, len(pair_v))), codes(mu / (pair_n + mu)).astype(np.uint16),
        Children.of(place, third_starts), p3_codes)


V, U, W, SLOT, TIMES, LEARNED = range(6)  # columns of the trigrams in a message


def _payloads(messages: pa.Table, kind: int) -> tuple[list[int], list[memoryview]]:
    """Chunks and payloads of the messages of one kind; payloads are not copied."""
    mine = np.flatnonzero(messages.column("kind").to_numpy() == kind)
    payload = messages.column("payload")
    return messages.column("chunk").to_numpy()[mine].tolist(), [memoryview(payload[int(i)].as_buffer()) for i in mine]


def _lengths(payloads: list[memoryview]) -> list[int]:
    return [int(np.frombuffer(data, np.int64, 1)[0]) for data in payloads]


def _in_a_row(payloads: list[memoryview], column: int, kind: type = np.int64) -> np.ndarray:
    """One column of all messages; only one message of it is held twice."""
    lengths = _lengths(payloads)
    out, at = np.empty(sum(lengths), kind), 0
    for data, size in zip(payloads, lengths):
        out[at:at + size] = unpack(data, (column,))[0]
        at += size
    return out


def _rare_words(messages: pa.Table, words: Vocabulary) -> pa.Table:
    """The rare words that a part is asked for."""
    found = [np.zeros(0, np.int64)]
    for data in _payloads(messages, TRIGRAMS)[1]:
        w, = unpack(data, (W,))
        found.append(np.unique(w[w > words.start]))
    asked = np.unique(np.concatenate(found))
    part = messages.column("part")[0].as_py() if messages.num_rows else 0
    return pa.table({"part": pa.array(np.full(len(asked), part), pa.int32()), "id": asked})


def _totals(messages: pa.Table, words: Vocabulary, part_tokens: int, parts: int) -> pa.Table:
    """For words that are dealt over several parts, how often each word comes before them, for each of those parts."""
    found = [(np.zeros(0, np.int64),) * 3]
    dealt = np.append(words.split(np.arange(words.start + 1), part_tokens), False)
    for data in _payloads(messages, TRIGRAMS)[1]:
        # The word after the context is the one whose occurrences are counted here, after the word before it.
        u, v, learned = unpack(data, (V, W, LEARNED))
        counted = np.flatnonzero((learned > 0) & dealt[np.minimum(v, words.start + 1)])
        found.append((u[counted], v[counted], learned[counted]))
    u, v, learned = (np.concatenate(c) for c in zip(*found))
    order = _order(v, u)
    u, v = u[order], v[order]
    first = _runs_of(v, u)
    n = np.add.reduceat(learned[order], first) if len(first) else learned
    u, v = u[first], v[first]
    pieces = words.pieces(v, part_tokens)
    row = np.repeat(np.arange(len(v)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    to = np.unique(np.stack([row, _part(v[row], piece, parts)]), axis=1)
    return pa.table({"part": pa.array(to[1], pa.int32()), "v": v[to[0]], "u": u[to[0]], "n": n[to[0]]})


def _answered(messages: pa.Table, totals: tuple, words: Vocabulary, settings: Settings) -> pa.Table:
    """Sums per slot for every message of a part; what chunks keep for themselves is passed on."""
    out = [(c, RARE, data) for c, data in _rare_answers(messages, words)]
    out += [(c, TRIGRAMS, data) for c, data in _trigram_answers(messages, totals, words, settings)]
    mine = pa.table({"chunk": pa.array([o[0] for o in out], pa.int64()), "kind": pa.array([o[1] for o in out], pa.int32()),
                     "keys": pa.nulls(len(out), messages.schema.field("keys").type), "payload": pa.array([o[2] for o in out], pa.binary())})
    own = messages.filter(pa.array(messages.column("kind").to_numpy() == OWN)).select(["chunk", "kind", "keys", "payload"])
    return pa.concat_tables([mine, own.cast(mine.schema)])


def _rare_answers(messages: pa.Table, words: Vocabulary) -> Iterator[tuple[int, bytes]]:
    chunk, payloads = _payloads(messages, RARE)
    if not payloads:
        return
    high, low, slot, often, learned = (_in_a_row(payloads, c) for c in range(5))
    order = _order(high, low)
    first = _runs_of(high[order], low[order])
    times = np.add.reduceat(learned[order], first)
    each = np.empty(len(slot), np.int64)
    each[order] = np.repeat(times, np.diff(first, append=len(order)))
    yield from _rare_sums(chunk, _lengths(payloads), slot, often, each, words)


def _trigram_answers(messages: pa.Table, totals: tuple, words: Vocabulary, settings: Settings) -> Iterator[tuple[int, bytes]]:
    """Sums per slot of every message. A part is held as 32-bit places of its words; what a message brings besides is
    read when it is answered."""
    chunk, payloads = _payloads(messages, TRIGRAMS)
    if not payloads:
        return
    if words.texts and words.split(np.array([words.start]), settings.part_tokens)[0]:
        # Nothing comes before what is before a text.
        totals = tuple(np.append(t, x) for t, x in zip(totals, (words.start, words.start, words.texts)))
    counted = totals[0] == COUNT
    rare, rare_n = totals[1][counted], totals[2][counted]
    totals = tuple(t[~counted] for t in totals)
    # Inside a part words are numbered in the order of their ids, which keeps the numbers of the trie small.
    columns = [_numbered(_in_a_row(payloads, c)) for c in (V, U, W)]
    lists = [*(own for own, _ in columns), totals[0], totals[1]]
    ids, at = _numbered(np.concatenate(lists))
    at = np.split(at, np.cumsum([len(x) for x in lists])[:-1])
    v, u, w = (of_own[place] for of_own, (_, place) in zip(at, columns))
    totals = (at[3].astype(np.int64), at[4].astype(np.int64), totals[2])
    del columns, lists, at
    shares = words.share(ids)
    if settings.each_rare:
        times = words._among(words.times, 0, ids)
        times[np.searchsorted(ids, rare)] = rare_n
        shares = (times + 0.1) / words.weight

    order = _order(v, u, w, kind=None)
    v, u, w = v[order], u[order], w[order]
    first = _runs_of(v, u, w)
    of = _numbers(len(order))
    of[order] = np.repeat(_numbers(len(first)), np.diff(first, append=len(order)))
    v, u, w = v[first], u[first], w[first]
    # A chunk learns fewer than 2^31 occurrences, a text being shorter than 2^31 bytes.
    n = np.add.reduceat(_in_a_row(payloads, LEARNED, np.int32)[order], first, dtype=np.int64)
    del order, first
    learnt = n > 0
    n = n[learnt]
    trie = build(u[learnt], v[learnt], w[learnt], n, words, settings, totals, ids, shares)
    with tempfile.TemporaryFile() as file:
        write(file, trie.arrays())
        del trie, learnt, n
        trie, unseen, found = Trie.over(mapped(file)), codes(shares), np.empty(len(w), np.int32)
        for at in range(0, len(w), ROWS_AT_ONCE):
            part = slice(at, at + ROWS_AT_ONCE)
            found[part] = trie.look(*(c[part].astype(np.int64) for c in (u, v, w)), unseen[w[part]])
        del trie, u, v, w
    at = 0
    for c, data in zip(chunk, payloads):
        slot, often = unpack(data, (SLOT, TIMES))
        order = _order_of_small(slot)
        first = _runs_of(slot[order])
        answers = found[of[at:at + len(slot)]] * often
        yield c, pack(slot[order][first], np.add.reduceat(answers[order], first))
        at += len(slot)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in order, and the place of every number among them."""
    order = np.argsort(values)
    values = values[order]
    first = _runs_of(values)
    place = _numbers(len(order))
    place[order] = np.repeat(_numbers(len(first)), np.diff(first, append=len(order)))
    return values[first], place


def _rare_sums(chunk: list[int], lengths: list[int], slot: np.ndarray, often: np.ndarray, times: np.ndarray,
               words: Vocabulary) -> Iterator[tuple[int, bytes]]:
    """Per slot of every message, known tokens and the base score, as the bits of a double."""
    score = np.log10((times + 0.1) / words.weight) * often
    at = 0
    for c, size in zip(chunk, lengths):
        mine = slice(at, at + size)
        slots, place = np.unique(slot[mine], return_inverse=True)
        known = np.bincount(place, (times[mine] > 0) * often[mine]).astype(np.int64)
        yield c, pack(slots, known) + np.bincount(place, score[mine]).tobytes()
        at += size


def _summed(answers: pa.Table) -> pa.Table:
    """Counts and sums of the texts of a chunk from all its answers."""
    kinds, payload = answers.column("kind").to_pylist(), answers.column("payload").to_pylist()
    own = kinds.index(OWN)
    kept = payload[own]
    a, b, _ = np.frombuffer(kept, np.int64, 3).tolist()
    base = np.frombuffer(kept, np.float64, a // 8, 24).copy()
    size, known = unpack(kept[24 + a:24 + a + b])
    question, asker, often = unpack(kept[24 + a + b:])
    texts = len(size)
    slots = np.zeros(texts + (int(question.max()) + 1 if len(question) else 0), np.int64)
    # In a fixed order, since the rare words' part of the base score adds up doubles.
    for kind, data in sorted((k, d) for k, d in zip(kinds, payload) if k != OWN):
        if kind == TRIGRAMS:
            slot, sums = unpack(data)
            slots[slot] += sums
        else:
            slot, more = unpack(data)
            known[slot] += more
            base[slot] += np.frombuffer(data, np.float64, len(slot), len(data) - 8 * len(slot))
    np.add.at(slots, asker, slots[texts + question] * often)
    keys = answers.column("keys").combine_chunks().slice(own, 1).flatten()
    return pa.table({"doc_id": keys, "n_tokens": size, "n_known": known, "base_score": base,
                     "score": -slots[:texts] / CODES_PER_DECADE})


# -- scoring -------------------------------------------------------------------------------------


def score(docs: DataFrame, learn: Column, settings: Settings = Settings(), id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    The model is learned from the rows that ``learn`` selects (null: not) and scores all. Texts are lower-cased (A-Z)
    and cut into words between blanks; the end of a text is a token. ``base_score`` adds up the base-10 logarithms of
    the words by themselves, ``score`` those of the model. A null or blank text has one token, its end. Without
    training rows every token has probability 1 by itself. Repeated rows are learned from and scored each. Other
    columns are not read, whatever their names.

    With ``each_rare`` every word by itself has its add-0.1 share; a part is told the counts of the rare words in its
    n-grams. Rare words are told apart by 62 bits of a hash. Codes are rounded to 1/4096 of a decade, at most 0.00013 a token and order.
    """
    texts = docs.select(column(id_column).alias("key"), column(text_column).cast("string").alias("text"), learn.alias("learn"))
    kind = dict(texts.dtypes)["key"]
    words, rare = vocabulary(texts, settings)
    parts = max(1, -(-words.all_tokens // settings.part_tokens))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, settings.chunk_tokens):
            yield from _sent(chunk, words, parts, settings, chunk.keys.type)

    answer = f"chunk long, kind int, keys array<{kind}>, payload binary"
    sent = texts.mapInArrow(send, f"part int, {answer}")
    above = []
    if words.split(np.arange(words.start + 1), settings.part_tokens).any():
        above.append(sent.groupBy("part").applyInArrow(
            lambda messages: _totals(messages, words, settings.part_tokens, parts), "part int, v long, u long, n long"))
    if settings.each_rare and rare is not None:
        asked = sent.groupBy("part").applyInArrow(lambda messages: _rare_words(messages, words), "part int, id long")
        above.append(asked.join(rare, "id").select("part", F.lit(COUNT).cast("long").alias("v"), F.col("id").alias("u"), "n"))
    if above:
        totals = (above[0] if len(above) == 1 else above[0].unionByName(above[1])).withColumnRenamed("part", "to")
        answers = sent.groupBy("part").cogroup(totals.groupBy("to")).applyInArrow(
            lambda messages, above: _answered(messages, tuple(above.column(c).to_numpy() for c in ("v", "u", "n")), words, settings)
            if messages.num_rows else messages.select(["chunk", "kind", "keys", "payload"]), answer)
    else:
        none = (np.zeros(0, np.int64),) * 3
        answers = sent.groupBy("part").applyInArrow(lambda messages: _answered(messages, none, words, settings), answer)
    sums = answers.groupBy("chunk").applyInArrow(
        _summed, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")
