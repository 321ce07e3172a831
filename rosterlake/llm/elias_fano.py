"""Elias-Fano sequences and a three-level n-gram trie made of them, in arrays that are mapped from a file.

A sequence of n increasing numbers below u keeps the low log2(u / n) bits of each packed and the rest in unary, about
two bits more a number. Both access and the search for a successor work on whole arrays of questions.

The trie holds contexts v, their successors w, their predecessors u, and the successors of (u, v). The children of a
node are numbers in increasing order; a level is one sequence over all nodes, in which the children of a node are
written relative to the last number before them. A child of a node is found as the successor of its number on that
base. Words after (u, v) are written as places among the words after v, which are fewer. Pointers from a node to its
children increase too and are a sequence as well. Probabilities are 16-bit codes of negative logarithms.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
AT_ONCE = 1 << 15  # n-grams looked up together
WRITTEN = 1 << 16  # numbers written together, a multiple of 64 so that they end with a word


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each word, by halving."""
    at = np.zeros(len(words), U64)
    k = k.astype(U64)
    for width in (32, 16, 8, 4, 2, 1):
        lower = np.bitwise_count((words >> at) & U64((1 << width) - 1)).astype(U64)
        beyond = lower <= k
        k -= np.where(beyond, lower, U64(0))
        at += np.where(beyond, U64(width), U64(0))
    return at.astype(np.int64)


def _first_one(words: np.ndarray) -> np.ndarray:
    """Place of the lowest one of each word, 64 where there is none."""
    return np.bitwise_count((words & (~words + U64(1))) - U64(1)).astype(np.int64)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` bits of numbers one after the other in 64-bit words."""
    out = np.zeros((len(values) * bits + 63) // 64 + 1, U64)
    if not bits:
        return out
    for begin in range(0, len(values), WRITTEN):
        some = values[begin:begin + WRITTEN].astype(U64) & U64((1 << bits) - 1)
        at = np.arange(begin, begin + len(some), dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(U64)
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[firsts]] = np.add.reduceat(some << shift, firsts)
        over = np.flatnonzero((at & 63) + bits > 64)
        out[word[over] + 1] |= some[over] >> (U64(64) - shift[over])
    return out


def _unpacked(words: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(at), np.int64)
    first = at * bits
    word, shift = first >> 6, (first & 63).astype(U64)
    value = words[word] >> shift
    over = np.flatnonzero((first & 63) + bits > 64)
    value[over] |= words[word[over] + 1] << (U64(64) - shift[over])
    return (value & U64((1 << bits) - 1)).astype(np.int64)


class Sequence:
    """Numbers in increasing order (equal ones allowed) as Elias-Fano arrays."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones
        self._ones = np.asarray(ones).astype(np.int64)
        self._zeros = np.arange(len(ones)) * 64 - self._ones
        self._last = int(self._select(np.array([n - 1]), False)[0]) - (n - 1) if n else -1

    @classmethod
    def of(cls, values: np.ndarray) -> "Sequence":
        values = np.asarray(values, np.int64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low = _packed(values, bits)
        high = np.zeros(((int(values[-1]) >> bits) + n + 1 if n else 1) + 63 >> 6, U64)
        for begin in range(0, n, WRITTEN):
            place = (values[begin:begin + WRITTEN] >> bits) + np.arange(begin, min(n, begin + WRITTEN))
            firsts = np.flatnonzero(np.diff(place >> 6, prepend=-1))
            # Numbers before these may lie in their first word.
            high[place[firsts] >> 6] |= np.add.reduceat(U64(1) << (place & 63).astype(U64), firsts)
        # Ones before each word, in 32 bits where they fit.
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(n, bits, low, high, ones.astype(np.uint32 if n < 1 << 32 else np.int64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"shape": np.array([self.n, self.bits], np.int64), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def over(cls, arrays: dict[str, np.ndarray]) -> "Sequence":
        n, bits = arrays["shape"].tolist()
        return cls(n, bits, arrays["low"], arrays["high"], arrays["ones"])

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the k-th one, or zero, of the unary part."""
        counts = self._zeros if zeros else self._ones
        word = np.searchsorted(counts, k, "right") - 1
        words = self.high[word]
        return word * 64 + _select_in_word(~words if zeros else words, k - counts[word])

    def _next(self, place: np.ndarray, zeros: bool, k: np.ndarray) -> np.ndarray:
        """Place of the first one, or zero, after each place; it is the k-th."""
        place = place + 1
        word, bit = place >> 6, (place & 63).astype(U64)
        inside = np.flatnonzero(word < len(self.high))
        words = np.zeros(len(place), U64)
        words[inside] = self.high[word[inside]]
        ahead = (~words if zeros else words) >> bit
        out = place + _first_one(ahead)
        far = np.flatnonzero(ahead == 0)
        out[far] = self._select(k[far], zeros)
        return out

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        if not len(at):
            return np.zeros(0, np.int64)
        return (self._select(at, False) - at) << self.bits | _unpacked(self.low, self.bits, at)

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at some places and at the places after them."""
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = self._select(at, False)
        after = self._next(place, False, at + 1)
        return ((place - at) << self.bits | _unpacked(self.low, self.bits, at),
                (after - at - 1) << self.bits | _unpacked(self.low, self.bits, at + 1))

    def successor(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place whose number is not below each target, n where there is none, and whether it is equal."""
        out, equal = np.full(len(target), self.n, np.int64), np.zeros(len(target), bool)
        if not self.n:
            return out, equal
        # A bucket of equal high parts lies between two zeros; no number has a higher part than the last.
        high = target >> self.bits
        asked = np.flatnonzero(high <= self._last)
        high, low = high[asked], target[asked] & ((1 << self.bits) - 1)
        before = np.where(high > 0, self._select(np.maximum(high - 1, 0), True), -1)
        begin, end = before - high + 1, self._next(before, True, high) - high
        last = end.copy()
        # Inside a bucket the low parts increase.
        while True:
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                break
            middle = (begin[open_] + end[open_]) >> 1
            below = _unpacked(self.low, self.bits, middle) < low[open_]
            begin[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]
        inside = np.flatnonzero(begin < last)
        equal[asked[inside]] = _unpacked(self.low, self.bits, begin[inside]) == low[inside]
        out[asked] = begin
        return out, equal


class Children:
    """The children of consecutive nodes: numbers that increase inside a node, found by context-relative successors."""

    def __init__(self, numbers: Sequence, pointers: Sequence):
        self.numbers, self.pointers = numbers, pointers

    @classmethod
    def of(cls, numbers: np.ndarray, starts: np.ndarray) -> "Children":
        """``starts`` has the first child of every node and, last, the number of all children; nodes may have none."""
        spans = np.zeros(len(starts) - 1, np.int64)
        some = np.flatnonzero(np.diff(starts))
        spans[some] = numbers[starts[some + 1] - 1] + 1
        based = np.repeat(np.cumsum(spans) - spans, np.diff(starts))
        based += numbers
        return cls(Sequence.of(based), Sequence.of(starts))

    def open(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place of the children of each node, the place after the last, and the base of their numbers."""
        first, last = self.pointers.pairs(node)
        base = np.zeros(len(node), np.int64)
        inner = np.flatnonzero(first > 0)
        base[inner] = self.numbers[first[inner] - 1] + 1
        return first, last, base

    def find(self, opened: tuple[np.ndarray, np.ndarray, np.ndarray], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each question whether the opened node has this child, and the child's place."""
        first, last, base = opened
        at, equal = self.numbers.successor(base + number)
        return equal & (at >= first) & (at < last), at


def write(path_or_file, arrays: dict[str, np.ndarray]) -> None:
    """All arrays in one file, each from a multiple of 64 bytes on, after a line that says where."""
    places, at = {}, 0
    for name, array in arrays.items():
        places[name] = [str(array.dtype), len(array), at]
        at += array.nbytes + -array.nbytes % 64
    head = json.dumps(places).encode() + b"\n"
    head = head[:-1] + b" " * (-len(head) % 64) + b"\n"
    path_or_file.write(head)
    for array in arrays.values():
        path_or_file.write(array.tobytes())
        path_or_file.write(b"\0" * (-array.nbytes % 64))
    path_or_file.flush()


def mapped(file) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped and not read."""
    file.seek(0)
    head = file.readline()
    return {
        name: np.memmap(file, kind, "r", len(head) + at, (size,)) if size else np.zeros(0, kind)
        for name, (kind, size, at) in json.loads(head).items()}


@dataclass
class Trie:
    """Contexts v with successors and predecessors, and the successors of (u, v), each with a code."""

    contexts: Sequence
    context_codes: np.ndarray
    after: Children
    after_codes: np.ndarray
    before: Children
    before_codes: np.ndarray
    third: Children
    third_codes: np.ndarray

    LEVELS = ("after", "before", "third")

    def arrays(self) -> dict[str, np.ndarray]:
        out = {f"contexts.{k}": v for k, v in self.contexts.arrays().items()} | {"context_codes": self.context_codes}
        for level in self.LEVELS:
            children = getattr(self, level)
            out |= {f"{level}.numbers.{k}": v for k, v in children.numbers.arrays().items()}
            out |= {f"{level}.pointers.{k}": v for k, v in children.pointers.arrays().items()}
            out[f"{level}_codes"] = getattr(self, f"{level}_codes")
        return out

    @classmethod
    def over(cls, arrays: dict[str, np.ndarray]) -> "Trie":
        def sequence(name: str) -> Sequence:
            return Sequence.over({k: arrays[f"{name}.{k}"] for k in ("shape", "low", "high", "ones")})

        levels = [x for level in cls.LEVELS for x in (
            Children(sequence(f"{level}.numbers"), sequence(f"{level}.pointers")), arrays[f"{level}_codes"])]
        return cls(sequence("contexts"), arrays["context_codes"], *levels)

    def look(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, unseen: np.ndarray) -> np.ndarray:
        """Code of every w after (u, v); ``unseen`` is the code of w by itself.

        A word that does not follow its context costs the context's own code and what it costs after the shorter one.
        """
        out = np.empty(len(w), np.int64)
        for at in range(0, len(w), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            out[part] = self._look(u[part], v[part], w[part], unseen[part])
        return out

    def _look(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, unseen: np.ndarray) -> np.ndarray:
        out = unseen.astype(np.int64)
        # Questions that follow each other often share their context, which is then looked up once.
        firsts, of = _repeats(v)
        node, there = self.contexts.successor(v[firsts])
        known = np.flatnonzero(there[of])
        if not len(known):
            return out
        opened_after = self.after.open(node[there])
        opened_before = self.before.open(node[there])
        of = (np.cumsum(there) - 1)[of[known]]
        node = node[there][of]
        u, v, w = u[known], v[known], w[known]
        first = opened_after[0][of]
        follows, child = self.after.find(tuple(x[of] for x in opened_after), w)
        code = out[known] + self.context_codes[node]
        code[follows] = self.after_codes[child[follows]]
        firsts, of_pair = _repeats(v, u)
        preceded, pair = self.before.find(tuple(x[of[firsts]] for x in opened_before), u[firsts])
        longer = np.flatnonzero(preceded[of_pair])
        better = code[longer] + self.before_codes[pair[of_pair[longer]]]
        both = np.flatnonzero(follows[longer])
        asked = longer[both]
        opened = self.third.open(pair[preceded])
        of_open = (np.cumsum(preceded) - 1)[of_pair[asked]]
        there, deep = self.third.find(tuple(x[of_open] for x in opened), child[asked] - first[asked])
        better[both[there]] = self.third_codes[deep[there]]
        code[longer] = better
        out[known] = code
        return out


def _repeats(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows begin, and the run of each row."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1
