"""Encoding with a trained piece model, keeping for every piece the bytes of the original text it stands for.

A text is normalised by taking, at each place, the longest prefix that the model's compiled character map knows;
every byte of the result remembers where it came from. Pairs of neighbouring symbols are then merged, best score
first and leftmost among equals, until no pair is a piece; symbols that are no piece fall back to bytes. No piece
goes on past a blank or from a letter to most punctuation, so the stretches between are encoded once and remembered.
Each piece is projected back to the original bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bytetext import slices
from .common import column

# Fixed values of the model format: the mark of a blank, kinds of pieces.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_SURFACE = " ⁇ "
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at:at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over byte strings whose values point at replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4:4 + size]) if size else ()
        self.replacements = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of ``text`` from ``at`` on."""
        if not self.units:
            return None
        found = None
        unit = self.units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for place in range(at, len(text)):
            byte = text[place]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = self.replacements[start:self.replacements.index(0, start)], place + 1 - at
        return found


class PieceModel:
    """A piece model read from its file; encodes, aligns and decodes."""

    def __init__(self, model: bytes):
        pieces, spec, trainer = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only models trained by merging pairs are supported")
        if trainer.get(24, 0):
            raise ValueError("models that mark blanks after the word are not supported")
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        self.ids = {p: (i, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER, UNUSED)}
        self.scores = {p: s for p, (_, s) in self.ids.items()}
        self.shown = {p: (i, len(p.encode()) - 2 * p.count(MARK)) for p, (i, _) in self.ids.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids) or any(k in (USER, UNUSED) for _, _, k in pieces):
            raise ValueError("models with pieces across blanks, user-defined or unused pieces are not supported")
        # Where a letter meets one of these, no piece goes on: stretches may end there too.
        joined = {pair for p in self.ids for pair in zip(p, p[1:])}
        apart = [c for c in map(chr, range(128)) if c != " " and not c.isalpha() and not any(
            (a == c and b.isalpha()) or (b == c and a.isalpha()) for a, b in joined)]
        marks = "[" + re.escape("".join(apart)) + "]" if apart else r"(?!)"
        # The class of letters below also holds signs such as '²'; one that pieces join to such a mark ends nothing.
        odd = sorted({a for pair in joined for a, b in (pair, pair[::-1])
                      if b in apart and not a.isalpha() and re.fullmatch(r"[^\W\d_]", a)})
        ends = "(?<![" + re.escape("".join(odd)) + "])" if odd else ""
        goes_on = "(?![" + re.escape("".join(odd)) + "])" if odd else ""
        self.stretches = re.compile(rf" *[^\W\d_]++{ends}(?={marks})|{marks}++(?=[^\W\d_]){goes_on}| *[^ ]+| +")
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.of_byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.fallback = len(self.of_byte) == 256
        surface = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                   else UNKNOWN_SURFACE.encode() if kind == UNKNOWN else p.replace(MARK, " ").encode()
                   for p, _, kind in pieces]
        self.kinds = np.array([kind for _, _, kind in pieces], np.int8)
        self.surface = surface
        self.surface_length = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.concatenate([[0], np.cumsum(self.surface_length)])[:-1]
        self.surface_bytes = np.frombuffer(b"".join(surface), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Start with no remembered stretches: their places, and the ids and sizes of all in a row."""
        self._known: dict[str, int] = {}
        self._long: list[str] = []
        self._flat_ids, self._flat_sizes, self._bounds = array("i"), array("i"), array("i", [0])

    @property
    def plain(self) -> bool:
        """Whether normalisation changes nothing but blanks."""
        return not self.map.units and not self.squeeze and self.escape and self.fallback and MARK in self.ids

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its bytes (and its end) the place in the original bytes."""
        source = text.encode()
        out, origin, at, end = bytearray(), [], 0, len(source)
        blank = MARK.encode() if self.escape else b" "

        def prefix(place: int) -> tuple[bytes, int]:
            found = self.map.longest(source, place)
            if found:
                return found
            lead = source[place]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return source[place:place + size], size

        if self.squeeze:
            while at < end:
                shown, size = prefix(at)
                if shown != b" ":
                    break
                at += size
        if at == end:
            return "", [at]
        if self.prefix:
            out += blank
            origin += [at] * len(blank)
        after_blank = self.squeeze
        while at < end:
            shown, size = prefix(at)
            if after_blank:
                shown = shown.lstrip(b" ")
            for byte in shown:
                put = blank if byte == 0x20 else bytes([byte])
                out += put
                origin += [at] * len(put)
            if shown:
                after_blank = shown.endswith(b" ")
            at += size
            if not self.squeeze:
                after_blank = False
        if self.squeeze:
            while out.endswith(blank):
                at = origin[len(out) - len(blank)]
                del out[-len(blank):]
                del origin[len(out):]
        origin.append(at)
        return out.decode(), origin

    def merge(self, stretch: str) -> list[str]:
        """Symbols of a stretch after all merges, in order."""
        if len(stretch) <= LONGEST_REMEMBERED:
            return self._merge_short(list(stretch))
        symbols: list[str | None] = list(stretch)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, int, str]] = []
        ids = self.ids

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                both = symbols[a] + symbols[b]
                if both in ids:
                    heapq.heappush(queue, (-ids[both][1], a, b, both))

        for a in range(n - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, both = heapq.heappop(queue)
            if symbols[a] is None or symbols[b] is None or symbols[a] + symbols[b] != both or right[a] != b:
                continue
            symbols[a], symbols[b] = both, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [s for s in symbols if s is not None]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """The same for a few symbols, by looking for the best pair each time."""
        scores, last = self.scores, float("-inf")
        pairs = [scores.get(a + b, last) for a, b in zip(symbols, symbols[1:])]
        while pairs:
            best = max(pairs)
            if best == last:
                break
            at = pairs.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = scores.get(symbols[at - 1] + symbols[at], last)
            if at < len(pairs):
                pairs[at] = scores.get(symbols[at] + symbols[at + 1], last)
        return symbols

    def stretch(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a stretch of normalised text, and how many of its bytes each id covers."""
        ids, sizes = [], []
        for symbol in self.merge(text):
            known = self.ids.get(symbol)
            raw = symbol.encode()
            if known:
                ids.append(known[0])
                sizes.append(len(raw))
            elif self.fallback:
                ids += [self.of_byte[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(raw)]
            elif ids and ids[-1] == self.unknown:
                sizes[-1] += len(raw)
            else:
                ids.append(self.unknown)
                sizes.append(len(raw))
        return ids, sizes

    def _remember(self, stretch: str) -> int:
        """Place of a stretch (blanks unescaped) among the remembered ones."""
        ids, sizes, shown = self._flat_ids, self._flat_sizes, self.shown
        for symbol in self.merge(stretch.replace(" ", MARK)):
            known = shown.get(symbol)
            if known:
                ids.append(known[0])
                sizes.append(known[1])
            else:
                raw = symbol.encode()
                ids.extend([self.of_byte[b] for b in raw])
                sizes.extend([0] * (len(raw) - 1) + [len(raw)])
        self._bounds.append(len(self._flat_ids))
        at = len(self._bounds) - 2
        self._known[stretch] = at
        if len(stretch) > LONGEST_REMEMBERED:
            self._long.append(stretch)
        return at

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of several texts in a row, where each text's ids end, and the original bytes under each id."""
        if len(self._known) > REMEMBERED:
            self._forget()
        known, places, counts = self._known, [], []
        for text in texts:
            found = self.stretches.findall(" " + text if self.prefix else text) if text else []
            places += [known[s] if s in known else self._remember(s) for s in found]
            counts.append(len(found))
        bounds = np.frombuffer(self._bounds, np.int32).astype(np.int64)
        place = np.array(places, np.int64)
        sizes = bounds[place + 1] - bounds[place]
        ends = np.cumsum(sizes)
        pick = np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[place] - (ends - sizes), sizes)
        ids = np.frombuffer(self._flat_ids, np.int32)[pick] if len(pick) else np.zeros(0, np.int32)
        under = np.frombuffer(self._flat_sizes, np.int32)[pick] if len(pick) else np.zeros(0, np.int32)
        text_ends = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        first = text_ends[:-1][np.diff(text_ends) > 0]
        if self.prefix:
            under[first] -= 1
        for stretch in self._long:
            known.pop(stretch, None)
        self._long.clear()
        return ids, text_ends, under

    def encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, begins and ends in original bytes of one text, through the character map."""
        shown, origin = self.normalise(text)
        ids, begins, ends, at = [], [], [], 0
        for part in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", shown):
            part_ids, sizes = self.stretch(part)
            for i, size in zip(part_ids, sizes):
                ids.append(i)
                begins.append(origin[at])
                at += size
                ends.append(origin[at])
        return ids, begins, ends

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of several id lists that lie in a row; bytes that make no character become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        sizes = self.surface_length[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        pick = np.arange(ends[-1]) + np.repeat(self.surface_start[ids] - ends[:-1], sizes)
        raw = self.surface_bytes[pick].tobytes()
        out = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            part = raw[ends[a]:ends[b]]
            kinds = self.kinds[ids[a:b]]
            shown = np.flatnonzero(kinds != CONTROL)
            if len(shown) < b - a and (kinds == BYTE).any():
                # A control piece ends a run of bytes.
                cuts = [0, *np.flatnonzero(np.diff(kinds == CONTROL)) + 1, b - a]
                texts = [raw[ends[a + x]:ends[a + y]] for x, y in zip(cuts[:-1], cuts[1:])]
                first = "".join(map(_characters, texts))
                out.append(first[1:] if self.prefix and kinds[shown[0]] == NORMAL and first[:1] == " " else first)
                continue
            if self.prefix and len(shown) and kinds[shown[0]] == NORMAL and part[:1] == b" ":
                part = part[1:]
            out.append(_characters(part))
        return out


def _characters(raw: bytes) -> str:
    """Text of bytes; each byte that is part of no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        text = raw.decode(errors="surrogateescape")
        return text.translate({c: 0xFFFD for c in range(0xDC80, 0xDD00)})


_models: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file, read once per process."""
    if path not in _models:
        with open(path, "rb") as file:
            _models[path] = PieceModel(file.read())
    return _models[path]


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids, begins, ends: one row per input row; begins and ends are byte offsets into the original text.

    Several bytes of one character share its end; all but the last are empty spans. A null text is empty and has no
    ids. Repeated rows are encoded alike; other columns of the input are not read.
    ``model_path`` must be readable by every executor.
    """

    def run(batches):
        model = load(model_path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).fill_null("")
            for part in slices(texts):
                rows = texts.slice(part.first, part.last - part.first).to_pylist()
                if model.plain and not any(MARK in t for t in rows):
                    ids, text_ends, under = model.encode_plain(rows)
                    total = np.cumsum(under)
                    base = np.concatenate([[0], total])[text_ends[:-1]]
                    ends = total - np.repeat(base, np.diff(text_ends))
                    begins = ends - under
                else:
                    done = [model.encode(t) for t in rows]
                    text_ends = np.cumsum([0, *[len(d[0]) for d in done]])
                    ids, begins, ends = (np.array([x for d in done for x in d[k]], np.int32) for k in range(3))
                lists = [pa.ListArray.from_arrays(pa.array(text_ends, pa.int32()), pa.array(v, pa.int32()))
                         for v in (ids, begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(part.first, part.last - part.first), *lists], ["doc_id", "ids", "begins", "ends"])

    kind = dict(docs.select(column(id_column).alias("k")).dtypes)["k"]
    return docs.select(column(id_column).alias("doc_id"), column(text_column).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` plus decoded, the text of its ids; a null id list decodes to the empty text."""
    names = encoded.columns

    def run(batches):
        model = load(model_path)
        for batch in batches:
            lists = batch.column(names.index(ids_column))
            lists = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            at = 0
            while at < len(lists):
                last = int(np.searchsorted(offsets, offsets[at] + (1 << 18), "right")) - 1
                last = min(max(last, at + 1), len(lists))
                texts = model.decode(flat[offsets[at]:offsets[last]], offsets[at:last + 1] - offsets[at])
                part = batch.slice(at, last - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, "decoded"])
                at = last

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded string"
    return encoded.mapInArrow(run, schema)


def digest(numbers: Column) -> Column:
    """Lower-case hex of the SHA-256 of numbers joined by commas."""
    return F.sha2(F.array_join(numbers.cast("array<string>"), ","), 256)
