"""Plain-Python models the operators are compared with."""

import math
import re
from collections import Counter
from itertools import product


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


class Corpus:
    def __init__(self, texts):
        self.docs = {i: words(t) for i, t in texts.items() if words(t)}
        self.tf = {i: Counter(ws) for i, ws in self.docs.items()}
        self.df = Counter(w for c in self.tf.values() for w in c)
        self.n = len(self.docs)
        self.avg = sum(map(len, self.docs.values())) / self.n

    def idf(self, df):
        return math.log(1 + (self.n - df + 0.5) / (df + 0.5))

    def norm(self, tf, doc):
        return tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(self.docs[doc]) / self.avg))

    def word(self, w, doc):
        tf = self.tf[doc][w]
        return self.idf(self.df[w]) * self.norm(tf, doc) if tf else None

    def match(self, query):
        out = {}
        for d in self.docs:
            parts = [s for s in (self.word(w, d) for w in words(query)) if s is not None]
            if parts:
                out[d] = sum(parts)
        return out

    def phrase(self, phrase, slop=0):
        out = {}
        for d, ws in self.docs.items():
            at = [[p - k for p, w in enumerate(ws) if w == word] for k, word in enumerate(phrase)]
            if not all(at):
                continue
            ends = {}
            for start in {x for xs in at for x in xs}:
                # Every choice of different occurrences at or after the start; the nearest end counts.
                choices = [
                    max(c) for c in product(*[[x for x in xs if x >= start] for xs in at])
                    if len({x + k for k, x in enumerate(c)}) == len(c)
                ]
                if choices and min(choices) - start <= slop:
                    ends[min(choices)] = max(ends.get(min(choices), start), start)
            if ends:
                f = sum(1 / (1 + e - s) for e, s in ends.items())
                out[d] = sum(self.idf(self.df[w]) for w in phrase) * self.norm(f, d)
        return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kilometres(lat1, lon1, lat2, lon2):
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0087714 * math.asin(math.sqrt(min(1.0, h)))


def swap_edits(a, b):
    """Edit distance in which swapping two adjacent characters is one edit."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]
