"""Text analysis: word tokens and edge n-grams."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

MAX_GRAM = 20  # Fixed value: longest edge n-gram.

_SEPARATORS = r"[^\p{L}\p{N}]+"
_IDEOGRAPH = r"([\p{IsHan}\p{IsHiragana}])"
# Letters, digits, marks and underscores; a letter run continues over . : ' and similar marks
# between letters, a digit run over . , ; ' between digits; ideographs stand alone.
_STANDARD_WORD = (
    r"[\p{IsHan}\p{IsHiragana}]"
    r"|[\p{L}\p{N}\p{M}_&&[^\p{IsHan}\p{IsHiragana}]]+"
    r"(?:(?:(?<=\p{L})[.:'‘’·](?=\p{L})|(?<=\p{N})[.,;'](?=\p{N}))"
    r"[\p{L}\p{N}\p{M}_&&[^\p{IsHan}\p{IsHiragana}]]+)*"
)


def tokens(text: Column, rules: str = "runs", cjk_unigrams: bool = False) -> Column:
    """Lower-cased words of ``text`` in order, as an array.

    ``runs``: maximal runs of letters and digits. ``standard``: closer to Unicode word
    segmentation (keeps ``l'hospitalet``, ``csc_1004`` and ``3.14`` whole, splits ideographs).
    """
    lowered = F.lower(text)
    if rules == "standard":
        words = F.regexp_extract_all(lowered, F.lit(f"({_STANDARD_WORD})"), F.lit(1))
        return F.filter(words, lambda w: w.rlike(r"[\p{L}\p{N}]"))
    if rules != "runs":
        raise ValueError(f"unknown word rules: {rules!r}")
    if cjk_unigrams:
        lowered = F.regexp_replace(lowered, _IDEOGRAPH, " $1 ")
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def edge_ngrams(word: Column, max_gram: int = MAX_GRAM) -> Column:
    """Prefixes of ``word`` with 1 to ``max_gram`` characters, as an array."""
    lengths = F.sequence(F.lit(1), F.least(F.lit(max_gram), F.length(word)))
    return F.transform(lengths, lambda n: F.substring(word, F.lit(1), n))


def query_tokens(spark: SparkSession, text: str, **rules) -> list[str]:
    """Tokens of one request text, analysed by the same expression as the indexed text."""
    return spark.range(1).select(tokens(F.lit(text), **rules).alias("t")).first()["t"]


SIMILAR_HEAD = 7    # characters of a word whose deletions are looked up
SIMILAR_EDITS = 2   # edits up to which similar words are found by common deletions


def _less_one(word: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(word))
    shorter = F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(F.length(word) > 0, shorter).otherwise(F.array().cast("array<string>"))


def head_of(word: Column) -> Column:
    """The characters of a word whose deletions are looked up."""
    return F.substring(word, F.lit(1), F.lit(SIMILAR_HEAD))


def deletions(word: Column) -> Column:
    """What is left of the head of a word after up to two characters are deleted, in all ways, as an array.

    Words within two edits of each other (or adjacent swaps) have a common deletion.
    """
    head = F.array(head_of(word))
    once = F.flatten(F.transform(head, _less_one))
    twice = F.flatten(F.transform(once, _less_one))
    return F.array_distinct(F.concat(head, once, twice))


def word_deletions(word: str) -> list[str]:
    """The same for a word of a request."""
    found = level = {word[:SIMILAR_HEAD]}
    for _ in range(SIMILAR_EDITS):
        level = {w[:i] + w[i + 1:] for w in level for i in range(len(w))}
        found = found | level
    return sorted(found)
