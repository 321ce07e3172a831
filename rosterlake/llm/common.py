"""Small column helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the white space that separates words.
BLANKS = r"[\x20\x09-\x0D]+"


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(rows: DataFrame) -> Column:
    """All columns of a row as one value, so that names added beside it cannot clash."""
    return F.struct(*[column(c) for c in rows.columns])


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of a key written as text, folded; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus
