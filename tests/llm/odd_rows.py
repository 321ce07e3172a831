"""Fixtures and rows that the tests of all operators share."""

import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a documents table from (id, text[, lang, source]) rows; n_chars is filled in."""

    def make(rows, extra=()):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text), *[f"x{doc_id}" for _ in extra]))
        return spark.createDataFrame(full, ", ".join([DOCS, *[f"`{e}` string" for e in extra]]))

    return make


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


ODD_TEXTS = [None, "", " \t\n ", "word", "a b", "x" * 70_000, "one two three four five six seven " * 3000,
             "ünïcödé ✓ 漢字     ź \x00 \x1f end", "same text twice", "same text twice"]
