"""Autocomplete: names whose words start with what was typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import query_tokens, tokens
from .bounded import BROADCAST_ROWS, has_at_most
from .scoring import page, page_per_query
from .search import AnyOf, Word, match_many, search
from .textindex import TextIndex

SUGGESTIONS = 20  # Fixed value: length of a suggestion list.


def suggest(index: TextIndex, field: str, typed: str, names: DataFrame, key: str, name: str,
            size: int = SUGGESTIONS) -> DataFrame:
    """(rank, name) of the best matches for the typed text; equal names of different rows all count.

    ``index`` is built by :meth:`TextIndex.over_prefixes`. The typed words are taken whole and must
    equal a stored prefix, so one lookup per word replaces a scan for names that start with it.
    """
    if not typed:
        raise ValueError("the typed text must not be empty")
    words = query_tokens(index.postings.sparkSession, typed)
    if not words:
        return names.limit(0).select(F.lit(0).alias("rank"), F.col(name).alias("name"))
    hits = search(index, field, AnyOf(tuple(Word(w) for w in words)))
    ranked = page_per_query(page(hits, size).withColumn("query_id", F.lit(0)), size)
    if size <= BROADCAST_ROWS:
        ranked = F.broadcast(ranked)
    return (
        names.select(F.col(key).alias("doc_id"), F.col(name).alias("name"))
        .join(ranked, "doc_id").select("rank", "name")
    )


def with_echo(suggestions: DataFrame, typed: str) -> DataFrame:
    """The typed text as rank 0, followed by the suggestions; duplicates stay."""
    echo = suggestions.sparkSession.range(1).select(F.lit(0).alias("rank"), F.lit(typed).alias("name"))
    return echo.unionByName(suggestions)


def suggest_many(index: TextIndex, field: str, typed: DataFrame, names: DataFrame, key: str, name: str,
                 query_id: str = "query_id", text: str = "query", size: int = SUGGESTIONS) -> DataFrame:
    """(query_id, rank, name) for a table of typed texts."""
    ranked = page_per_query(match_many(index, field, typed, query_id, text, tokens), size)
    if has_at_most(typed, BROADCAST_ROWS // max(size, 1)):
        # The names of the whole table then stay where they are.
        ranked = F.broadcast(ranked)
    return (
        names.select(F.col(key).alias("doc_id"), F.col(name).alias("name"))
        .join(ranked, "doc_id").select("query_id", "rank", "name")
    )
