"""Most frequent values of a field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import tokens

BUCKETS = 10  # Fixed value: number of buckets returned by default.


def _top(counts: DataFrame, size: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc("key")).limit(size)


def facet_values(rows: DataFrame, field: str, size: int = BUCKETS) -> DataFrame:
    """(key, count) of whole values, most frequent first; missing values are left out.

    Counts are exact: partial counts per task, one shuffle on the value, then a bounded top list.
    """
    counts = (
        rows.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _top(counts, size)


def facet_tokens(rows: DataFrame, field: str, size: int = BUCKETS, **rules) -> DataFrame:
    """(key, count) of words; a document counts once per word however often it repeats it."""
    counts = (
        rows.select(F.explode(F.array_distinct(tokens(F.col(field), **rules))).alias("key"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("count"))
    )
    return _top(counts, size)


def facet_terms(term_stats: DataFrame, size: int = BUCKETS) -> DataFrame:
    """The same from the term statistics of a field that is indexed already: no text is read."""
    return _top(term_stats.select(F.col("term").alias("key"), F.col("df").alias("count")), size)


def epoch_millis(day: Column) -> Column:
    """Midnight UTC of a date in milliseconds since the epoch, whatever the session time zone."""
    return F.unix_date(day.cast("date")).cast("bigint") * 86_400_000


def facet_dates(rows: DataFrame, field: str, size: int = BUCKETS) -> DataFrame:
    """(key, count) of dates; the key is the day in epoch milliseconds."""
    day = F.col(field).cast("date")
    counts = (
        rows.where(F.col(field).isNotNull()).groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(epoch_millis(F.col("day")).alias("key"), "count")
    )
    return _top(counts, size)
