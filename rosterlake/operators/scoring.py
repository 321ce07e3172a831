"""BM25 weights and the order of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# BM25 parameters.
K1 = 1.2
B = 0.75

# Sums of doubles depend on the order of addition, so results are ranked by the rounded score;
# pages then stay stable between runs and equal documents tie exactly.
SCORE_DIGITS = 6


def inverse_document_frequency(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def term_weight(tf: Column, dl: Column, avg_dl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avg_dl))


def check_page(size: int, skip: int) -> None:
    if size < 0 or skip < 0:
        raise ValueError("size and skip must not be negative")


def page(hits: DataFrame, size: int = 100, skip: int = 0, key: str = "doc_id") -> DataFrame:
    """Hits ``skip`` to ``skip + size`` in rank order: score descending, then id."""
    check_page(size, skip)
    ranked = hits.orderBy(F.desc("score"), F.asc(key))
    return (ranked.offset(skip) if skip else ranked).limit(size)


def _first_of(rows: DataFrame, value: Column, skip: int, at_most: int, buckets: int) -> tuple[object, object, int] | None:
    """Where the row after ``skip`` others lies in rising order of a numeric value: the least and greatest value of a
    group of rows that has it, and how many rows come before the group; None if there are so few rows.

    Every round counts rows per bucket of the range that is left, combined per task; it ends at ``at_most`` rows or
    at rows of one value.
    """
    rows, before = rows.select(value.alias("v")), 0
    range_ = rows.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).first()
    low, high, n = range_["low"], range_["high"], range_["n"]
    if skip >= n:
        return None
    while n > at_most and low < high:
        bucket = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(high - low) * buckets), F.lit(buckets - 1))
        found = rows.where(F.col("v").between(low, high)).groupBy(bucket.alias("b")).agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).orderBy("low").collect()  # a row per bucket
        for part in found:
            if before + part["n"] > skip:
                low, high, n = part["low"], part["high"], part["n"]
                break
            before += part["n"]
    return low, high, before


def page_deep(hits: DataFrame, size: int, skip: int, key: str = "doc_id", at_most: int = 10_000, buckets: int = 1024) -> DataFrame:
    """The same page as :func:`page` for a large ``skip`` and a numeric key: rows before it are counted, not ranked.

    The score at which the page begins is found by histograms, and among equal scores the key; ranked are the rows
    from there on, of which a task keeps ``at_most`` and the page.
    """
    check_page(size, skip)
    begin = _first_of(hits, -F.col("score"), skip, at_most, buckets)
    if begin is None:
        return hits.limit(0)
    least, greatest, before = begin
    later = -F.col("score") >= least
    if least == greatest:
        ties = _first_of(hits.where(-F.col("score") == least), F.col(key), skip - before, at_most, buckets)
        later = (-F.col("score") > least) | (later & (F.col(key) >= ties[0]))
        before += ties[2]
    return hits.where(later).orderBy(F.desc("score"), F.asc(key)).offset(skip - before).limit(size)


def page_after(hits: DataFrame, last_score: float, last_key, size: int = 100,
               key: str = "doc_id") -> DataFrame:
    """The page after a known hit; costs the same at any depth, unlike a large ``skip``."""
    check_page(size, 0)
    later = (F.col("score") < last_score) | ((F.col("score") == last_score) & (F.col(key) > last_key))
    return hits.where(later).orderBy(F.desc("score"), F.asc(key)).limit(size)


# Up to this rank Spark itself cuts every task's rows to the best ones before they are shuffled.
EARLY_CUT = 1000


def page_per_query(hits: DataFrame, size: int = 100, skip: int = 0, key: str = "doc_id",
                   query: str = "query_id", slices: int = 64) -> DataFrame:
    """The same page for every query of a table of queries, with its ``rank`` (1 is best).

    A query may match most documents. Up to rank 1000 the ranking filter lets every task drop all
    but its own best rows first; for deeper pages the hits of a query are cut in ``slices`` before
    the final ranking.
    """
    check_page(size, skip)
    last = skip + size
    best = [F.desc("score"), F.asc(key)]
    whole = Window.partitionBy(query).orderBy(*best)
    if last > EARLY_CUT:
        sliced = Window.partitionBy(query, "_slice").orderBy(*best)
        hits = (
            hits.withColumn("_slice", F.pmod(F.xxhash64(F.col(key)), F.lit(slices)))
            .withColumn("_r", F.row_number().over(sliced))
            .where(F.col("_r") <= last).drop("_slice", "_r")
        )
    return (
        hits.withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= last).where(F.col("rank") > skip)
    )


def deep_pages(hits: DataFrame, limits: DataFrame, key: str = "doc_id", query: str = "query_id",
               slices: int = 64) -> DataFrame:
    """Hits with their ``rank`` up to the ``last`` rank that each query asks for itself (``limits``: query, skip, last).

    The hits of a query are cut to its own depth in slices before they are ranked.
    """
    best = [F.desc("score"), F.asc(key)]
    sliced = Window.partitionBy(query, "_slice").orderBy(*best)
    cut = (
        hits.join(limits, query).withColumn("_slice", F.pmod(F.xxhash64(F.col(key)), F.lit(slices)))
        .withColumn("_r", F.row_number().over(sliced)).where(F.col("_r") <= F.col("last")).drop("_slice", "_r")
    )
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*best)))
    return ranked.where(F.col("rank") <= F.col("last"))


def total_hits(hits: DataFrame, cap: int | None = None) -> DataFrame:
    """One row with the number of hits; ``cap`` saturates it, as a search engine does at 10 000."""
    n = F.count(F.lit(1))
    return hits.agg((n if cap is None else F.least(n, F.lit(cap))).alias("total"))
