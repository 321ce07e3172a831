"""Broadcasts that are checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows and bytes that every task can hold comfortably.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def has_at_most(rows: DataFrame, bound: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``rows`` has at most ``bound`` rows and ``size`` bytes, texts counted with their length.

    Reads no more than the bound from any partition.
    """
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in rows.dtypes if kind == "string"]
    width = F.lit(8 * len(rows.columns)).cast("bigint")
    for t in texts:
        width = width + t
    found = rows.select(width.alias("width")).limit(bound + 1).agg(F.count("*").alias("n"), F.sum("width").alias("bytes")).first()
    return found["n"] <= bound and (found["bytes"] or 0) <= size
