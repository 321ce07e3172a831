"""Last version of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_by_key(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One whole row per key: the one with the greatest ``version`` columns, compared in order.

    A plain aggregation, so every task first reduces its own rows to one per key; a key that holds
    most of the input costs one row per task in the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*rows.columns)
