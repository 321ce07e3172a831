"""Rows that a reader refuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows (without ``reason`` and ``line``) and refused rows."""
    return (
        rows.where(F.col("reason").isNull()).drop("reason", "line"),
        rows.where(F.col("reason").isNotNull()),
    )


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.where(F.col("reason").isNotNull()).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rejects"))
