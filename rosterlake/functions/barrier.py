"""Evaluating costly expressions once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(rows: DataFrame, *columns: Column, keep: list[str] | None = None) -> DataFrame:
    """``rows`` (or its columns ``keep``) plus named ``columns``, each evaluated once per row.

    A filter on a projected column is normally moved below the projection and evaluates the
    expression a second time. Columns that come out of a generator are not seen through.
    """
    kept = rows.columns if keep is None else keep
    return rows.select(*kept, F.inline(F.array(F.struct(*columns))))
