"""Metric labels derived from request fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def path_label(path: Column) -> Column:
    """Path as a metric label: runs of other characters become ``_``, trimmed, lower case, ``root`` if empty."""
    joined = F.regexp_replace(path, "[^a-zA-Z0-9]+", "_")
    label = F.lower(F.btrim(joined, F.lit("_")))
    return F.when(label == "", F.lit("root")).otherwise(label)


def client_label(*candidates: Column) -> Column:
    """First candidate that is neither null nor empty; the last one is taken as it is."""
    *preferred, fallback = candidates
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in preferred], fallback)
