"""Readers and publishers; :func:`load_profiles` picks one by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import arrays, database, delimited, messages


def load_profiles(spark: SparkSession, source: str, **options) -> tuple[DataFrame, DataFrame]:
    """Read profiles from ``csv``, ``jdbc``, ``json`` or ``kafka``; returns (profiles, rejects)."""
    if source == "csv":
        return delimited.read_profiles(spark, **options)
    if source == "jdbc":
        return database.read_profiles(spark, **options)
    if source == "json":
        return messages.read_json_profiles(spark, **options)
    if source == "kafka":
        return messages.read_kafka_profiles(spark, **options)
    raise ValueError(f"unknown profile source: {source!r}")


__all__ = ["load_profiles", "arrays", "database", "delimited", "messages"]
