from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Runner
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, folder) under its name, with its SQL where it has one."""

    def register(run: Runner) -> Runner:
        REGISTRY[name or run.__name__] = Entry(run, sql)
        return run

    return register


def runners() -> dict[str, Runner]:
    return {name: entry.run for name, entry in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {name: entry.sql for name, entry in REGISTRY.items() if entry.sql}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
