"""Matches on number and date fields; every match scores 1."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.parsing import strict_long
from .bounded import has_at_most


# A whole year, month or day.
PERIOD = "^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"


def is_period(query: Column) -> Column:
    """Whether a text names a year, a month or a day that exists."""
    first = F.concat(query, F.substring(F.lit("0001-01-01"), F.length(query) + 1, F.lit(10)))
    return F.coalesce(query.rlike(PERIOD), F.lit(False)) & F.try_to_date(first, "yyyy-MM-dd").isNotNull() & (
        F.substring(query, 1, 4) != "0000")


def _all_score_one(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", F.lit(1.0))


def match_number(rows: DataFrame, field: str, query: str | int) -> DataFrame:
    """Rows whose integer field equals the query; text that is no integer is an error."""
    if not re.fullmatch(r"[+-]?[0-9]+", str(query)):
        raise ValueError(f"{field} is a number, cannot match {query!r}")
    return _all_score_one(rows.where(F.col(field) == F.lit(int(query))))


def date_period(query: str) -> tuple[datetime.date, datetime.date]:
    """First day and day after the last of ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd``."""
    parts = re.fullmatch(r"([0-9]{4})(?:-([0-9]{2})(?:-([0-9]{2}))?)?", query)
    if not parts:
        raise ValueError(f"not a date: {query!r}")
    year, month, day = (int(p) if p else None for p in parts.groups())
    first = datetime.date(year, month or 1, day or 1)
    if day:
        return first, first + datetime.timedelta(days=1)
    if month:
        return first, datetime.date(year + month // 12, month % 12 + 1, 1)
    return first, datetime.date(year + 1, 1, 1)


def in_period(field: str, query: str) -> Column:
    """Half-open range on the stored column, so that file statistics can skip data."""
    first, after = date_period(query)
    return (F.col(field) >= F.lit(first)) & (F.col(field) < F.lit(after))


def match_date(rows: DataFrame, field: str, query: str) -> DataFrame:
    """Rows whose date lies in the period that a possibly partial date names."""
    return _all_score_one(rows.where(in_period(field, query)))


def match_numbers_many(rows: DataFrame, key: str, fields: list[str], queries: DataFrame) -> DataFrame:
    """(query_id, key, score) for a table of (query_id, field, query): rows whose field equals the number.

    Rows are unfolded to (field, value) pairs, so that requests on all fields share one equi-join.
    """
    wanted = queries.select("query_id", "field", strict_long(F.col("query")).alias("value"))
    pairs = rows.select(key, F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("bigint").alias("value")) for f in fields])))
    if has_at_most(wanted):
        wanted = F.broadcast(wanted)
    return _all_score_one(pairs.join(wanted, ["field", "value"])).select("query_id", key, "score")


def match_dates_many(rows: DataFrame, key: str, field: str, queries: DataFrame) -> DataFrame:
    """(query_id, key, score) for a table of (query_id, query) with possibly partial dates.

    A date is unfolded to its year, month and day as text, which makes the match on a period an
    equi-join too.
    """
    wanted = queries.select("query_id", F.col("query").alias("period"))
    periods = rows.where(F.col(field).isNotNull()).select(
        key, F.explode(F.array(*[F.date_format(field, p) for p in ("yyyy", "yyyy-MM", "yyyy-MM-dd")])).alias("period"))
    if has_at_most(wanted):
        wanted = F.broadcast(wanted)
    return _all_score_one(periods.join(wanted, "period")).select("query_id", key, "score")
