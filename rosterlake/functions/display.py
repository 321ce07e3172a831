"""Projections for result pages and map markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def kilograms(grams: Column) -> Column:
    return grams / F.lit(1000)


def gender_name(code: Column) -> Column:
    """1 is female, 2 is male; other codes show nothing."""
    return F.when(code == 1, F.lit("female")).when(code == 2, F.lit("male"))


# Columns of the result table, in order.
RESULT_COLUMNS = [
    "nickname", "gender", "dob", "email", "country", "city", "weight", "height", "caption", "score",
]


def result_rows(page: DataFrame) -> DataFrame:
    """Rows of a result page as shown to a reader."""
    shown = {"gender": gender_name(F.col("gender")), "weight": kilograms(F.col("weight"))}
    return page.select(*[shown.get(c, F.col(c)).alias(c) for c in RESULT_COLUMNS if c in page.columns])


def map_markers(page: DataFrame, location: str = "location") -> DataFrame:
    """One marker per row: coordinates, the record as JSON text, and the focus flag."""
    return page.select(
        F.col(f"{location}.lon").alias("lng"),
        F.col(f"{location}.lat").alias("lat"),
        F.to_json(F.struct(*page.columns)).alias("message"),
        F.lit(True).alias("focus"),
    )
