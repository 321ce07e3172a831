"""Profiles from a SQL database through Spark's JDBC source.

No JDBC driver ships with this package; put one on the class path and name it in ``driver``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import DATABASE_COLUMNS
from .rejects import split_rejects


def jdbc_options(url: str, table: str, columns: list[str] | None = None,
                 partition_column: str = "pnum", lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options: named columns only, split by key range when bounds are given."""
    names = ", ".join(columns or DATABASE_COLUMNS)
    options = {
        "url": url,
        "dbtable": f"(select {names} from {table}) profiles",
        "fetchsize": str(fetch_size),
    }
    if driver:
        options["driver"] = driver
    bounds = (lower_bound, upper_bound, num_partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("lower_bound, upper_bound and num_partitions go together")
        options.update(
            partitionColumn=partition_column, lowerBound=str(lower_bound),
            upperBound=str(upper_bound), numPartitions=str(num_partitions),
        )
    return options


# Columns without which a database row cannot become a profile.
REQUIRED_COLUMNS = ["pnum", "country", "longitude", "latitude"]


def first_rows(rows: DataFrame, cap: int | None = None, key: str = "pnum") -> DataFrame:
    """All rows, or the first ``cap`` of them in key order (null keys last), so that reruns take the same rows."""
    return rows if cap is None else rows.orderBy(F.asc_nulls_last(key)).limit(cap)


def rows_cut(rows: DataFrame, cap: int | None) -> int:
    """How many rows a cap leaves out."""
    return 0 if cap is None else max(rows.count() - cap, 0)


def missing_required(columns: list[str] | None = None) -> Column:
    """True where a required column is null."""
    result = F.lit(False)
    for name in columns or REQUIRED_COLUMNS:
        result = result | F.col(name).isNull()
    return result


def type_rows(rows: DataFrame) -> DataFrame:
    """Rows as profiles, with a ``reason`` where a required column is null."""
    email = F.col("email") if "email" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        F.when(missing_required(), F.lit("null_in_required_column")).alias("reason"),
        F.col("pnum").cast("bigint").alias("id"),
        email.alias("email"),
        F.col("dob").cast("string").alias("dob"),
        F.col("weight").cast("int").alias("weight"),
        F.col("height").cast("int").alias("height"),
        F.col("nickname"),
        F.col("country").cast("int").alias("country"),
        F.col("city"),
        F.col("caption"),
        F.struct(F.col("longitude").cast("double").alias("lon"),
                 F.col("latitude").cast("double").alias("lat")).alias("location"),
        F.col("gender").cast("int").alias("gender"),
    )


def scan(spark: SparkSession, url: str, table: str, cap: int | None = None,
         **options) -> DataFrame:
    """Extract of one table: all of it, or the first ``cap`` rows, taken before rows are checked."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return first_rows(rows, cap)


def read_profiles(spark: SparkSession, url: str, table: str, cap: int | None = None,
                  **options) -> tuple[DataFrame, DataFrame]:
    return split_rejects(type_rows(scan(spark, url, table, cap, **options)))
