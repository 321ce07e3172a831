"""Delimited profile files: twelve ``|``-separated fields, lazy quotes, no header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.barrier import computed
from ..functions.parsing import strict_double, strict_int, strict_long
from ..schema import CORRUPT, DELIMITED_COLUMNS, NUMERIC_CHECK_ORDER
from .rejects import split_rejects

_PARSERS = {
    "pnum": strict_long, "lon": strict_double, "lat": strict_double,
    "weight": strict_int, "height": strict_int, "country": strict_int, "gender": strict_int,
}


def scan(spark: SparkSession, path: str | list[str], strict_width: bool = False) -> DataFrame:
    """All fields as text, plus the raw line in ``_corrupt_record`` where the width is wrong.

    Lines stay the unit of work, so files split; a quote left open rejects its own line only.
    ``strict_width`` fails the job on the first row of another width.
    """
    fields = [T.StructField(c, T.StringType()) for c in DELIMITED_COLUMNS]
    # The width check needs every field tokenised, also when a query uses only a few of them.
    reader = (
        spark.read.option("sep", "|").option("quote", '"').option("escape", '"')
        .option("unescapedQuoteHandling", "STOP_AT_CLOSING_QUOTE")
        .option("columnPruning", "false")
    )
    if strict_width:
        return (
            reader.option("mode", "FAILFAST").schema(T.StructType(fields)).csv(path)
            .withColumn(CORRUPT, F.lit(None).cast("string"))
        )
    schema = T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema).csv(path)
    )


def reject_reason() -> Column:
    """Why a row is refused, or null: the width first, then the first numeric field that fails.

    Reads the raw columns next to their parsed values ``_<name>``.
    """
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong_field_count"))
    for name in NUMERIC_CHECK_ORDER:
        reason = reason.when(F.col(f"_{name}").isNull(), F.lit(f"bad_{name}"))
    return reason


def type_rows(raw: DataFrame) -> DataFrame:
    """Scanned rows with ``reason``, the raw ``line`` of refused rows, typed profile columns and the
    ``suspect_location`` flag.

    Empty text stays empty text (the scan reads it as null). A zero coordinate is kept but flagged.
    """
    parsed = computed(raw, *[parse(F.col(name)).alias(f"_{name}") for name, parse in _PARSERS.items()])
    text = {name: F.coalesce(F.col(name), F.lit("")) for name in DELIMITED_COLUMNS}
    reason = reject_reason()
    line = F.coalesce(F.col(CORRUPT), F.concat_ws("|", *text.values()))
    return parsed.select(
        reason.alias("reason"),
        F.when(reason.isNotNull(), line).alias("line"),
        F.col("_pnum").alias("id"),
        text["email"].alias("email"),
        text["dob"].alias("dob"),
        F.col("_weight").alias("weight"),
        F.col("_height").alias("height"),
        text["nickname"].alias("nickname"),
        F.col("_country").alias("country"),
        text["city"].alias("city"),
        text["caption"].alias("caption"),
        F.struct(F.col("_lon").alias("lon"), F.col("_lat").alias("lat")).alias("location"),
        F.col("_gender").alias("gender"),
        ((F.col("_lon") == 0) | (F.col("_lat") == 0)).alias("suspect_location"),
    )


def read_profiles(spark: SparkSession, path: str | list[str],
                  strict_width: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed profiles and rejected rows; the latter carry ``reason`` and the raw ``line``."""
    return split_rejects(type_rows(scan(spark, path, strict_width)))
