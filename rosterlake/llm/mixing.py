"""Mixing sources to target weights by repeating or thinning their documents.

Word counts are aggregated per source; sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and
share the total by weight. A target stops at three times what its source holds, and what it cannot take is shared
again among the others. Every document is then taken floor(rate) times plus once more when a coin seeded by its
id falls below the fraction of the rate, so reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import column, whole_row, word_count

# Fixed values of the contract.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target.

    Sources are ordered by the level at which they fill up (their cap by weight). Up to the first that does not
    fill, all stop at their caps; the rest share what is left by weight, which is where repeated resharing ends.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int")).alias("weight"),
        F.sum("source_size").over(everything).alias("total"),
        (F.col("source_size") * most).alias("cap"),
    )
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    levels = weighed.select(
        "*",
        (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    ).withColumn("full", F.col("weight").cast(wide) * F.col("left").cast(wide)
                 >= F.col("cap").cast(wide) * F.col("left_weight").cast("decimal(18,0)"))
    # The first source that does not fill up holds the largest remainder among those that do not.
    unfilled = F.when(~F.col("full"), F.struct("left_weight", "left"))
    shared = levels.withColumn("rest", F.max(unfilled).over(everything))
    return shared.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise((F.col("weight") * F.col("rest.left")).cast("double") / F.col("rest.left_weight").cast("double"))
        .alias("target"),
    )


def coin(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = "mix",
        carried: Column | None = None) -> DataFrame:
    """``row`` (all columns of the document, or ``carried``), size, source_size, target, copies: one row per input row.

    Null and empty texts have size 0 and are taken like the others. A null source is a source of its own, null
    ids share one coin, repeated rows are taken alike. An empty table gives an empty table. The table of sources
    is aggregated per task first and joined; its size, not a hint, decides how.
    """
    sized = docs.select(
        (whole_row(docs) if carried is None else carried).alias("row"), column(source_column).alias("source"),
        column(id_column).alias("key"), word_count(column(text_column)).alias("size"))
    targets = source_targets(sized.select("source", "size"), weights, most).withColumnRenamed("source", "of_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("rate", rate)
        .select("row", "size", "source_size", "target",
                (F.floor("rate") + (coin(F.col("key"), seed) < F.col("rate") - F.floor("rate")).cast("long"))
                .alias("copies")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mixture itself: every document as often as it is taken."""
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
