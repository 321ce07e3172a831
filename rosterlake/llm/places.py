"""Places of rows in a sorted order, without ever bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .graphs import stored


def placed(rows: DataFrame, group: str, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` plus ``place``: 0, 1, ... within ``group`` (not null) in ``order``, and ``n``, the size of the group.

    Rows are dealt by ranges of the whole order, so a group may lie over many tasks and a task hold many groups. Equal
    rows are told apart by where they came from, hence even copies of one row are spread. The sorted rows are
    written; then each task's share of a group (one row per task and group) is enough to number all of them.
    """
    order = [F.col(group), *order]
    ties = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    laid = ties.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, "_tie").drop("_tie")
    laid = stored(laid.withColumn("_at", F.monotonically_increasing_id()), label)
    task = F.shiftright("_at", 33)
    shares = laid.groupBy(F.col(group).alias("_group"), task.alias("_task")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_share"))
    whole = Window.partitionBy("_group")
    shares = shares.select(
        "_group", "_task", F.sum("_share").over(whole).alias("n"),
        (F.sum("_share").over(whole.orderBy("_task")) - F.col("_share") - F.col("_first")).alias("_shift"))
    numbered = laid.join(shares, (F.col(group) == F.col("_group")) & (task == F.col("_task")))
    return numbered.withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_group", "_task", "_shift")
