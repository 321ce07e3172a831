"""Counts per key in tumbling windows, on batch and streaming input alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WINDOW = "10 seconds"  # Fixed value.
RETENTION = "1 day"  # Fixed value: how long a window takes late records.


def event_time(events: DataFrame, column: str) -> Column:
    """Event time; a stream needs the type with time zone, a batch keeps the one it has."""
    return F.col(column).cast("timestamp") if events.isStreaming else F.col(column)


def tumbling_counts(events: DataFrame, ts: str, key: str, width: str = WINDOW,
                    retention: str = RETENTION) -> DataFrame:
    """(window_start, window_end, key, count) per epoch-aligned window; rows without a key are skipped.

    Rows are counted per task before they move, so a key with a third of all rows costs one partial
    count per task and window. On a stream the watermark drops windows after ``retention``.
    """
    timed = events.where(F.col(key).isNotNull()).select(
        event_time(events, ts).alias("_ts"), F.col(key).alias("_key"))
    if events.isStreaming:
        timed = timed.withWatermark("_ts", retention)
    return (
        timed.groupBy(F.window("_ts", width).alias("_w"), "_key")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            F.col("_key").alias(key),
            "count",
        )
    )


def running_counts(events: DataFrame, ts: str, key: str, partition: str | None, offset: str,
                   width: str = WINDOW, chunk: int = 1_000_000) -> DataFrame:
    """One row per input record with the count of its window and key so far, in arrival order.

    Arrival order is (partition, offset). Records of a window and key are numbered inside chunks of
    ``chunk`` consecutive offsets and shifted by the sizes of the chunks before, so even a key that
    fills its windows alone is never ordered by one task as a whole.
    """
    source = F.lit(0) if partition is None else F.col(partition)
    rows = events.where(F.col(key).isNotNull()).select(
        source.alias("_partition"),
        F.col(offset).alias("_offset"),
        F.col(key).alias("_key"),
        F.window(event_time(events, ts), width)["start"].alias("window_start"),
    ).withColumn("_chunk", F.floor(F.col("_offset") / chunk))
    group = ["window_start", "_key"]
    piece = [*group, "_partition", "_chunk"]
    sizes = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(*group).orderBy("_partition", "_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = sizes.select(*piece, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*piece).orderBy("_offset")
    return (
        rows.withColumn("_i", F.row_number().over(inside))
        .join(before, piece)
        .select(
            "window_start",
            F.col("_key").alias(key),
            *([F.col("_partition").alias(partition)] if partition else []),
            F.col("_offset").alias(offset),
            (F.col("_before") + F.col("_i")).alias("running_count"),
        )
    )
