"""Labelled counters and cumulative histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Upper bounds of the duration buckets, in seconds.
DURATION_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def labelled_counts(rows: DataFrame, label: str | Column, ok: Column, name: str = "label") -> DataFrame:
    """Successes and failures per label value; partial counts per task, one row per label shuffled."""
    key = (F.col(label) if isinstance(label, str) else label).alias(name)
    return rows.groupBy(key).agg(
        F.count_if(ok).alias("ok"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("err"),
    )


def duration_histogram(rows: DataFrame, labels: list[str], seconds: Column,
                       bounds: list[float] | None = None) -> DataFrame:
    """(labels, le, bucket_count, total_seconds, observations): cumulative counts per upper bound.

    All bounds are counted in one aggregation and unfolded afterwards, so the shuffle carries one
    row per label combination and task.
    """
    bounds = bounds or DURATION_BUCKETS
    names = [f"{b:g}" for b in bounds] + ["+Inf"]
    measured = rows.withColumn("_v", seconds).where(F.col("_v").isNotNull())
    counts = [F.count_if(F.col("_v") <= b).alias(f"_b{i}") for i, b in enumerate(bounds)]
    summed = measured.groupBy(*labels).agg(
        *counts,
        F.count(F.lit(1)).alias("observations"),
        F.sum("_v").alias("total_seconds"),
    )
    columns = [F.col(f"_b{i}") for i in range(len(bounds))] + [F.col("observations")]
    unfolded = F.inline(F.array(*[
        F.struct(F.lit(n).alias("le"), c.alias("bucket_count")) for n, c in zip(names, columns)
    ]))
    return summed.select(*labels, unfolded, "total_seconds", "observations")


def run_times(rows: DataFrame, run: str, ts: str) -> DataFrame:
    """Completion time and duration in seconds of every run."""
    first, last = F.min(ts), F.max(ts)
    seconds = (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 1e6
    return rows.groupBy(run).agg(last.alias("completed_at"), seconds.alias("duration_seconds"))
