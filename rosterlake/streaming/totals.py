"""Counts that go on from one micro-batch to the next, and the rows that come too late for them.

Totals per window and key are a table of parts: every batch adds the counts of its own rows, under the names of its
stream and its number, and what was counted before a batch is the sum of all others. A batch that is replayed writes
over itself. Nothing is kept in one task per key: rows are counted where they are, whatever their key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.parts import PartTable, Spec
from .counts import RETENTION, WINDOW, event_time, running_counts
from .jobs import stream_identity

_KEYS = ["window_start", "key"]
_TOTALS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("n", T.LongType()),
])
_CLOCK = T.StructType([T.StructField("name", T.StringType()), T.StructField("latest", T.TimestampType())])


class WindowTotals:
    """Rows per window and key over all batches of all streams, and the latest event time of each batch."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, merge_after: int = 8):
        self.merge_after = merge_after
        self.counts = PartTable(spark, f"{path}/counts", Spec(
            _TOTALS, "key", ("key", "window_start"),
            lambda rows: rows.groupBy("bucket", *_KEYS).agg(F.sum("n").alias("n")), spread=True), buckets, merge_after)
        self.clock = PartTable(spark, f"{path}/clock", Spec(
            _CLOCK, "name", ("name",), lambda rows: rows.groupBy("bucket", "name").agg(F.max("latest").alias("latest"))), 1, 1)

    def before(self, stream: str, batch: int) -> DataFrame:
        """window_start, key, n of all batches but this one."""
        return self.counts.read(without=(stream, batch)).select(*_KEYS, "n")

    def latest_before(self, stream: str, batch: int):
        """The latest event time of all batches but this one; None before the first."""
        return self.clock.read(without=(stream, batch)).agg(F.max("latest").alias("t")).first()["t"]

    def add(self, rows: DataFrame, latest: DataFrame, stream: str, batch: int) -> None:
        """``rows`` (window_start, key) and the ``latest`` event time of a batch, instead of what it wrote before."""
        counted = rows.groupBy("window_start", F.col("key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        self.counts.append(counted, stream, batch, again=True)
        self.clock.append(latest.select(F.lit("latest").alias("name"), "latest"), stream, batch, again=True)

    def settle(self, stream: str, batch: int) -> None:
        """Merge what can be: a batch only starts when all before it are done for good, itself it may be replayed."""
        for table in (self.counts, self.clock):
            if table.merge(self.merge_after, at_most=1, without=(stream, batch)):
                table.clean()

    def read(self) -> DataFrame:
        """window_start, key, count over all batches."""
        return self.counts.read().select(*_KEYS, F.col("n").alias("count"))


def _windowed(rows: DataFrame, ts: str, key: str, width: str) -> DataFrame:
    when = event_time(rows, ts).cast("timestamp")
    window = F.window(when, width)
    return rows.where(F.col(key).isNotNull()).select(
        "*", window["start"].alias("window_start"), window["end"].alias("window_end"), when.alias("_ts"))


def _latest(windowed: DataFrame) -> DataFrame:
    return windowed.agg(F.max("_ts").alias("latest")).where("latest is not null")


def running_count_log(path: str, totals: WindowTotals, checkpoint: str, ts: str, key: str, partition: str | None,
                      offset: str, width: str = WINDOW) -> Callable[[DataFrame, int], None]:
    """Sink that logs every record with the count of its window and key so far, going on over batches and restarts.

    Arrival order is the order of batches and, within one, (partition, offset).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(batch.sparkSession, checkpoint)
        batch = batch.persist()
        try:
            totals.settle(stream, batch_id)
            so_far = totals.before(stream, batch_id).withColumnRenamed("key", "_key")
            inside = running_counts(batch, ts, key, partition, offset, width)
            joined = inside.join(so_far, (inside["window_start"].cast("timestamp") == so_far["window_start"])
                                 & (F.col(key).cast("string") == F.col("_key")), "left")
            out = joined.select(inside["window_start"], key, *([partition] if partition else []), offset,
                                (F.col("running_count") + F.coalesce("n", F.lit(0))).alias("running_count"))
            out.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")
            windowed = _windowed(batch, ts, key, width)
            totals.add(windowed.select("window_start", F.col(key).alias("key")), _latest(windowed), stream, batch_id)
        finally:
            batch.unpersist()

    return write


def late_row_log(path: str, totals: WindowTotals, checkpoint: str, ts: str, key: str, width: str = WINDOW,
                 retention: str = RETENTION) -> Callable[[DataFrame, int], None]:
    """Sink that counts rows per window and key, and logs the rows that come too late with the window they miss.

    A row is late when its window ended ``retention`` or more before the latest event time of the batches before its
    own. Rows counted and rows logged are all rows that have a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(batch.sparkSession, checkpoint)
        batch = batch.persist()
        try:
            totals.settle(stream, batch_id)
            latest = totals.latest_before(stream, batch_id)
            windowed = _windowed(batch, ts, key, width)
            mark = F.lit(latest).cast("timestamp") - F.expr(f"interval {retention}")
            late: Column = F.coalesce(F.col("window_end") <= mark, F.lit(False))
            windowed.where(late).drop("_ts").write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")
            totals.add(windowed.where(~late).select("window_start", F.col(key).alias("key")), _latest(windowed), stream, batch_id)
        finally:
            batch.unpersist()

    return write
