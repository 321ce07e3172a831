"""Starting streaming queries and their sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.wire import decode_messages
from ..plans.profiles import ProfileTable
from .counts import tumbling_counts


def start(stream: DataFrame, checkpoint: str, sink: str | Callable[[DataFrame, int], None],
          mode: str = "update", name: str | None = None, available_now: bool = False,
          every: str | None = None, **options) -> StreamingQuery:
    """Start a query; ``sink`` is a format such as ``console`` or a function of (batch, batch_id).

    Offsets and state live under ``checkpoint``; starting again on it resumes where the last run ended.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    return writer.start()


def drain(stream: DataFrame, checkpoint: str, sink, **options) -> StreamingQuery:
    """Process everything that is available, then stop."""
    query = start(stream, checkpoint, sink, available_now=True, **options)
    query.awaitTermination()
    return query


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; a fresh checkpoint has another one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def parquet_log(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the output of every batch of every stream in its own folder.

    A replayed batch overwrites itself and nothing else; a stream with a fresh checkpoint adds its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(batch.sparkSession, checkpoint)
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")

    return write


def latest_counts(log: DataFrame, key: str) -> DataFrame:
    """Final count per window and key from a log of updates; counts only grow."""
    return log.groupBy("window_start", "window_end", key).agg(F.max("count").alias("count"))


def country_counts(messages: DataFrame, **options) -> DataFrame:
    """Profiles per country and window, from a message stream or batch (``value``, ``timestamp``).

    Messages that do not decode strictly are left out, and so are profiles without a country. Event time
    is the time of the message.
    """
    good, _ = decode_messages(messages.select("value", "timestamp"), unknown_fields="reject")
    return tumbling_counts(good, "timestamp", "country", **options)


def index_profiles(messages: DataFrame, table: ProfileTable, checkpoint: str,
                   dead_letters: str | None = None,
                   after: Callable[[DataFrame, int], None] | None = None, **options) -> StreamingQuery:
    """Decode a message stream (``value``, ``timestamp`` and, from a topic, ``partition`` and
    ``offset``) and upsert it into the serving table.

    A batch is committed to the table before its offsets are, and the table skips batches it has from the
    same stream, so a restart neither loses nor repeats an update, and a second stream or a fresh checkpoint
    loses nothing. Records without ``partition`` and ``offset`` are
    ordered by time only. ``after`` is called with the decoded profiles of a batch once they are stored,
    for example to refresh a search index with their current rows; it may be called again for a batch
    that is replayed.
    """
    present = set(messages.columns)
    stamped = messages.select(
        "value",
        F.col("timestamp").alias("_ts"),
        (F.col("partition") if "partition" in present else F.lit(0)).cast("int").alias("_partition"),
        (F.col("offset") if "offset" in present else F.lit(0)).cast("bigint").alias("_offset"),
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(batch.sparkSession, checkpoint)
        reread = dead_letters or after
        if reread:
            batch.persist()
        try:
            good, dead = decode_messages(batch)
            table.upsert(good, batch_id, stream)
            if dead_letters:
                dead.write.mode("overwrite").parquet(f"{dead_letters}/stream={stream}/batch={batch_id}")
            if after:
                after(good, batch_id)
        finally:
            if reread:
                batch.unpersist()

    return start(stamped, checkpoint, sink, mode="append", **options)
