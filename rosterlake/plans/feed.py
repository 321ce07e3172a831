"""A batch feed: read, check, publish, and summarise the run."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..sources import messages

SUMMARY = "metric string, labels map<string,string>, value double"


def summary_rows(spark: SparkSession, source: str, topic: str, read: int, refused: int, sent: int,
                 failed: int, seconds: float, finished: float) -> DataFrame:
    """One row per metric and label."""
    by_source, by_topic = {"source": source}, {"topic": topic}
    rows = [
        ("read_total", by_source, float(read)),
        ("read_total_err", by_source, float(refused)),
        ("sent_total", by_topic, float(sent)),
        ("sent_total_err", by_topic, float(failed)),
        ("feed_duration_seconds", {}, seconds),
        ("feed_last_timestamp_seconds", {}, finished),
    ]
    return spark.createDataFrame(rows, SUMMARY)


def run_feed(rows: DataFrame, publish: Callable[[DataFrame], None], source: str, topic: str,
             metrics_path: str | None = None) -> DataFrame:
    """Publish the usable rows of a typed source (see ``type_rows``) and return the run summary.

    Counting rides along with the write, so the source is read once. Tasks are retried by Spark; if
    the write fails for good, the usable rows count as failed and the error is raised after the
    summary is recorded.
    """
    spark = rows.sparkSession
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count_if(F.col("reason").isNull()).alias("ok"),
        F.count_if(F.col("reason").isNotNull()).alias("refused"),
    )
    begin = time.time()
    error = None
    try:
        publish(messages.to_messages(counted.where(F.col("reason").isNull())))
        counts = seen.get
    except Exception as e:  # noqa: BLE001 - recorded, then raised
        error = e
        tally = rows.agg(F.count_if(F.col("reason").isNull()).alias("ok"),
                         F.count_if(F.col("reason").isNotNull()).alias("refused")).first()
        counts = tally.asDict()
    end = time.time()
    sent, failed = (counts["ok"], 0) if error is None else (0, counts["ok"])
    summary = summary_rows(spark, source, topic, counts["ok"], counts["refused"], sent, failed,
                           end - begin, end)
    if metrics_path:
        summary.write.mode("append").parquet(metrics_path)
    if error is not None:
        raise error
    return summary
