"""Labelled counters of running streams, collected from their progress events."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(stream: DataFrame, name: str, ok: Column) -> DataFrame:
    """The stream unchanged; every batch reports how many rows passed and failed under ``name``."""
    return stream.observe(
        name, F.count_if(ok).alias("ok"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("err"))


class StreamCounters(StreamingQueryListener):
    """Adds up the counts of all batches; register with ``spark.streams.addListener``."""

    def __init__(self):
        self._lock = threading.Lock()
        self._totals: dict[str, list[int]] = defaultdict(lambda: [0, 0])

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                self._totals[name][0] += row["ok"]
                self._totals[name][1] += row["err"]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def totals(self) -> dict[str, tuple[int, int]]:
        with self._lock:
            return {name: tuple(counts) for name, counts in self._totals.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(name, ok, err) for name, (ok, err) in self.totals().items()]
        return spark.createDataFrame(rows, "label string, ok bigint, err bigint")
