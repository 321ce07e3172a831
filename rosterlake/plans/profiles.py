"""The serving table: current profile per id, kept by upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.wire import to_serving
from ..operators.latest import latest_by_key
from ..schema import SERVING
from .parts import PartTable, Spec

# Arrival order of a message: later timestamps win, then partition and offset.
VERSION = ["_ts", "_partition", "_offset"]
_STORED = T.StructType(SERVING.fields + [
    T.StructField("_ts", T.TimestampType()),
    T.StructField("_partition", T.IntegerType()),
    T.StructField("_offset", T.LongType()),
])
_NAMES = _STORED.fieldNames()


class ProfileTable:
    """Profiles by id: a base per share of the buckets plus the changes of recent batches.

    A batch only writes its own rows. Once a share has ``compact_after`` batches waiting it is merged; a batch merges
    one share at most, so the cost of rewriting is spread over that many batches. Choose ``buckets`` for the final
    size when the table is made; a bucket is merged by ``splits`` tasks.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, splits: int = 1,
                 compact_after: int = 8):
        self.spark = spark
        self.splits = splits
        self.compact_after = compact_after
        self.parts = PartTable(spark, path, Spec(_STORED, "id", ("id",), self._newest, spread=True), buckets, compact_after)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Newest row per id; one shuffle, by (bucket, split)."""
        split = F.pmod(F.xxhash64(F.col("id"), F.lit("split")), F.lit(self.splits))
        placed = rows.withColumn("_split", split).repartition(F.col("bucket"), F.col("_split"))
        return latest_by_key(placed, ["bucket", "_split", "id"], VERSION).drop("_split")

    def with_buckets(self) -> DataFrame:
        """Current profiles with their bucket; only the shares with changes are resolved on the way."""
        return self.parts.read().select(*SERVING.fieldNames(), "bucket")

    def read(self) -> DataFrame:
        return self.with_buckets().drop("bucket")

    def current(self, ids: DataFrame) -> DataFrame:
        """Current rows of the profiles with the given ``id``.

        One semi-join on bucket and id, whatever the number of ids: where they are few, adaptive execution
        sends them to all tasks and dynamic pruning opens their buckets only.
        """
        wanted = ids.select("id").distinct().withColumn("bucket", self.parts.bucket_of(F.col("id")))
        return self.with_buckets().join(wanted, ["bucket", "id"], "left_semi").drop("bucket")

    def upsert(self, changes: DataFrame, batch: int | None = None, stream: str = "") -> None:
        """Replace or add whole profiles.

        ``changes`` has the profile columns plus ``_ts``, ``_partition`` and ``_offset``. A stored row
        stays if it is newer, so the order in which batches arrive does not matter. A ``batch`` number
        that was written before by the same ``stream`` is skipped, which makes replays harmless; numbers
        of other streams, and of a stream started anew, do not count. Several writers may work at once.
        """
        # Each task sorts its rows to reduce them to one per id. A single input file may hold all of them, so they are
        # dealt first, those of one id by their version.
        rows = to_serving(changes).select(*_NAMES).repartition(F.col("id"), F.xxhash64(*VERSION))
        incoming = latest_by_key(rows, ["id"], VERSION)
        if self.parts.append(incoming, stream, batch) and self.parts.merge(self.compact_after, at_most=1):
            self.parts.clean()

    def compact(self) -> list[int]:
        """Merge all shares that have changes; returns them."""
        return self.parts.merge()
