"""Tables that grow by parts: folders of parquet files that are written once and never altered.

``<root>/part=<name>/share=S/bucket=B/*.parquet``. A part is a base, which holds a share of the buckets as it was when
it was merged, or the changes of one batch, named by stream and batch: writing a batch again replaces itself, and a
folder counts once Spark has marked it complete. Which base a share has, and which batches are in it, is one small
file per share. What rows mean together (the latest, the sum) is an aggregation that the table is given.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.bounded import has_at_most
from ..operators.textindex import range_bucket


MERGED_BUCKETS = 64   # buckets of a share up to which tasks of a merge write the rows they read, one file for each
MERGED_BYTES = 1 << 21  # of files that such a task reads for every bucket, so that merges leave fewer files and larger ones
OWNERS_SENT = 1 << 22  # owners whose versions are sent to all tasks, 64 MB of them
ONCE = "once-"  # begins the stream names of batches that no stream will write again


@dataclass(frozen=True)
class Spec:
    """``key`` decides the bucket, ``order`` the row order inside it; ``resolve`` makes changes (and ``bucket``) current.

    ``spread`` gathers rows by bucket before writing, in even partitions, unless they come ``dealt`` already: a bucket with
    a hot key takes several tasks.
    With ``bounds`` a bucket is a range of keys instead of a hash: bucket i has the keys from bound i - 1 up to bound i.
    Where a batch replaces all rows that an ``owner`` has in a share, those it drops by rows without a ``size``, a row is
    current if no batch has a greater ``version`` of its owner; this is told from owners instead of rows.
    """

    schema: T.StructType
    key: str
    order: tuple[str, ...]
    resolve: Callable[[DataFrame], DataFrame]
    spread: bool = False
    bounds: tuple[str, ...] = ()
    owner: str | None = None
    size: str | None = None


class PartTable:
    """A table of one :class:`Spec`; the numbers of buckets and shares are fixed when it is made."""

    def __init__(self, spark: SparkSession, root: str, spec: Spec, buckets: int, shares: int):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        if spec.bounds:
            buckets = len(spec.bounds) + 1
        if not self.exists():
            self._save("_table.json", {"buckets": buckets, "shares": min(shares, buckets), "bounds": list(spec.bounds)})
        self._describe()

    def _describe(self) -> None:
        made = self._load("_table.json")
        self.buckets, self.shares, self.bounds = made["buckets"], made["shares"], made["bounds"]

    def exists(self) -> bool:
        return self._load("_table.json") is not None

    # -- files -------------------------------------------------------------------------------

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _load(self, name: str) -> dict | None:
        fs, path = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _save(self, name: str, content: dict) -> dict:
        """Replace a small file at once: readers see the old one or the new one."""
        fs, path = self._at(name)
        _, pending = self._at(f"{name}.{uuid.uuid4().hex}")
        out = fs.create(pending, True)
        out.write(json.dumps(content).encode("utf-8"))
        out.close()
        jvm = self.spark._jvm
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        ways = self.spark.sparkContext._gateway.new_array(rename, 1)
        ways[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), fs.getConf()).rename(pending, path, ways)
        return content

    # -- parts -------------------------------------------------------------------------------

    def state(self, share: int) -> dict:
        """The base of a share, and the last batch of every stream that is in it."""
        return self._load(f"_share-{share}.json") or {"base": None, "merged": {}}

    def batches(self) -> list[tuple[str, int]]:
        """Complete batches of changes that still have a folder."""
        found = [n for n in self._names("") if n.startswith("part=change.")]
        return sorted((n.split(".")[1], int(n.split(".")[2])) for n in found if "_SUCCESS" in self._names(n))

    def has(self, stream: str, batch: int) -> bool:
        return (stream, batch) in self.batches() or batch <= self.state(0)["merged"].get(stream, -1)

    @staticmethod
    def _name(stream: str, batch: int) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_-]*", stream):
            raise ValueError(f"a stream's name has letters, digits, - and _ only: {stream!r}")
        return f"part=change.{stream}.{batch:012d}"

    def bucket_of(self, key: Column) -> Column:
        if self.bounds:
            return range_bucket(key, self.bounds)
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, name: str, rows: DataFrame, dealt: bool = False) -> None:
        placed = rows.select(*self.spec.schema.fieldNames(), self.bucket_of(F.col(self.spec.key)).alias("bucket"))
        placed = placed.withColumn("share", F.col("bucket") % self.shares)
        if self.spec.spread and not dealt:
            placed = placed.hint("rebalance", F.col("bucket"))
        # Folders come first in the order, as the writer needs them: it sorts by them again otherwise.
        placed.sortWithinPartitions("share", "bucket", *self.spec.order).write.mode("overwrite").option("compression", "zstd").partitionBy(
            "share", "bucket").parquet(f"{self.root}/{name}")

    def append(self, rows: DataFrame, stream: str = "", batch: int | None = None, again: bool = False, dealt: bool = False) -> bool:
        """Write the changes of a batch; False if the stream's batch is there already, unless it is written ``again``."""
        if batch is None:
            stream, batch = f"{ONCE}{uuid.uuid4().hex}", 0
        elif not again and self.has(stream, batch):
            return False
        self._write(self._name(stream, batch), rows, dealt)
        return True

    def states(self) -> dict[int, dict]:
        return {s: self.state(s) for s in range(self.shares)}

    def pending(self, upto: int | None = None, without: tuple[str, int] | None = None,
                states: dict[int, dict] | None = None) -> dict[int, list[tuple[str, int]]]:
        """Batches that are not in the base of each share, up to the batch number ``upto`` where it is given."""
        states = states or self.states()
        batches = [b for b in self.batches() if (upto is None or b[1] <= upto) and b != without]
        return {s: [(stream, n) for stream, n in batches if n > states[s]["merged"].get(stream, -1)] for s in states}

    def _folders(self, shares: list[int], waiting: dict[int, list[tuple[str, int]]], states: dict[int, dict]) -> list[str]:
        names = {s: [base for base in [states[s]["base"]] if base] + [self._name(*b) for b in waiting.get(s, [])] for s in shares}
        there = {n: set(self._names(n)) for n in {n for ns in names.values() for n in ns}}
        return [f"{n}/share={s}" for s, ns in names.items() for n in ns if f"share={s}" in there[n]]

    def _rows(self, shares: list[int], waiting: dict[int, list[tuple[str, int]]], states: dict[int, dict]) -> DataFrame:
        """Rows of some shares as they are written: the base of their state and the batches given for each."""
        schema = T.StructType([*self.spec.schema.fields, *(T.StructField(n, T.IntegerType()) for n in ("share", "bucket"))])
        paths = [f"{self.root}/{folder}" for folder in self._folders(shares, waiting, states)]
        if not paths:
            return self.spark.createDataFrame([], schema).drop("share")
        layout = T.StructType([*schema.fields, T.StructField("part", T.StringType())])
        return self.spark.read.schema(layout).option("basePath", self.root).parquet(*paths).drop("part", "share")

    def note_owners(self, alone: bool) -> None:
        """Whether every owner is known and stands for one thing, so that its rows are replaced together."""
        self._save("_owners.json", {"alone": alone})

    def _by_owner(self) -> bool:
        return self.spec.owner is not None and bool((self._load("_owners.json") or {}).get("alone"))

    def _resolved(self, shares: list[int], waiting: dict[int, list[tuple[str, int]]], states: dict[int, dict],
                  held: list[DataFrame] | None = None) -> DataFrame:
        """Current rows of some shares as a whole. Where owners tell them, rows stay where they are read.

        What is to be computed once is kept in ``held``, where that is given.
        """
        rows = self._rows(shares, waiting, states)
        if not self._by_owner():
            return self.spec.resolve(rows).select(*rows.columns)
        owner = self.spec.owner
        # Rows of a base are as old as they look: only batches say what is newer.
        batches = self._rows(shares, waiting, {s: states[s] | {"base": None} for s in shares})
        newest = batches.groupBy(owner).agg(F.max("version").alias("_newest"))
        if held is not None:
            held.append(newest := newest.persist())
        if has_at_most(newest, OWNERS_SENT):
            newest = F.broadcast(newest)
        current = F.col("_newest").isNull() | (F.col("version") >= F.col("_newest"))
        return rows.where(F.col(self.spec.size) > 0).join(newest, owner, "left").where(current).select(*rows.columns)

    def read(self, upto: int | None = None, without: tuple[str, int] | None = None, whole: bool = False) -> DataFrame:
        """Current rows, with their ``bucket``; shares without changes are read as they are.

        ``without`` leaves out a batch that is in no base yet.

        Filters on the bucket and on what rows are resolved by reach the files; who reads the ``whole`` table has its rows
        resolved without moving them, where they have owners.
        """
        self._describe()  # ranges may have other bounds since
        states = self.states()
        waiting = self.pending(upto, without, states)
        settled, changed = [s for s in waiting if not waiting[s]], [s for s in waiting if waiting[s]]
        parts = [self._rows(settled, {}, states)] if settled else []
        if changed:
            resolved = self._resolved(changed, waiting, states) if whole else self.spec.resolve(self._rows(changed, waiting, states))
            parts.append(resolved.select(*self.spec.schema.fieldNames(), "bucket"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def merge(self, at_least: int = 1, at_most: int | None = None, without: tuple[str, int] | None = None) -> list[int]:
        """Write a new base for the shares with ``at_least`` so many batches waiting, ``at_most`` so many shares and
        those with most first; returns them. A batch that may be written again is left out by ``without``.

        Batches that arrive meanwhile keep waiting. Of two merges of a share at once the later state holds; it names a
        base and the batches in it, so what only the other merged waits again.
        """
        states = self.states()
        waiting = self.pending(without=without, states=states)
        due = sorted((s for s in waiting if len(waiting[s]) >= at_least), key=lambda s: (-len(waiting[s]), s))[:at_most]
        if due:
            name = f"part=base.{uuid.uuid4().hex}"
            held: list[DataFrame] = []
            rows = self._resolved(due, waiting, states, held)
            dealt = bool(held) and self.buckets <= MERGED_BUCKETS * self.shares
            try:
                if dealt:
                    self._write(name, rows.coalesce(self._merging(due, waiting, states)), dealt)
                else:
                    self._write(name, rows)
            finally:
                for some in held:
                    some.unpersist()
            for share in due:
                self._settle(share, name, states[share]["merged"] | dict(waiting[share]))
        return due

    def _merging(self, shares: list[int], waiting: dict[int, list[tuple[str, int]]], states: dict[int, dict]) -> int:
        """Over how many tasks some shares are merged where they are read: all cores at most while files are small."""
        size = 0
        for folder in self._folders(shares, waiting, states):
            fs, path = self._at(folder)
            size += fs.getContentSummary(path).getLength()
        a_task = MERGED_BYTES * -(-self.buckets // self.shares)
        return max(1, -(-size // a_task), min(self.spark.sparkContext.defaultParallelism, size // MERGED_BYTES))

    def _settle(self, share: int, base: str, merged: dict[str, int]) -> None:
        there = {stream for stream, _ in self.batches()}
        self._save(f"_share-{share}.json", {"base": base, "merged": {
            stream: n for stream, n in merged.items() if stream in there or not stream.startswith(ONCE)}})

    def clean(self, hours: float = 24.0) -> int:
        """Delete the parts that no share needs and that are older than any reader of theirs; returns how many."""
        states = [self.state(s) for s in range(self.shares)]
        needed = {s["base"] for s in states} | {self._name(*b) for bs in self.pending().values() for b in bs}
        oldest, gone = (time.time() - 3600 * hours) * 1000, 0
        for name in self._names(""):
            fs, path = self._at(name)
            if name.startswith("part=") and name not in needed and fs.getFileStatus(path).getModificationTime() < oldest:
                gone += fs.delete(path, True)
        return gone

    def replace(self, rows: DataFrame, bounds: list[str] | None = None, dealt: bool = False) -> None:
        """A new base of all shares from whole contents, instead of everything there is; ranges may get other ``bounds``.

        Rows that are ``dealt`` over even tasks already are written where they are, one file per task and bucket.
        """
        if bounds is not None:
            self._save("_table.json", {"buckets": len(bounds) + 1, "shares": self.shares, "bounds": bounds})
            self._describe()
        name, batches, states = f"part=base.all.{uuid.uuid4().hex}", dict(self.batches()), self.states()
        self._write(name, rows, dealt)
        for share in range(self.shares):
            self._settle(share, name, states[share]["merged"] | batches)
