"""N-gram Jaccard join: which texts share at least a given part of their word n-grams.

* Exact copies (equal sets) are one vertex, named by a 64-bit signature of the set.
* Shingles are ordered rare first. Their document frequencies come from all documents through a counting table of
  fixed size, which is small enough to be sent to every task; any common order gives right results, a better one
  fewer candidates.
* Prefix filter: sets that reach the similarity share one of the first n - ceil(s n) + 1 shingles in that order.
  Only those are moved, each to its own place.
* All vertices that meet at a shingle are noted under one leader, the one in whose order that shingle comes first:
  one row per vertex and not one per pair. Rows are combined per (leader, member).
* Length, positional and suffix filters (counts per range of hashes bound the symmetric difference) drop pairs of
  leader and member, the others are verified once on whole sets.
* A member that is not linked to its leader is compared with the other members of the leader, in blocks of bounded
  size and inside the task: first by the filters, then, where a partner is possible, by whole sets; only links that
  join something are returned. Members linked to a leader are one
  component already, so pairs among them need no look. No link between components is lost.

Hot shingles and hot leaders are split over many tasks. Components follow from the links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bytetext import U64, slices
from .common import column, whole_row
from .graphs import components, stored
from .shingles import difference_bound, histogram, overlap, shingle_sets


@dataclass(frozen=True)
class Settings:
    words: int = 5           # words in a shingle
    percent: int = 75        # least share of the union, in percent
    counter_bits: int = 24   # size of the counting table (one byte each when it is sent to tasks)
    hot: int = 1000          # counted documents from which a shingle is split over tasks
    block: int = 512         # members compared in one block


CHUNK_BITS = 16


def _need(a, b, percent: int):
    """Least intersection of sets of sizes a and b: percent * union <= 100 * intersection."""
    return -(-percent * (a + b) // (100 + percent))


def _profiles(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per document (doc_id, k1, k2, n, sig, bins) and, per task, its part of the counting table (chunk, counts)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        counts = np.zeros(1 << settings.counter_bits, np.uint32)
        shift = U64(64 - settings.counter_bits)
        for batch in batches:
            for part in slices(batch.column(3)):
                sets = shingle_sets(part, settings.words)
                np.add.at(counts, (sets.hashes >> shift).astype(np.int64), 1)
                rows = part.last - part.first
                bins = [histogram(sets.of(i)) for i in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(part.first, rows) for i in range(3)],
                     pa.array(np.diff(sets.offsets)), pa.array(sets.signatures),
                     pa.array(bins, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        size = min(1 << CHUNK_BITS, len(counts))
        parts = [(k, counts[k * size:(k + 1) * size]) for k in range(len(counts) // size)]
        parts = [(k, zlib.compress(c.tobytes(), 1)) for k, c in parts if c.any()]
        nothing = [pa.nulls(len(parts), t) for t in (key, *[pa.int64()] * 4, pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.array([k for k, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names)

    key = to_arrow_type(docs.schema["doc_id"].dataType)
    names = ["doc_id", "k1", "k2", "n", "sig", "bins", "chunk", "counts"]
    return docs.mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, n long, sig long, bins binary, chunk int, counts binary")


def _counting_table(profiles: DataFrame, settings: Settings) -> np.ndarray:
    """Sum of all tasks' tables, as one byte per counter (steps of a quarter of a doubling)."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(raw), np.uint32)
                total[k] = np.minimum(total[k].astype(np.uint64) + counts, 2**32 - 1).astype(np.uint32) if k in total else counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())],
            ["chunk", "counts"])

    parts = profiles.where("chunk is not null").select("chunk", "counts")
    # Two rounds, so that no task adds up more than a share of the tables of one chunk.
    parts = parts.repartition("chunk", F.pmod(F.spark_partition_id(), F.lit(16))).mapInArrow(add, "chunk int, counts binary")
    parts = stored(parts.repartition("chunk").mapInArrow(add, "chunk int, counts binary"), "counting-table")
    table = np.zeros(1 << settings.counter_bits, np.uint8)
    size = min(1 << CHUNK_BITS, len(table))
    for row in parts.toLocalIterator():
        counts = np.frombuffer(zlib.decompress(row.counts), np.uint32)
        table[row.chunk * size:(row.chunk + 1) * size] = np.minimum(4 * np.log2(1.0 + counts), 255)
    return table


def _prefixes(docs: DataFrame, order, settings: Settings) -> DataFrame:
    """shingle, pos, n, sig, spread: the prefix of every set; spread says over how many tasks a hot shingle goes."""

    def run(batches):
        ranks, seen = order.value, set()
        shift = U64(64 - settings.counter_bits)
        for batch in batches:
            for part in slices(batch.column(0)):
                sets = shingle_sets(part, settings.words)
                sizes = np.diff(sets.offsets)
                fresh = np.zeros(len(sizes), bool)
                for i, (s, n) in enumerate(zip(sets.signatures.tolist(), sizes.tolist())):
                    if n and s not in seen:
                        fresh[i] = True
                        seen.add(s)
                row = np.repeat(np.arange(len(sizes)), sizes)
                rank = ranks[(sets.hashes >> shift).astype(np.int64)]
                by = np.lexsort((sets.hashes, rank, row))
                pos = np.arange(len(row)) - sets.offsets[:-1][row]
                length = sizes - -(-settings.percent * sizes // 100) + 1
                kept = (pos < length[row]) & fresh[row]
                at = by[kept]
                counted = np.exp2(rank[at] / 4.0) - 1
                spread = np.where(counted >= settings.hot, np.ceil(counted / settings.hot), 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.hashes[at].view(np.int64)), pa.array(pos[kept].astype(np.int32)),
                     pa.array(sizes[row[kept]].astype(np.int32)), pa.array(sets.signatures[row[kept]]), pa.array(spread)],
                    ["shingle", "pos", "n", "sig", "spread"])

    return docs.mapInArrow(run, "shingle long, pos int, n int, sig long, spread int")


def _bound(pos_a, n_a, pos_b, n_b):
    """Positional filter: most shingles two sets can share when they meet at these places."""
    return F.least(pos_a, pos_b) + F.least(n_a - pos_a, n_b - pos_b)


def _led(prefixes: DataFrame) -> DataFrame:
    """lead, member, n_lead, n_member, bound for every member that meets a leader, one row per meeting."""
    names = ["lead", "member", "n_lead", "n_member", "pos_lead", "pos_member"]

    def run(batches):
        last = None
        for batch in batches:
            shingle, pos, n, sig = (batch.column(i).to_numpy() for i in range(4))
            if not len(shingle):
                continue
            if last is not None:
                shingle, pos, n, sig = (np.concatenate([[x], y]) for x, y in zip(last, (shingle, pos, n, sig)))
            first = np.concatenate([[True], shingle[1:] != shingle[:-1]])
            begin = np.flatnonzero(first)
            lead = np.repeat(begin, np.diff(np.concatenate([begin, [len(shingle)]])))
            met = sig != sig[lead]
            last = tuple(x[lead[-1]] for x in (shingle, pos, n, sig))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[met]) for x in (sig[lead], sig, n[lead].astype(np.int32), n.astype(np.int32),
                                            pos[lead].astype(np.int32), pos.astype(np.int32))], names)

    rows = prefixes.where("spread = 0").select("shingle", "pos", "n", "sig")
    usual = rows.repartition("shingle").sortWithinPartitions("shingle", "pos", "n", "sig").mapInArrow(
        run, "lead long, member long, n_lead int, n_member int, pos_lead int, pos_member int")
    # Hot shingles: the leader by an aggregate that combines per task, members joined to it over many tasks.
    hot = prefixes.where("spread > 0").withColumn("salt", F.pmod(F.col("sig"), F.col("spread")).cast("int"))
    leaders = hot.groupBy("shingle", "spread").agg(F.min(F.struct("pos", "n", "sig")).alias("l"))
    spread = leaders.select("shingle", "l", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("salt"))
    many = hot.join(spread, ["shingle", "salt"]).where("sig <> l.sig").select(
        F.col("l.sig").alias("lead"), F.col("sig").alias("member"), F.col("l.n").alias("n_lead"), F.col("n").alias("n_member"),
        F.col("l.pos").alias("pos_lead"), F.col("pos").alias("pos_member"))
    bound = _bound(F.col("pos_lead"), F.col("n_lead"), F.col("pos_member"), F.col("n_member"))
    return usual.union(many).groupBy("lead", "member", "n_lead", "n_member").agg(F.min(bound).alias("bound"))


def _suffix_filter(pairs: DataFrame, bins: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose sets can still be similar by their counts per range of hashes."""
    both = (pairs.join(bins.select(F.col("sig").alias("lead"), F.col("bins").alias("bins_lead")), "lead")
            .join(bins.select(F.col("sig").alias("member"), F.col("bins").alias("bins_member")), "member"))

    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.array([difference_bound(a, b) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], int)
            kept = pa.array(apart <= sizes - 2 * _need(1, sizes - 1, settings.percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["lead", "member"])

    return both.select("lead", "member", "n_lead", "n_member", "bins_lead", "bins_member").mapInArrow(
        run, "lead long, member long")


def _sets(docs: DataFrame, profiles: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """sig and whole set of the wanted signatures, from the documents that have them."""
    ids = (profiles.where("chunk is null").join(wanted, "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("id"))
           .select("id").distinct())

    def run(batches):
        for batch in batches:
            for part in slices(batch.column(0)):
                sets = shingle_sets(part, settings.words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.signatures), pa.array([sets.of(i).tobytes() for i in range(len(sets.signatures))], pa.binary())],
                    ["sig", "set"])

    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    return texts.mapInArrow(run, "sig long, set binary")


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of rows that lie together by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        cuts = [0, *np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, batch.num_rows]
        if held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _verify(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """lead, member for the pairs that reach the similarity. The leader's set goes to all tasks of its members."""
    salts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("salts"))
    members = pairs.join(salts, "lead").select(
        "lead", F.pmod(F.col("member"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("side"), F.col("member").alias("sig"))
    leaders = salts.select(
        "lead", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("lead").alias("sig"))
    asked = members.union(leaders).join(sets, "sig").select("lead", "salt", "side", "sig", "set")

    def run(batches):
        lead, own = None, np.zeros(0, U64)
        for batch in batches:
            hits: list[tuple[int, int]] = []
            for group, side, sig, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                values = np.frombuffer(raw, U64)
                if not side:
                    lead, own = group, values
                elif lead == group and 100 * (common := overlap(own, values)) >= settings.percent * (len(own) + len(values) - common):
                    hits.append((group, sig))
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in hits], pa.int64()) for i in (0, 1)], ["lead", "member"])

    return (asked.repartition("lead", "salt").sortWithinPartitions("lead", "salt", "side")
            .mapInArrow(run, "lead long, member long"))


def _spanning(found: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Found pairs that join something not yet joined by earlier ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in found:
        a, b = left[i], right[j]
        if root(a) != root(b):
            parent[root(a)] = root(b)
            out.append((a, b))
    return out


def _block_links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Places (i, j) of similar sets of two blocks, from one product of membership matrices."""
    known = np.unique(np.concatenate(left))
    common = np.zeros((len(left), len(right)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        here = known[at] == flat
        return row[here], at[here]

    (row_l, at_l), (row_r, at_r) = places(left), places(right)
    shared = np.zeros(len(known), bool)
    shared[at_r] = True
    number = np.cumsum(shared) - 1
    row_l, at_l, at_r = row_l[shared[at_l]], number[at_l[shared[at_l]]], number[at_r]
    for base in range(0, int(shared.sum()), 8192):
        parts = []
        for row, at, n in ((row_l, at_l, len(left)), (row_r, at_r, len(right))):
            here = (at >= base) & (at < base + 8192)
            matrix = np.zeros((n, 8192), np.float32)
            matrix[row[here], at[here] - base] = 1
            parts.append(matrix)
        common += parts[0] @ parts[1].T
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None]
    return np.argwhere(100 * common >= percent * (sizes - common))


def _blocks(members: DataFrame, settings: Settings) -> DataFrame:
    """lead, i, j, side, member, loose: members (lead, member, loose) dealt over blocks of their leader.

    A loose member is one that is not linked to the leader. Side 0 holds the loose ones, which meet every block of
    members; side 1 holds all members, each in its own block, once for each block of loose ones.
    """
    sizes = members.groupBy("lead").agg(
        F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"),
        F.ceil(F.count_if("loose") / settings.block).cast("int").alias("holds"), F.count("*").alias("all"))
    rows = members.join(sizes.where("holds > 0 and all > 1"), "lead")
    # Different hashes for the two sides, so that their blocks do not fall together.
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    hold = F.pmod(F.xxhash64("member", F.lit(1)), F.col("holds")).cast("int")
    left = rows.where("loose").select(
        "lead", hold.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), "member", "loose")
    right = rows.select(
        "lead", F.explode(F.sequence(F.lit(0), F.col("holds") - 1)).alias("i"), own.alias("j"), F.lit(1).alias("side"), "member", "loose")
    return left.union(right)


def _folded(bins: list[np.ndarray], size: int) -> np.ndarray:
    return np.stack([b.reshape(size, -1).sum(1) for b in bins]).astype(np.int32)


def _possible(left: list[bytes], right: list[bytes], percent: int) -> np.ndarray:
    """Which pairs of two blocks may be similar by their sizes and counts per range of hashes."""
    bins = [[np.frombuffer(b, np.uint16).astype(np.int64) for b in side] for side in (left, right)]
    lengths = [np.array([len(b) for b in side]) for side in bins]
    sizes = [np.array([b.sum() for b in side]) for side in bins]
    both = sizes[0][:, None] + sizes[1][None]
    may = np.minimum.outer(sizes[0], sizes[1]) * 100 >= np.maximum.outer(sizes[0], sizes[1]) * percent
    for x in np.unique(lengths[0]):
        for y in np.unique(lengths[1]):
            a, b = np.flatnonzero(lengths[0] == x), np.flatnonzero(lengths[1] == y)
            here = np.ix_(a, b)
            if may[here].any():
                one, two = (_folded([side[k] for k in at], min(x, y)) for side, at in zip(bins, (a, b)))
                apart = np.stack([np.abs(two - row).sum(1) for row in one])
                may[here] &= apart <= both[here] - 2 * _need(both[here], 0, percent)
    return may


def _with_partner(members: DataFrame, bins: DataFrame, settings: Settings) -> DataFrame:
    """lead, i, j, side, member, loose: the dealt members that have a possible partner on the other side of their block.

    Only counts per range of hashes are moved for it; one row per member and block comes out, never one per pair.
    """
    rows = _blocks(members, settings).join(bins.withColumnRenamed("sig", "member"), "member").select(
        "lead", "i", "j", "side", "member", "loose", "bins")

    def run(batches):
        for group in _grouped(batches, 3):
            side, member = group["side"].to_numpy(), group["member"].to_numpy()
            loose, raw = group["loose"].to_numpy(), group["bins"].to_pylist()
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(a) and len(b):
                may = _possible([raw[k] for k in a], [raw[k] for k in b], settings.percent)
                may &= member[a][:, None] != member[b][None]
                may &= ~loose[b][None] | (member[a][:, None] < member[b][None])
                kept = np.concatenate([a[may.any(1)], b[may.any(0)]])
                yield from group.drop(["bins"]).take(kept).to_batches()

    return (rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
            .mapInArrow(run, "lead long, i int, j int, side int, member long, loose boolean"))


def _verify_rest(dealt: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links of loose members with other members of their leader, from the dealt members with a possible partner."""
    rows = dealt.join(sets, F.col("member") == F.col("sig")).select("lead", "i", "j", "side", "member", "loose", "set")

    def run(batches):
        for group in _grouped(batches, 3):
            side, member, loose = (group[c].to_numpy() for c in ("side", "member", "loose"))
            whole = [np.frombuffer(raw, U64) for raw in group["set"].to_pylist()]
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            hits: list[tuple[int, int]] = []
            if len(a) and len(b):
                found = _block_links([whole[k] for k in a], [whole[k] for k in b], settings.percent)
                once = ~loose[b][found[:, 1]] | (member[a][found[:, 0]] < member[b][found[:, 1]])
                hits = _spanning(found[once], member[a].tolist(), member[b].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hits], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j").mapInArrow(run, "a long, b long"))


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, group and the row's key (k1, k2): one row per input row.

    Two documents link when 100 * |A and B| >= percent * |A or B|; component_id is the smallest id reachable by
    links, the document's own included. A null or blank text has no shingles and is linked with nothing; a null id
    takes part in links and is never the smallest unless it is alone. Repeated rows are linked as equal texts. An
    empty table gives an empty table. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    bare = _keyed(docs, id_column, text_column)
    profiles = stored(_profiles(bare, settings), "profiles")
    order = spark.sparkContext.broadcast(_counting_table(profiles, settings))
    pairs = stored(_led(_prefixes(bare.select("text"), order, settings)), "led")

    possible = pairs.where(
        (F.least("n_lead", "n_member") * 100 >= F.greatest("n_lead", "n_member") * settings.percent)
        & (F.col("bound") * (100 + settings.percent) >= (F.col("n_lead") + F.col("n_member")) * settings.percent))
    described = profiles.where("chunk is null and n > 0").groupBy("sig").agg(F.first("bins").alias("bins"))
    near = stored(_suffix_filter(possible, described, settings), "near")
    several = pairs.groupBy("lead").agg(F.count("*").alias("members")).where("members > 1").select("lead")
    together = pairs.join(several, "lead", "left_semi").select("lead", "member")

    def loose_but_for(found: DataFrame) -> DataFrame:
        return together.join(found.select("lead", "member", F.lit(True).alias("yes")), ["lead", "member"], "left").select(
            "lead", "member", F.col("yes").isNull().alias("loose"))

    # Sets are read once: for the pairs to verify, and for members that are loose already and have possible partners.
    early = _with_partner(loose_but_for(near), described, settings)
    wanted = near.select(F.col("lead").alias("sig")).union(near.select("member")).union(early.select("member")).distinct()
    sets = stored(_sets(bare, profiles, wanted, settings), "sets")
    linked = stored(_verify(near, sets, settings), "linked")
    rest = _verify_rest(_with_partner(loose_but_for(linked), described, settings), sets, settings)
    links = linked.select(F.col("lead").alias("a"), F.col("member").alias("b")).union(rest)
    groups = components(links)

    # From signatures to ids: copies first, then components.
    rows = profiles.where("chunk is null").select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "sig")
    copies = rows.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    placed = copies.join(groups, F.col("sig") == F.col("node"), "left").where("component is not null or rows > 1").select(
        "sig", "least", F.coalesce("component", "sig").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("smallest"))
    salted = placed.join(smallest, "component").select(
        "sig", "component", "smallest", F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod("k1", F.lit(COPY_SALTS)).cast("int")).join(salted, ["sig", "salt"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.coalesce("component", "sig")).alias("group"), "k1", "k2")


#: Tasks that a large group of copies is spread over when its rows get their component.
COPY_SALTS = 16


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, k1, k2, text: two hashes name a row by its id and text."""
    text = column(text_column).cast("string")
    key = F.coalesce(column(id_column).cast("string"), F.lit("")), column(id_column).isNull(), text
    return docs.select(column(id_column).alias("doc_id"), F.xxhash64(*key).alias("k1"), F.hash(*key).cast("long").alias("k2"),
                       text.alias("text"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents without near duplicates: one row of every group stays, with all its columns.

    The row with the smallest id stays; rows that share that id are told apart by a hash of their text, rows that
    share both by a hash of their other columns. Documents without words stay, once per id and text.
    """
    groups = stored(similar_groups(docs, id_column, text_column, settings), "groups")
    first = groups.where("n_shingles > 0 and doc_id <=> component_id").groupBy("group").agg(F.min(F.struct("k1", "k2")).alias("k"))
    kept = first.select("k.k1", "k.k2").union(groups.where("n_shingles = 0").select("k1", "k2").distinct())
    text = column(text_column).cast("string")
    key = F.coalesce(column(id_column).cast("string"), F.lit("")), column(id_column).isNull(), text
    rows = docs.select(whole_row(docs).alias("row"), F.xxhash64(*key).alias("k1"), F.hash(*key).cast("long").alias("k2"),
                       F.xxhash64(*[column(c) for c in docs.columns]).alias("whole"))
    same = Window.partitionBy("k1", "k2").orderBy("whole")
    return (rows.join(kept, ["k1", "k2"]).withColumn("at", F.row_number().over(same)).where("at = 1").select("row.*"))
