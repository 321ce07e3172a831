"""Exact top-k by inner product, as a Voronoi k-nearest-neighbour join.

Inner products become distances by one more coordinate: with M the longest candidate vector, a candidate y gets
sqrt(M^2 - |y|^2) and a query 0, so that |q - y|^2 = |q|^2 + M^2 - 2 q.y and the nearest candidates have the highest
products. Candidates are grouped by their nearest pivot and summarised (how many, nearest, farthest, the k smallest
distances to the pivot); queries are grouped likewise. From the summaries alone each query group gets a bound on how
far its k-th neighbour can be, and from that a bound per candidate group: a candidate nearer to its pivot than the
bound, by the triangle inequality, cannot be among the neighbours. The others are sent to the query group, in blocks
of bounded size, solved block by block with exact integer products, and merged in two rounds, so that no task sees the
lists of all blocks of a query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import column

_EXACT = 2.0 ** 53


@dataclass(frozen=True)
class Settings:
    scale: int = 64              # components become floor(scale * x)
    pivots: int = 32             # bound of the sample of candidates used as pivots
    queries_at_once: int = 1024  # queries of a group that are solved together
    block: int = 4096            # candidates of a group that are solved together


def _narrowest(reach: float) -> type:
    """Smallest integer type for components of at most that size."""
    return next((kind for kind in (np.int8, np.int16, np.int32) if reach <= np.iinfo(kind).max), np.int64)


def _packed(vectors: np.ndarray, kind: type) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(vectors, kind)]


def _unpacked(values: pa.Array, size: int, kind: type) -> np.ndarray:
    raw = b"".join(values.to_pylist())
    return np.frombuffer(raw, kind).reshape(-1, size).astype(np.int64)


def _spots(ids: np.ndarray, vectors: np.ndarray, seed: int) -> np.ndarray:
    """A hash of every id and vector, so that rows of one id are spread as well."""
    odd = np.arange(1, vectors.shape[1] + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (vectors.astype(np.uint64) * odd).sum(1, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(seed)
    return mixed >> np.uint64(33)


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id and v (long components) of the vectors that take part."""
    v = column(vector_column)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    sound = v.isNotNull() & column(id_column).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(sound).select(column(id_column).cast("long").alias("vec_id"), whole.alias("v"))


def _lists(values: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 0)


class Cells:
    """Pivots in the space with the extra coordinate."""

    def __init__(self, pivots: np.ndarray, longest: float):
        self.longest = longest
        self.points = self.lift(pivots, False)

    def lift(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """Points of candidates or of queries."""
        x = vectors.astype(float)
        extra = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0.0))
        return np.concatenate([x, extra[:, None]], axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of every point and the distance to it."""
        squares = (points ** 2).sum(1)[:, None] + (self.points ** 2).sum(1) - 2 * points @ self.points.T
        cell = squares.argmin(1)
        return cell, np.sqrt(np.maximum(((points - self.points[cell]) ** 2).sum(1), 0.0))


def bounds(cells: Cells, farthest_query: dict[int, float], nearest_k: dict[int, list[float]], farthest: dict[int, float],
           k: int) -> dict[int, dict[int, float]]:
    """Per query group and candidate group: the least distance to its pivot a candidate needs to be sent.

    The k-th smallest of (query radius + pivot to pivot + candidate to pivot) bounds every query's k-th neighbour;
    a candidate at distance d from its pivot is at least (pivot to pivot - query radius - d) away.
    """
    between = np.sqrt(((cells.points[:, None, :] - cells.points[None]) ** 2).sum(2))
    slack = 1e-6 * (1 + between.max() + max(farthest.values(), default=0.0))
    needed: dict[int, dict[int, float]] = {}
    for group, radius in farthest_query.items():
        reach = sorted(radius + between[group, j] + d for j, ds in nearest_k.items() for d in ds)
        limit = reach[k - 1] if len(reach) >= k else float("inf")
        needed[group] = {}
        for j, far in farthest.items():
            least = between[group, j] - radius - limit - slack
            if far >= least:
                needed[group][j] = least
    return needed


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
          settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest integer inner products of every query.

    ``is_query`` is a condition on vec_id. Every row but the query's own is a candidate; ties go to the smaller
    vec_id. Vectors that are null, hold null or non-finite components, or have no id take no part; vectors of
    different lengths are matched within their length only. A query id that is repeated is one query per distinct
    vector, its own row is one row of that id and vector, and repeated candidates are each listed. Products are
    exact integers as long as they fit a long.
    """
    spark = vectors.sparkSession
    base = usable(vectors, id_column, vector_column, settings.scale)
    sizes = [r[0] for r in base.select(F.size("v").alias("n")).distinct().collect()]
    solved = [_of_length(base.where(F.size("v") == n), is_query, k, n, settings) for n in sorted(sizes) if n > 0]
    if not solved:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = solved[0]
    for more in solved[1:]:
        out = out.unionByName(more)
    return out


def _of_length(base: DataFrame, is_query: Column, k: int, size: int, settings: Settings) -> DataFrame:
    spark = base.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    reach = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    longest, reach = base.agg(F.max(norm), F.max(reach)).first()
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kind = _narrowest(reach)
    sample = base.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(settings.pivots).collect()
    cells = Cells(np.array([r.v for r in sample], float).reshape(-1, size), float(longest))
    shared = spark.sparkContext.broadcast(cells)

    def assign(queries: bool):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    v = _lists(batch.column(1))
                    cell, distance = shared.value.nearest(shared.value.lift(v, queries))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(_packed(v, kind), pa.binary()), pa.array(cell, pa.int32()),
                         pa.array(distance)], ["vec_id", "v", "cell", "distance"])

        return run

    schema = "vec_id long, v binary, cell int, distance double"
    data = base.mapInArrow(assign(False), schema)
    asked = base.where(is_query).mapInArrow(assign(True), schema)

    # Summaries: one small row per group, the k nearest by a per-task cut.
    spread = data.groupBy("cell").agg(F.max("distance").alias("far"), F.count("*").alias("n")).collect()
    farthest = {r.cell: r.far for r in spread}
    nearest_k = {r.cell: r.near for r in _nearest_distances(data.select("cell", "distance"), k + 1).collect()}
    groups = asked.groupBy("cell").agg(F.max("distance").alias("far"), F.count("*").alias("n")).collect()
    needed = bounds(cells, {r.cell: r.far for r in groups}, nearest_k, farthest, k + 1)
    held = {r.cell: r.n for r in spread}
    chunks = {r.cell: -(-r.n // settings.queries_at_once) for r in groups}
    shares = {g: max(1, -(-sum(held[j] for j in needed[g]) // settings.block)) for g in needed}
    plan = spark.sparkContext.broadcast((needed, chunks, shares))

    def route(batches):
        """Candidates to the query groups that need them, packed into one row per destination and batch."""
        needs, parts, blocks = plan.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = _unpacked(batch.column(1), size, kind)
            cell, distance = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            spots = _spots(ids, vectors, 0x94D049BB133111EB)
            rows = []
            for group, least in needs.items():
                floor = np.array([least.get(j, np.inf) for j in range(len(shared.value.points))])
                send = distance >= floor[cell]
                block = spots % np.uint64(blocks[group])
                for b in np.unique(block[send]):
                    chosen = send & (block == b)
                    for part in range(parts[group]):
                        rows.append((group, part, int(b), ids[chosen].tobytes(), vectors[chosen].astype(kind).tobytes()))
            yield _table(rows)

    def ask(batches):
        """Queries to all blocks of candidates of their group."""
        _, parts, blocks = plan.value
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            vectors = _unpacked(batch.column(1), size, kind)
            spots = _spots(ids, vectors, 0xD6E8FEB86659FD93)
            rows = []
            for group in np.unique(cell):
                part = spots % np.uint64(parts[group])
                for p in np.unique(part[cell == group]):
                    chosen = (cell == group) & (part == p)
                    for b in range(blocks[group]):
                        rows.append((int(group), int(p), b, ids[chosen].tobytes(), vectors[chosen].astype(kind).tobytes()))
            yield _table(rows)

    routed = "cell int, part int, block int, ids binary, vectors binary"
    place = ["cell", "part", "block"]

    def solve(key, left: pa.Table, right: pa.Table) -> pa.Table:
        asked_ids, asked_rows = _unpack(left, size, kind)
        ids, rows = _unpack(right, size, kind)
        asked_rows, first = np.unique(np.concatenate([asked_ids[:, None], asked_rows], axis=1), axis=0, return_index=True)
        found = []
        for a in range(0, len(first), 256):
            found += _best(asked_rows[a:a + 256, 0], asked_rows[a:a + 256, 1:], ids, rows, k)
        return _result(found, key[2].as_py() % turns)

    # A query has one list per block: first the lists of every turn are merged, then those of all turns.
    turns = math.isqrt(max(shares.values(), default=1) - 1) + 1
    best = (asked.mapInArrow(ask, routed).groupBy(*place)
            .cogroup(data.mapInArrow(route, routed).groupBy(*place))
            .applyInArrow(solve, "query_id long, query binary, turn int, vec_ids array<bigint>, scores array<bigint>"))
    hits = best.select("query_id", "query", "turn", F.inline(F.arrays_zip(F.col("vec_ids").alias("vec_id"), F.col("scores").alias("score"))))
    top = _first(hits, ["query_id", "query", "turn"], k).drop("rank") if turns > 1 else hits
    return _first(top, ["query_id", "query"], k).select("query_id", "rank", "vec_id", "score")


def _first(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best hits per key with their rank; every task cuts its own before anything is moved."""
    at = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(at)).where(F.col("rank") <= k)


def _nearest_distances(rows: DataFrame, k: int) -> DataFrame:
    """The k smallest distances of every cell; each task sends its own k smallest only."""

    def smallest(batches):
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, distance = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for c in np.unique(cell):
                both = np.concatenate([kept.get(c, np.zeros(0)), distance[cell == c]])
                kept[c] = np.sort(both)[:k]
        if kept:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c) for c in kept], pa.int32()), pa.array([v.tolist() for v in kept.values()])], ["cell", "near"])

    local = rows.mapInArrow(smallest, "cell int, near array<double>")
    return local.groupBy("cell").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["cell", "part", "block", "ids", "vectors"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def _unpack(table: pa.Table, size: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(b"".join(table["ids"].to_pylist()), np.int64)
    return ids, np.frombuffer(b"".join(table["vectors"].to_pylist()), kind).reshape(-1, size).astype(np.int64)


def _best(asked_ids: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """Best k candidates of each query in a block, without the query's own row."""
    if not len(ids):
        return []
    reach = float(np.abs(asked.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * asked.shape[1]
    if reach < _EXACT:
        scores = (asked.astype(float) @ rows.T.astype(float)).astype(np.int64)
    else:
        scores = asked @ rows.T
    found = []
    for i in range(len(asked)):
        mine, at = scores[i], np.arange(len(ids))
        own = np.flatnonzero(ids == asked_ids[i])
        own = own[(rows[own] == asked[i]).all(1)][:1] if len(own) else own
        if len(own):
            mine, at = np.delete(mine, own), np.delete(at, own)
        if len(mine) > k:
            least = np.partition(mine, len(mine) - k)[len(mine) - k]
            near = np.flatnonzero(mine >= least)
            mine, at = mine[near], at[near]
        order = np.lexsort((ids[at], -mine))[:k]
        found.append((int(asked_ids[i]), asked[i].tobytes(), ids[at][order].tolist(), mine[order].tolist()))
    return found


def _result(found: list[tuple], turn: int) -> pa.Table:
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
    columns.insert(2, pa.array([turn] * len(found), pa.int32()))
    return pa.table(columns, names=["query_id", "query", "turn", "vec_ids", "scores"])
