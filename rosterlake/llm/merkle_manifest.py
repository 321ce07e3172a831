"""Merkle manifest of a dataset: a digest tree over all rows, and for every row the proof that it is in the tree.

Every language has a tree of its own over its rows in the order of their ids; the roots of those trees, ordered by
language, are the leaves of a last tree, whose root stands for the dataset.

* Leaves are digested by built-in expressions, so texts are never moved; only digests and ids are.
* Rows are numbered within their language by ranges of the whole order: a language that holds most rows lies over
  many tasks.
* Trees are cut into superblocks of a fixed number of consecutive nodes. One round reduces every superblock to its
  root; those roots are the nodes of the next round, until each tree has one. A round moves one node per superblock.
* On the way down the nodes of a superblock are cogrouped with the siblings that its root has further out. One
  function then finishes the local reduction, joins local and outer siblings to the proof, and folds it.

The number of rounds is the logarithm of the rows to the base of the superblock: two for 16 million rows a language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import column
from .graphs import stored
from .places import placed


@dataclass(frozen=True)
class Shape:
    """Shape of the trees; only ``run`` changes digests."""

    run: int = 2        # nodes that become one node of the next level
    levels: int = 12    # levels of a superblock: run ** levels consecutive nodes

    @property
    def block(self) -> int:
        return self.run ** self.levels


def digest(parts: Sequence[str]) -> str:
    """Lower-case hex of the SHA-256 of texts in a row."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: every value as its byte count, a colon and itself, null as a dash."""
    written = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*written), 256)


# -- inside a superblock -------------------------------------------------------------------------


def block_levels(nodes: list[str], n: int, shape: Shape) -> list[list[str]]:
    """The levels of a superblock from its nodes up to its root.

    ``n`` counts the nodes of the whole tree in this round. A superblock that is the whole tree ends when one node
    is left; any other goes through all its levels, a lone node being digested at each.
    """
    levels = [nodes]
    while (len(levels) <= shape.levels) if n > shape.block else (len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([digest(last[i:i + shape.run]) for i in range(0, len(last), shape.run)])
    return levels


def siblings(levels: list[list[str]], at: int, shape: Shape) -> bytes:
    """The siblings of a node level by level: counts to its left and right, then their digests."""
    found = bytearray()
    for level in levels[:-1]:
        first = at - at % shape.run
        left, right = level[first:at], level[at + 1:first + shape.run]
        found += bytes([len(left), len(right)]) + bytes.fromhex("".join(left + right))
        at //= shape.run
    return bytes(found)


def steps(path: bytes) -> Iterator[tuple[list[str], list[str]]]:
    """Left and right siblings of each level of a path."""
    at = 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        both = path[at + 2:at + 2 + 32 * (left + right)].hex()
        nodes = [both[i:i + 64] for i in range(0, len(both), 64)]
        yield nodes[:left], nodes[left:]
        at += 2 + 32 * (left + right)


def fold(node: str, path: bytes) -> str:
    """The root that a node and its siblings lead to."""
    for left, right in steps(path):
        node = digest([*left, node, *right])
    return node


def proof_digest(path: bytes) -> str:
    return digest([s for left, right in steps(path) for s in left + right])


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values("place", kind="stable")


# -- rounds --------------------------------------------------------------------------------------


def _blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / shape.block).cast("long"))


def climb(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """The nodes of every round (tree, place, n, node) from ``nodes`` on; in the last, every tree has one.

    ``node`` is a digest as 32 bytes, ``place`` its number in the tree and ``n`` the number of nodes in the tree.
    """

    def root(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _in_order(rows)
        n = int(rows["n"].iloc[0])
        top = block_levels([bytes(d).hex() for d in rows["node"]], n, shape)[-1][0]
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "place": rows["block"].iloc[:1],
                             "n": [-(-n // shape.block)], "node": [bytes.fromhex(top)]})

    rounds = [nodes]
    while not rounds[-1].where("n > 1").isEmpty():
        below = _blocks(rounds[-1], shape).select("tree", "block", "place", "n", "node")
        above = below.groupBy("tree", "block").applyInPandas(root, "tree string, place long, n long, node binary")
        rounds.append(stored(above, "merkle"))
    return rounds


def descend(rounds: list[DataFrame], outer: DataFrame, shape: Shape) -> DataFrame:
    """(tree, place, path) of the nodes of the first of ``rounds``; ``outer`` has (tree, path) of every root."""

    def join(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes = _in_order(nodes)
        levels = block_levels([bytes(d).hex() for d in nodes["node"]], int(nodes["n"].iloc[0]), shape)
        beyond = bytes(above["path"].iloc[0])
        return pd.DataFrame({"tree": nodes["tree"], "place": nodes["place"],
                             "path": [siblings(levels, i, shape) + beyond for i in range(len(nodes))]})

    paths = outer.select("tree", F.lit(0).cast("long").alias("place"), "path")
    for nodes in reversed(rounds[:-1]):
        paths = stored(_cogrouped(nodes, paths, shape).applyInPandas(join, "tree string, place long, path binary"), "merkle")
    return paths


def _cogrouped(nodes: DataFrame, above: DataFrame, shape: Shape):
    """Nodes and what their superblock's root has further out, by superblock."""
    beyond = above.withColumnRenamed("place", "block")
    return _blocks(nodes, shape).groupBy("tree", "block").cogroup(beyond.groupBy("tree", "block"))


# -- manifest ------------------------------------------------------------------------------------


def manifest(docs: DataFrame, tampered: Column | None = None, shape: Shape = Shape(), id_column: str = "doc_id",
             group_column: str = "lang", number_column: str = "n_chars",
             columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified: one row per input row.

    ``proof`` holds the siblings of all levels (see :func:`steps`). ``tampered`` selects rows (null: not) whose proof
    is folded from a leaf with 1 added to ``number_column`` (a null stays); every other from its own leaf.

    Nulls are digested as a dash, an empty text as an empty value. A null id sorts first; rows of equal ids are
    ordered by their leaf, equal rows in any order, so repeated rows have a leaf and a proof each. A null group is a
    group, first in the order of groups. A lone row has no siblings and is its own root. An empty table gives no rows.
    Columns other than ``columns`` are not read, whatever their names.
    """
    kind = dict(docs.select(column(id_column).alias("k")).dtypes)["k"]
    fields = {c: column(c).cast("string") for c in columns}
    altered = fields | {number_column: (column(number_column).cast("decimal(38,0)") + 1).cast("string")}
    chosen = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaves = docs.select(
        column(id_column).alias("key"), F.coalesce(F.concat(F.lit("="), column(group_column)), F.lit("-")).alias("tree"),
        F.unhex(leaf_digest(list(fields.values()))).alias("node"),
        F.when(chosen, F.unhex(leaf_digest(list(altered.values())))).alias("altered"))
    leaves = stored(placed(leaves, "tree", [F.col("key"), F.col("node")], "leaves").withColumn("key", F.col("key").cast("string")),
                    "leaves")
    rounds = climb(leaves.select("tree", "place", "n", "node"), shape)
    subroots = rounds[-1].select("tree", F.col("node").alias("subroot"))

    # '-' sorts before '=': the null group comes first, the others by their bytes.
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("below"), F.col("subroot").alias("node"))
    ranked = stored(placed(named, "tree", [F.col("below")], "subroots"), "subroots")
    top = climb(ranked.select("tree", "place", "n", "node"), shape)
    root = top[-1].select(F.col("tree").alias("_top"), F.col("node").alias("root"))
    begin = top[-1].select("tree", F.lit(b"").cast("binary").alias("path"))
    outer = descend(top, begin, shape).withColumnRenamed("tree", "_top").join(
        ranked.select(F.col("place"), F.col("below").alias("tree"), F.col("node").alias("subroot")), "place")
    # One row per group, the root beside each.
    outer = stored(outer.join(root, "_top").select("tree", "path", "subroot", "root"), "outer")
    above = descend([*rounds[1:]], outer, shape) if len(rounds) > 1 else outer.select("tree", F.lit(0).cast("long").alias("place"), "path")
    above = above.join(outer.select("tree", "subroot", "root"), "tree")

    def finish(nodes: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        nodes = _in_order(nodes)
        own = [bytes(d).hex() for d in nodes["node"]]
        levels = block_levels(own, int(nodes["n"].iloc[0]), shape)
        path, subroot, top_root = (bytes(beyond[c].iloc[0]) for c in ("path", "subroot", "root"))
        proofs = [siblings(levels, i, shape) + path for i in range(len(own))]
        start = [bytes(a).hex() if a is not None else d for a, d in zip(nodes["altered"], own)]
        folded = [fold(s, p) for s, p in zip(start, proofs)]
        return pd.DataFrame({
            "key": nodes["key"], "leaf": own, "subroot": subroot.hex(), "root": top_root.hex(), "proof": proofs,
            "proof_sha256": [proof_digest(p) for p in proofs], "folded_root": folded,
            "verified": [f == top_root.hex() for f in folded]})

    done = _cogrouped(leaves, above, shape).applyInPandas(
        finish, "key string, leaf string, subroot string, root string, proof binary, proof_sha256 string, "
                "folded_root string, verified boolean")
    return done.select(F.col("key").cast(kind).alias("doc_id"), *done.columns[1:])
