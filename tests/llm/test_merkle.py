import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rosterlake.llm.merkle_manifest import Shape, block_levels, fold, manifest, siblings
from rosterlake.llm.places import placed

from odd_rows import documents, empty, ODD_TEXTS, rows  # noqa: F401  (fixtures)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, run):
    """All levels of a tree, and for every leaf its siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + run]) for i in range(0, len(levels[-1]), run)])
    proofs = []
    for at in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            first = at // run * run
            proof.append((level[first:at], level[at + 1:first + run]))
            at //= run
        proofs.append(proof)
    return levels[-1][0], proofs


def by_hand(table, run, is_tampered):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    leaves = [(d, h(*map(written, (d, s, g, n, t))), h(*map(written, (d, s, g, None if n is None else n + 1, t))), g)
              for d, t, g, s, n in table]
    langs = sorted({leaf[3] for leaf in leaves}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted((x for x in leaves if x[3] == g), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for g in langs}
    climbed = {g: climb([x[1] for x in trees[g]], run) for g in langs}
    if not langs:
        return []
    root, outer = climb([climbed[g][0] for g in langs], run)
    out = []
    for g, beyond in zip(langs, outer):
        subroot, proofs = climbed[g]
        for (d, leaf, altered, _), proof in zip(trees[g], proofs):
            whole = proof + beyond
            node = altered if is_tampered(d) else leaf
            for left, right in whole:
                node = h(*left, node, *right)
            out.append((d, leaf, subroot, root, h(*[s for a, b in whole for s in a + b]), node, node == root))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("shape", [Shape(), Shape(2, 2), Shape(3, 1), Shape(2, 1)])
def test_equals_trees_built_level_by_level(documents, shape):
    rng = random.Random(3)
    table = [(i, f"text {i}" * rng.randrange(3), rng.choice([None, "en", "é", "-", "=", "en"]), rng.choice([None, "web"]))
             for i in rng.sample(range(1000), 45)]
    docs = documents([*table, (5000, "alone", "zz", None)]).repartition(3)
    got = rows(manifest(docs, F.col("doc_id") % 3 == 0, shape), *COLUMNS)
    want = by_hand([tuple(r) for r in docs.collect()], shape.run, lambda d: d % 3 == 0)
    assert got == want and any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_odd_rows(documents, empty):
    odd = [(i, t, (None, "x")[i % 2], None) for i, t in enumerate(ODD_TEXTS)]
    docs = documents([*odd, odd[3], odd[3], (None, "a", "x", None), (None, None, None, None)],
                     extra=("tree", "place", "node", "key", "n", "path", "root"))
    got = rows(manifest(docs, F.col("doc_id") % 2 == 0, Shape(2, 2)), *COLUMNS)
    want = by_hand([tuple(r)[:5] for r in docs.collect()], 2, lambda d: d is not None and d % 2 == 0)
    assert got == want
    lone = manifest(documents([(7, "only", "en", "web")])).collect()[0]
    assert lone.leaf == lone.root == lone.subroot and lone.proof_sha256 == h() and lone.verified and lone.proof == b""
    assert manifest(empty).count() == 0 and manifest(empty).columns[0] == "doc_id"
    # A null number stays null, so adding to it shows nowhere.
    null_number = documents([(1, "a"), (2, "b")]).withColumn("n_chars", F.lit(None).cast("long"))
    assert {r.verified for r in manifest(null_number, F.lit(True)).collect()} == {True}
    huge = documents([(1, "a"), (2, "b")]).withColumn("n_chars", F.lit(2**63 - 1))
    assert {r.verified for r in manifest(huge, F.lit(True)).collect()} == {False}


def test_a_superblock_equals_the_whole_tree():
    rng = random.Random(1)
    for run, size in ((2, 1), (2, 7), (2, 8), (3, 9), (4, 30)):
        nodes = [h(str(rng.random())) for _ in range(size)]
        levels = block_levels(nodes, size, Shape(run, 12))
        for at, node in enumerate(nodes):
            assert fold(node, siblings(levels, at, Shape(run, 12))) == climb(nodes, run)[0] == levels[-1][0]


def test_places_of_a_group_that_holds_most_rows_are_dealt_over_tasks(spark):
    table = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), F.lit(5).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = placed(table, "g", [F.col("x")], "places")
        share = out.groupBy("g", F.spark_partition_id()).count().where("g = 'a'").agg(F.max("count")).first()[0]
        for g, n in (("a", 18_000), ("b", 2_000)):
            places = [r.place for r in out.where(F.col("g") == g).collect()]
            assert sorted(places) == list(range(n)) and {r.n for r in out.where(F.col("g") == g).collect()} == {n}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert share < 12_000
