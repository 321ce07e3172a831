import random

import pytest
from pyspark.sql import functions as F

from rosterlake.llm.learning import chosen_rows
from rosterlake.llm.voronoi_knn import Settings, _narrowest, _spots, top_k

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, k, every):
    import numpy as np

    good = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and abs(x) != float("inf") and x == x for x in v)]
    out = []
    for at, (i, v) in enumerate(good):
        if i % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(good) if n != at and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(hits[:k])]
    return sorted(out)


def vectors(seed, n, size, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(size)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.2) for c in centres[i % 5]], 0) for i in range(n)]


@pytest.mark.parametrize("settings", [Settings(), Settings(pivots=4, queries_at_once=5, block=16), Settings(pivots=1)])
@pytest.mark.parametrize("k", [3, 20])
def test_results_equal_comparing_everything(spark, settings, k):
    rows = vectors(1, 150, 6) + [(1000 + i, [0.5] * 6, 1) for i in range(40)]
    found = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k, settings=settings)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, k, 10)


def test_groups_far_away_are_not_sent(spark):
    rows = vectors(2, 200, 8, spread=40.0)
    found = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 5, settings=Settings(pivots=8, block=8))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 5, 20)


def test_many_blocks_are_merged_in_rounds(spark):
    rows = vectors(3, 400, 5)
    found = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 7, settings=Settings(pivots=1, block=4))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 7, 20)
    # Every task cuts its own lists before they are moved, in both rounds.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_rows_of_one_id_are_spread():
    import numpy as np

    same = np.zeros(4000, np.int64)
    rows = np.arange(8000, dtype=np.int64).reshape(4000, 2) - 4000
    counts = np.bincount((_spots(same, rows, 0x94D049BB133111EB) % np.uint64(16)).astype(int), minlength=16)
    assert counts.min() > 150 and counts.max() < 350
    assert [_narrowest(x) for x in (127.0, 128.0, 32767.0, 2.0**31 - 1, 2.0**31)] == [np.int8, np.int16, np.int16, np.int32, np.int64]


@pytest.mark.parametrize("parts", [1, 40])
def test_samples_are_the_first_by_hash(spark, parts):
    rows = spark.range(3000).selectExpr("id as doc_id", "cast(id % 10 = 0 as int) as label")
    hashed = sorted((r.h, r.doc_id, r.label) for r in rows.withColumn("h", F.xxhash64("doc_id")).collect())
    want = {label: [d for _, d, at in hashed if at == label][:50] for label in (0, 1)}
    got = chosen_rows(rows.repartition(parts), 50, 1000).collect()
    assert {label: sorted(r.doc_id for r in got if r.label == label) for label in (0, 1)} == {k: sorted(v) for k, v in want.items()}
    assert len(chosen_rows(rows.repartition(parts), 50, 30).collect()) == 30


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [None, 1.0], 0), (3, [float("nan"), 1.0], 0), (4, [float("inf"), 1.0], 0),
            (20, [0.1, -0.3], 0), (5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (None, [1.0, 1.0], 0), (7, [1.0, 2.0, 3.0], 0),
            (40, [1.0, 2.0, 3.0], 0), (60, [9.0] * 4, 0), (80, [], 0)]
    found = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 20)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20, 20)
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    big = [(0, [1e15, 3.0]), (1, [2.0, 1e3])]
    assert top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).first().score == (
        64 * 10**15 * 128 + 192 * 64000)
