from rosterlake.llm.mixing import emit, mix, source_targets

from odd_rows import documents, empty, ODD_TEXTS, rows  # noqa: F401  (fixtures)


def shared(sizes, weights):
    """Targets by sharing again and again."""
    total, target, full = sum(sizes), [0.0] * len(sizes), set()
    left = float(total)
    while True:
        open_ones = [i for i in range(len(sizes)) if i not in full]
        weight = sum(weights[i] for i in open_ones)
        for i in open_ones:
            target[i] = left * weights[i] / weight if weight else 0.0
        over = [i for i in open_ones if target[i] > 3 * sizes[i]]
        if not over:
            return target
        for i in over:
            target[i] = 3.0 * sizes[i]
            full.add(i)
            left -= target[i]


def test_targets_are_what_repeated_sharing_ends_at(spark):
    for sizes in ([10, 1000, 5], [1, 1, 1, 1, 1000], [0, 50, 7, 3, 900, 2, 2], [5], [3, 3, 0]):
        table = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
        got = [r.target for r in source_targets(table).orderBy("source").collect()]
        want = shared(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
        assert all(abs(a - b) < 1e-6 for a, b in zip(got, want)), (sizes, got, want)


def test_taken_words_come_near_the_targets(documents):
    docs = documents([(i, "w " * (1 + i % 40), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)])
    found = mix(docs).collect()
    for source in {r.row.source for r in found}:
        mine = [r for r in found if r.row.source == source]
        taken, target = sum(r.size * r.copies for r in mine), mine[0].target
        assert abs(taken - target) < 0.12 * target + 200 and max(r.copies for r in mine) <= 3
    again = mix(docs.repartition(7)).collect()
    assert sorted((r.row.doc_id, r.copies) for r in again) == sorted((r.row.doc_id, r.copies) for r in found)
    assert emit(mix(docs)).count() == sum(r.copies for r in found)


def test_odd_rows(documents, empty):
    docs = documents([(i, t, None, (None, "é", "z", "Z")[i % 4]) for i, t in enumerate(ODD_TEXTS)] + [(None, "a b", None, "z")],
                     extra=("size", "target", "row", "copies", "rate"))
    mixed = mix(docs)
    assert mixed.count() == len(ODD_TEXTS) + 1 and mixed.where("target is null or copies is null").count() == 0
    weights = {r.source: r.target for r in mixed.selectExpr("row.source", "target").distinct().collect()}
    assert set(weights) == {None, "é", "z", "Z"}
    assert emit(mixed).columns == docs.columns
    assert rows(mix(documents([(1, None), (2, " ")])), "size", "target", "copies") == [(0, 0.0, 0), (0, 0.0, 0)]
    assert mix(empty).count() == 0 and emit(mix(empty)).columns == empty.columns
