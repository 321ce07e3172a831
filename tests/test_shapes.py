import random

from pyspark.sql import functions as F

from rosterlake.operators import clauses
from rosterlake.operators.clauses import NODES, search_many
from rosterlake.operators.textindex import TextIndex
from conftest import plan_of

WORDS = ["red", "reed", "blue", "green", "old", "new", "the", "of"]
_random = random.Random(5)
DOCS = [(i, " ".join(_random.choice(WORDS) for _ in range(_random.randint(0, 9)))) for i in range(80)] + [(80, None)]


def tree():
    """A random tree whose root needs a word."""
    leaf = lambda i, parent: (i, parent, *_random.choice([("word", _random.choice(WORDS)), ("prefix", _random.choice(["re", "o", "N", ""])),
                                                          ("phrase", f"{_random.choice(WORDS)} {_random.choice(WORDS)}")]))
    return [(0, -1, "all", None), (1, 0, _random.choice(["any", "all"]), None), leaf(2, 1), leaf(3, 1), leaf(4, 0),
            (5, 0, _random.choice(["none", "any"]), None), leaf(6, 5), *([leaf(7, 5)] if _random.random() < 0.5 else [])]


def test_trees_by_their_shape_equal_interpreted_trees(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "id int, text string")
    # A null kind is neither a group nor a leaf that matches.
    trees = [(i, tree()) for i in range(25)] + [(100, [(0, -1, "word", "red")]), (101, [(0, -1, "phrase", "the of")]), (102, [])]
    odd = [(103, [(0, -1, "any", None), (1, 0, "word", "red"), (2, 0, None, "old")])]
    schema = f"query_id int, clause {NODES}"
    results = {}
    for name, asked in (("trees", trees), ("odd", trees + odd)):
        requests = spark.createDataFrame(asked, schema)
        for shapes, texts in ((32, 4096), (0, -1)):
            monkeypatch.setattr(clauses, "SHAPES", shapes)
            monkeypatch.setattr(clauses, "NAMED_TEXTS", texts)
            hits = search_many(TextIndex.over(docs, "id", {"text": F.col("text")}), "text", requests)
            results[name, shapes] = plan_of(hits), sorted(hits.collect())
    assert results["trees", 32][1] == results["trees", 0][1] and len(results["trees", 0][1]) > 100
    assert results["odd", 32][1] == results["odd", 0][1]
    # Neither the trees nor their texts go with the pairs of request and document.
    general, own = results["trees", 0][0], results["trees", 32][0]
    assert "_shape" in own and "aggregate(" not in own.split("_shape")[0] and "_shape" not in general


def test_a_computed_index_is_cut_inside_documents(spark):
    for rows in (DOCS, DOCS + DOCS[:20] + [(3, "red red blue")]):
        index = TextIndex.over(spark.createDataFrame(rows, "id int, text string"), "id", {"text": F.col("text")})
        cut = index.only(lambda t: t.isin("red", "the") | (F.substring(t, 1, 1) == "b"))
        kept = F.col("term").isin("red", "the", "blue")
        for whole, part in ((index.postings, cut.postings), (index.term_stats, cut.term_stats)):
            want = whole.where(kept).collect()
            assert sorted(map(str, part.select(*whole.columns).collect())) == sorted(map(str, want)) and want
        none = index.only(lambda t: F.lit(False))
        assert none.postings.count() == none.term_stats.count() == 0
