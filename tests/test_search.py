import random

import pytest
from pyspark.sql import functions as F

from brute import Corpus, edits, swap_edits
from conftest import plan_of
from rosterlake.functions.text import deletions, edge_ngrams, tokens, word_deletions
from rosterlake.operators.clauses import NODES, as_nodes, refused_clauses, search_many, search_pages
from rosterlake.operators.requests import answered, asked_once
from rosterlake.operators.scoring import page, page_after, page_deep, page_per_query, total_hits
from rosterlake.operators.search import (
    Fuzzy, Prefix, Word, _blocks_within, _prepared, all_of, any_of, in_blocks, match, match_many, none_of, phrase, search, top_many,
)
from rosterlake.operators.textindex import TextIndex
from rosterlake.plans.indexing import StoredIndex

VOCABULARY = ["alpha", "beta", "gamma", "delta", "alpine", "alpah", "bet", "été", "x1"]
def fields():
    return {"text": F.col("text")}


def make_texts(n=60, seed=7, first=0):
    rng = random.Random(seed)
    texts = {first + i: " ".join(rng.choices(VOCABULARY, weights=range(9, 0, -1), k=rng.randint(1, 12)))
             for i in range(n)}
    texts[first + n] = "--- !!"
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id bigint, text string")


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def corpus(texts):
    return Corpus(texts)


@pytest.fixture(scope="module", params=["computed", "stored"])
def index(request, spark, texts, tmp_path_factory):
    if request.param == "computed":
        return TextIndex.over(frame(spark, texts).persist(), "id", fields())
    stored = StoredIndex(spark, str(tmp_path_factory.mktemp("index") / "ix"), "id", fields(), buckets=4)
    stored.build(frame(spark, texts))
    return stored.open()


def result(df):
    return {r["doc_id"]: r["score"] for r in df.collect()}


def agrees(df, want):
    got = result(df)
    assert got.keys() == want.keys()
    assert all(abs(got[d] - want[d]) < 2e-6 for d in want)


def test_ranked_match_counts_repeated_words(index, corpus):
    agrees(match(index, "text", "Alpha beta, alpha été zzz"), corpus.match("alpha beta alpha été zzz"))


def test_match_without_words_finds_nothing(index):
    assert match(index, "text", "?!").count() == 0 and match(index, "text", "zzz").count() == 0


def test_all_of(index, corpus):
    want = {d: s for d, s in corpus.match("alpha gamma").items() if {"alpha", "gamma"} <= set(corpus.docs[d])}
    agrees(search(index, "text", all_of(Word("alpha"), Word("gamma"))), want)


def test_none_of_alone_covers_all_documents(index, corpus):
    want = {d: 0.0 for d, ws in corpus.docs.items() if "alpha" not in ws and "bet" not in ws}
    agrees(search(index, "text", none_of(Word("alpha"), Word("bet"))), want)


def test_any_of_with_an_excluded_word_as_alternative(index, corpus):
    want = {d: corpus.word("beta", d) or 0.0 for d, ws in corpus.docs.items() if "beta" in ws or "alpha" not in ws}
    agrees(search(index, "text", any_of(Word("beta"), none_of(Word("alpha")))), want)


def test_nested_groups(index, corpus):
    clause = all_of(any_of(all_of(Word("alpha"), Word("beta")), Word("x1")), none_of(Prefix("alpi")))
    want = {}
    for d, ws in corpus.docs.items():
        pair = {"alpha", "beta"} <= set(ws)
        if (pair or "x1" in ws) and "alpine" not in ws:
            want[d] = (corpus.word("alpha", d) + corpus.word("beta", d) if pair else 0) + (corpus.word("x1", d) or 0)
    agrees(search(index, "text", clause), want)


def test_prefix_has_constant_score_and_contains_the_exact_word(index, corpus):
    hits = result(search(index, "text", Prefix("alp")))
    assert hits == {d: 1.0 for d, ws in corpus.docs.items() if any(w.startswith("alp") for w in ws)}
    assert set(result(search(index, "text", Word("alpha")))) <= set(hits)


@pytest.mark.parametrize("limit", [1, 2])
def test_fuzzy(index, corpus, limit):
    near = {w: edits(w, "alpha") for w in corpus.df if edits(w, "alpha") <= limit}
    most = max(corpus.df[w] for w in near)
    want = {}
    for d in corpus.docs:
        parts = [max(0, 1 - e / min(len(w), 5)) * corpus.idf(most) * corpus.norm(corpus.tf[d][w], d)
                 for w, e in near.items() if corpus.tf[d][w]]
        if parts:
            want[d] = sum(parts)
    agrees(search(index, "text", Fuzzy("alpha", limit)), want)


@pytest.mark.parametrize("limit", [1, 2])
def test_fuzzy_with_transpositions(index, corpus, limit):
    hits = result(search(index, "text", Fuzzy("alpha", limit, transpositions=True)))
    near = {w for w in corpus.df if swap_edits("alpha", w) <= limit}
    assert set(hits) == {d for d, ws in corpus.docs.items() if near & set(ws)}
    assert "alpah" in near and edits("alpah", "alpha") == 2


@pytest.mark.parametrize("words_,slop", [
    (("alpha", "beta"), 0), (("alpha", "alpha"), 0), (("alpha", "beta", "alpha"), 0), (("alpha", "beta"), 1),
    (("alpha", "beta", "gamma"), 3), (("gamma", "alpha"), 5), (("alpha", "zzz"), 2),
    (("alpha", "alpha"), 2), (("alpha", "beta", "alpha"), 1), (("beta", "beta", "beta"), 4),
    (("alpha", "beta", "alpha", "alpha"), 3),
])
def test_phrases(index, corpus, words_, slop):
    agrees(search(index, "text", phrase(list(words_), slop)), corpus.phrase(words_, slop))


def test_a_table_of_requests_equals_single_requests(spark, index):
    requests = {1: "alpha beta alpha", 2: "été", 3: "zzz", 4: "gamma x1"}
    table = spark.createDataFrame(list(requests.items()), "query_id bigint, query string")
    got = {}
    for r in match_many(index, "text", table).collect():
        got.setdefault(r["query_id"], {})[r["doc_id"]] = r["score"]
    for q, text in requests.items():
        single = result(match(index, "text", text))
        assert got.get(q, {}).keys() == single.keys()
        assert all(abs(got[q][d] - s) < 2e-6 for d, s in single.items())


def test_pages_add_up_to_the_ranking(index, corpus):
    hits = match(index, "text", "alpha beta")
    ranking = sorted(result(hits).items(), key=lambda h: (-h[1], h[0]))
    paged, after = [], []
    for skip in range(0, len(ranking), 7):
        paged += [(r["doc_id"], r["score"]) for r in page(hits, 7, skip).collect()]
    last = (float("inf"), -1)
    while rows := page_after(hits, *last, 11).collect():
        after += [(r["doc_id"], r["score"]) for r in rows]
        last = (rows[-1]["score"], rows[-1]["doc_id"])
    assert paged == ranking == after
    assert total_hits(hits).first()["total"] == len(ranking) and total_hits(hits, 5).first()["total"] == 5
    with pytest.raises(ValueError):
        page(hits, -1)


def test_deep_pages_per_query(spark):
    hits = spark.range(6000).select(
        (F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), F.round(F.rand(3), 2).alias("score")
    ).persist()
    got = [tuple(r) for r in page_per_query(hits, 200, 1500).where("query_id = 1").orderBy("rank")
           .select("rank", "doc_id").collect()]
    order = sorted((r for r in hits.collect() if r["query_id"] == 1), key=lambda r: (-r["score"], r["doc_id"]))
    assert got == [(i + 1, order[i]["doc_id"]) for i in range(1500, 1700)]


def test_refreshing_equals_rebuilding(spark, tmp_path):
    texts = make_texts(40, 3)
    stored = StoredIndex(spark, str(tmp_path / "a"), "id", fields(), buckets=4)
    stored.build(frame(spark, texts))
    changed = {**{i: t for i, t in make_texts(8, 5).items() if i < 8}, 100: "brand new alpha", 101: "..."}
    stored.refresh(frame(spark, changed), frame(spark, {20: "", 21: "", 999: ""}))
    now = {i: t for i, t in {**texts, **changed}.items() if i not in (20, 21)}
    fresh = StoredIndex(spark, str(tmp_path / "b"), "id", fields(), buckets=4)
    fresh.build(frame(spark, now))
    a, b = stored.open(), fresh.open()
    for name in ("postings", "term_stats", "lengths"):
        left, right = getattr(a, name), getattr(b, name)
        columns = [c for c in left.columns if c != "bucket"]
        assert sorted(map(str, left.select(*columns).collect())) == sorted(map(str, right.select(*columns).collect()))
    assert a.known["text"][0] == b.known["text"][0] and abs(a.known["text"][1] - b.known["text"][1]) < 1e-9
    agrees(match(a, "text", "alpha new beta"), Corpus(now).match("alpha new beta"))


def test_several_fields_and_ids_of_other_fields(spark):
    docs = spark.createDataFrame([(1, "red fox", "den"), (2, "den", None)], "id bigint, a string, b string")
    index = TextIndex.over(docs, "id", {"a": F.col("a"), "b": F.col("b")})
    assert set(result(match(index, "a", "den"))) == {2} and set(result(match(index, "b", "den"))) == {1}
    stats = {r["field"]: (r["n_docs"], r["avg_dl"]) for r in index.field_stats.collect()}
    assert stats == {"a": (2, 1.5), "b": (1, 1.0)}


def test_word_rules(spark):
    df = spark.createDataFrame([("L'Hospitalet csc_1004 3.14 北京 カタ __",)], "t string")

    def analysed(**rules):
        return df.select(tokens(F.col("t"), **rules)).first()[0]

    assert analysed() == ["l", "hospitalet", "csc", "1004", "3", "14", "北京", "カタ"]
    assert analysed(cjk_unigrams=True)[6:] == ["北", "京", "カタ"]
    assert analysed(rules="standard") == ["l'hospitalet", "csc_1004", "3.14", "北", "京", "カタ"]
    with pytest.raises(ValueError):
        tokens(F.col("t"), rules="other")


def test_edge_ngrams_count_characters(spark):
    df = spark.createDataFrame([("été",), ("a" * 25,)], "t string")
    grams = [r[0] for r in df.select(edge_ngrams(F.col("t"))).collect()]
    assert grams[0] == ["é", "ét", "été"] and len(grams[1]) == 20 and grams[1][-1] == "a" * 20


def test_words_within_two_edits_have_a_common_deletion(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 12)))
        b = list(a)
        for _ in range(rng.randrange(3)):
            at, how = rng.randrange(len(b) + 1), rng.randrange(4)
            if how == 0:
                b.insert(at, rng.choice("abcé"))
            elif how == 1 and at < len(b):
                del b[at]
            elif how == 2 and at < len(b):
                b[at] = rng.choice("abcé")
            elif how == 3 and at + 1 < len(b):
                b[at], b[at + 1] = b[at + 1], b[at]
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", deletions(F.col("b")).alias("d")).collect()
    for row in rows:
        assert sorted(row.d) == word_deletions(row.b)
        assert set(word_deletions(row.a)) & set(row.d), row


def test_similar_words_of_a_stored_index(spark, tmp_path):
    texts = make_texts(60, 9)
    kept = [StoredIndex(spark, str(tmp_path / str(n)), "id", fields(), buckets=4, similar=n == 1) for n in range(2)]
    for index in kept:
        index.build(frame(spark, texts))
    for leaf in (Fuzzy("alpha", 2), Fuzzy("alpha", 1, True), Fuzzy("bxt", 2), Fuzzy("gamma", 3), Fuzzy("x", 0)):
        clause = any_of(leaf, Word("delta"), Prefix("alp"))
        one, two = (result(search(i.open(), "text", clause)) for i in kept)
        assert one == two and one == result(search(TextIndex.over(frame(spark, texts), "id", fields()), "text", clause)), leaf


def test_words_that_begin_alike_share_their_deletions(spark, tmp_path):
    # The last character of some lies beyond the bounds that share the terms evenly.
    texts = {n: f"abcdefg{c} x{n}" for n, c in enumerate(["", "1", "2", "99", "\u00e9", "\U0001F600z", "longer"])}
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", fields(), buckets=4, similar=True)
    index.build(frame(spark, texts))
    kept = index.tables["similar"].read()
    assert kept.where(F.col("variant").startswith("abcde")).select("term").distinct().count() == 1
    plain = TextIndex.over(frame(spark, texts), "id", fields())
    leaves = (Fuzzy("abcdefg1", 1), Fuzzy("abcdefg", 2), Fuzzy("bacdefg2", 2, True), Fuzzy("x1", 1), Fuzzy("abcdefg", 0))
    want = [result(search(plain, "text", leaf)) for leaf in leaves]
    assert want == [result(search(index.open(), "text", leaf)) for leaf in leaves] and len(want[0]) == 5
    # Tables that lead to whole words are read as well.
    words = index.open().term_stats.select("field", "term")
    index.tables["similar"].replace(words.select("field", F.explode(deletions(F.col("term"))).alias("variant"), "term"))
    assert want == [result(search(index.open(), "text", leaf)) for leaf in leaves]


def test_the_analyser_of_a_stored_index_is_chosen(spark, tmp_path):
    index = StoredIndex(spark, str(tmp_path / "a"), "id", fields(), buckets=2,
                        analyzer=lambda c: tokens(c, rules="standard"))
    index.build(frame(spark, {1: "l'hospitalet 3.14", 2: "l hospitalet"}))
    assert set(result(search(index.open(), "text", Word("l'hospitalet")))) == {1}
    index.refresh(frame(spark, {2: "csc_1004"}))
    assert set(result(search(index.open(), "text", Word("csc_1004")))) == {2}


def test_blocks_that_cannot_be_on_a_page_are_left_out(spark, tmp_path):
    rng = random.Random(30)
    words = [f"w{n}" for n in range(40)]
    texts = {i: " ".join(rng.choices(words, weights=[1 / (n + 1) for n in range(40)], k=rng.choice([3, 10, 40, 160])))
             for i in range(1500)}
    stored = StoredIndex(spark, str(tmp_path / "ix"), "id", fields(), buckets=4, blocks=128)
    stored.build(frame(spark, texts))
    asked = spark.createDataFrame(
        [(n, " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for n in range(30)] + [(99, "nothing"), (100, "...")],
        "query_id int, query string")

    def check(texts):
        index, computed = stored.open(), TextIndex.over(frame(spark, texts), "id", fields())
        for size in (1, 7, 2000):
            got = top_many(index, "text", asked, size)
            want = page_per_query(match_many(computed, "text", asked), size)
            columns = ["query_id", "rank", "doc_id", "score"]
            assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))

    check(texts)
    index = stored.open()
    requests = _prepared(index, "text", asked, "query_id", "query", tokens)
    rows = requests.weighed(requests.postings).withColumn("value", requests.value(F.col("tf"), F.col("dl"))).persist()
    kept = in_blocks(index, rows, _blocks_within(index, requests, rows, 7)).count()
    assert kept < 0.7 * rows.count(), (kept, rows.count())
    changed = {**{i: "w39 w39 w38" for i in range(40)}, 5000: "w0 w0"}
    stored.refresh(frame(spark, changed), frame(spark, {700: "", 701: ""}))
    check({i: t for i, t in {**texts, **changed}.items() if i not in (700, 701)})


def test_a_table_of_clause_trees_equals_single_searches(spark, index):
    trees = [
        Word("alpha"), all_of(Word("alpha"), Word("beta")), all_of(any_of(Word("gamma"), Word("été")), none_of(Word("alpha"))),
        phrase("alpha beta"), phrase("beta alpha beta"), Prefix("alp"), any_of(Prefix("al"), phrase("beta gamma"), Word("zzz")),
        all_of(any_of(all_of(Word("alpha"), Word("beta")), all_of(Prefix("de"), none_of(Prefix("be")))), none_of(Word("x1"))),
        any_of(Word("alpha"), Word("alpha")), all_of(Word("alpha"), none_of(all_of(Word("beta"), Word("gamma")))),
        Word("zzz"), phrase("zzz alpha"),
    ]
    refused = [none_of(Word("alpha")), any_of(Word("alpha"), none_of(Word("beta")))]
    rows = [(n, as_nodes(t)) for n, t in enumerate([*trees, *refused])] + [(50, None), (51, []), (52, [(0, -1, "huh", "x")])]
    requests = spark.createDataFrame(rows, f"query_id int, clause {NODES}")
    got = {}
    for r in search_many(index, "text", requests).collect():
        got.setdefault(r["query_id"], {})[r["doc_id"]] = r["score"]
    for n, tree in enumerate(trees):
        want = result(search(index, "text", tree))
        assert got.get(n, {}).keys() == want.keys(), tree
        assert all(abs(got[n][d] - want[d]) < 2e-6 for d in want), tree
    assert set(got) <= set(range(len(trees)))
    reasons = {r["query_id"]: r["reason"] for r in refused_clauses(requests).collect()}
    assert reasons == {12: "clause_without_words", 13: "clause_without_words", 50: "no_clause", 51: "no_clause", 52: "bad_clause"}
    with pytest.raises(ValueError):
        as_nodes(Fuzzy("alpha"))


@pytest.mark.parametrize("values", [1, 3, 1000])
def test_deep_pages_are_counted_and_not_ranked(spark, values):
    rng = random.Random(values)
    rows = [(i, round(rng.randrange(values) / 7, 6)) for i in rng.sample(range(10_000), 700)]
    hits = spark.createDataFrame(rows, "doc_id bigint, score double").persist()
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for skip in (0, 1, 333, 690, 699, 700, 5000):
        got = [tuple(r) for r in page_deep(hits, 25, skip, at_most=10, buckets=8).collect()]
        assert got == order[skip:skip + 25], skip
    with pytest.raises(ValueError):
        page_deep(hits, -1, 0)


def test_postings_are_counted_inside_documents(spark):
    def found(rows, **options):
        docs = spark.createDataFrame(rows, "id bigint, text string")
        index = TextIndex.over(docs, "id", {"text": F.col("text")}) if not options else TextIndex.over_prefixes(
            docs, "id", {"text": F.col("text")}, **options)
        got = sorted((r["term"], r["doc_id"] is None, r["doc_id"] or 0, r["dl"], r["tf"], r["positions"]) for r in index.postings.collect())
        counts = {r["term"]: r["df"] for r in index.term_stats.collect()}
        return index, got, counts

    index, got, counts = found([(1, "b a b"), (2, None), (3, "."), (4, "a")])
    assert got == [("a", False, 1, 3, 1, [1]), ("a", False, 4, 1, 1, [0]), ("b", False, 1, 3, 2, [0, 2])]
    assert counts == {"a": 2, "b": 1}
    # Words are not unfolded before they are counted, which took a sort of all of them.
    plan = plan_of(index.postings)
    assert "Aggregate" not in plan and "Exchange" not in plan and plan.count("Generate") == 2
    # Rows of one id and length are one document, with an id that is null too.
    _, got, counts = found([(1, "b a b"), (1, "c a c"), (1, "a"), (None, "x y"), (None, "y x")])
    assert got == [("a", False, 1, 1, 1, [0]), ("a", False, 1, 3, 2, [1, 1]), ("b", False, 1, 3, 2, [0, 2]),
                   ("c", False, 1, 3, 2, [0, 2]), ("x", True, 0, 2, 2, [0, 1]), ("y", True, 0, 2, 2, [0, 1])]
    assert counts == {"a": 2, "b": 1, "c": 1, "x": 1, "y": 1}
    _, got, _ = found([(1, "ab ac ab")], max_gram=2)
    assert got == [("a", False, 1, 3, 3, [0, 1, 2]), ("ab", False, 1, 3, 2, [0, 2]), ("ac", False, 1, 3, 1, [1])]


def test_requests_that_ask_the_same_are_answered_once(spark):
    rows = [(1, "a", 2), (2, "a", 2), (3, "b", 1), (4, "b", None), (5, "a", 2), (5, "b", 1), (6, "b", 1), (6, "a", 2), (7, "b", None)]
    once, whose = asked_once(spark.createDataFrame(rows, "query_id int, query string, n int"))
    assert sorted((tuple(r) for r in once.collect()), key=str) == sorted(
        [(1, "a", 2), (3, "b", 1), (4, "b", None), (5, "a", 2), (5, "b", 1)], key=str)
    assert {r["query_id"]: r["question"] for r in whose.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 4}
    hits = spark.createDataFrame([(1, 10), (5, 11)], "query_id int, doc_id int")
    assert sorted(tuple(r) for r in answered(hits, whose).collect()) == [(1, 10), (2, 10), (5, 11), (6, 11)]


def test_pages_of_equal_clause_trees(spark):
    docs = spark.createDataFrame([(i, "the cat" if i % 2 else "the dog cat") for i in range(40)], "id bigint, text string")
    index = TextIndex.over(docs, "id", {"text": F.col("text")})
    trees = [as_nodes(all_of(Word("the"), Word("dog"))), as_nodes(all_of(Word("cat"), none_of(Word("dog"))))]
    requests = spark.createDataFrame([(q, trees[q % 2]) for q in range(200)], f"query_id int, clause {NODES}")
    pages = search_pages(index, "text", requests, 3, skip=1)
    whole = page_per_query(search_many(index, "text", requests), 3, 1)
    key = lambda r: (r["query_id"], r["rank"], r["doc_id"], r["score"])
    assert sorted(map(key, pages.collect())) == sorted(map(key, whole.collect())) and pages.count() == 600
