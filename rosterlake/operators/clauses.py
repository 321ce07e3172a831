"""Clause trees for a table of requests: every request brings its own tree as a column.

A tree is an array of nodes (id, parent, kind, text); the root has id 0 and every other node a greater id than its
parent. Kinds are ``any``, ``all`` and ``none`` for groups, and ``word``, ``prefix`` and ``phrase`` for leaves. The
leaves of all requests are matched together, by joins on words; each pair of request and document then has the scores
of its leaves, and the tree is one expression over them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import tokens
from .bounded import has_at_most
from .requests import answered, asked_once
from .scoring import SCORE_DIGITS, inverse_document_frequency, page_per_query, term_weight
from .search import AllOf, AnyOf, NoneOf, Phrase, Prefix, Word, _prepared
from .textindex import TextIndex, range_bucket, term_bucket

NODES = "array<struct<id:int,parent:int,kind:string,text:string>>"
_GROUPS = {AnyOf: "any", AllOf: "all", NoneOf: "none"}


def as_nodes(clause) -> list[tuple[int, int, str, str | None]]:
    """The nodes of a clause object, for a column of type :data:`NODES`."""
    out: list[tuple[int, int, str, str | None]] = []

    def add(node, parent: int) -> None:
        at = len(out)
        if type(node) in _GROUPS:
            out.append((at, parent, _GROUPS[type(node)], None))
            for child in node.clauses:
                add(child, at)
        elif isinstance(node, Word):
            out.append((at, parent, "word", node.text))
        elif isinstance(node, Prefix):
            out.append((at, parent, "prefix", node.text))
        elif isinstance(node, Phrase) and not node.slop:
            out.append((at, parent, "phrase", " ".join(node.words)))
        else:
            raise ValueError(f"not for tables of requests: {node!r}")

    add(clause, -1)
    return out


def evaluated(clause: Column, leaves: Column) -> Column:
    """Struct (holds, score) of a tree, where ``leaves`` maps the ids of matching leaves to their scores.

    Nodes are taken by falling id, so children come before their parent. A group adds up its members that hold; an
    excluded one adds nothing.
    """
    start = F.array().cast("array<struct<parent:int,holds:boolean,score:double>>")
    by_id = F.array_sort(clause, lambda a, b: b["id"] - a["id"])

    def step(done: Column, node: Column) -> Column:
        members = F.filter(done, lambda m: m["parent"] == node["id"])
        true = F.filter(members, lambda m: m["holds"])
        hit = F.element_at(leaves, node["id"])
        holds = (F.when(node["kind"] == "any", F.size(true) > 0).when(node["kind"] == "all", F.size(true) == F.size(members))
                 .when(node["kind"] == "none", F.size(true) == 0).otherwise(hit.isNotNull()))
        total = F.aggregate(true, F.lit(0.0), lambda s, m: s + m["score"])
        score = (F.when(node["kind"] == "none", F.lit(0.0)).when(node["kind"].isin("any", "all"), total)
                 .otherwise(F.coalesce(hit, F.lit(0.0))))
        return F.concat(done, F.array(F.struct(node["parent"].alias("parent"), holds.alias("holds"), score.alias("score"))))

    last = F.get(F.reverse(F.aggregate(by_id, start, step)), F.lit(0))
    return F.struct(F.coalesce(last["holds"], F.lit(False)).alias("holds"), F.coalesce(last["score"], F.lit(0.0)).alias("score"))


SHAPES = 32         # kinds of trees that have an expression of their own
SHAPE_NODES = 512   # nodes of all of them
NAMED_TEXTS = 4096  # words and prefixes that a computed index is cut to


def _shape(clause: Column) -> Column:
    """What a tree is but for its texts, as a text."""
    return F.array_join(F.transform(clause, lambda n: F.concat_ws(":", n["id"], n["parent"], n["kind"])), ",")


def _compiled(shape: str, leaves: Column) -> tuple[Column, Column]:
    """(holds, score) of trees of one shape, as :func:`evaluated` has them, without interpreting the tree for every document."""
    done: list[tuple[int, Column, Column]] = []
    nodes = [(int(i), int(parent), kind) for i, parent, kind in (n.split(":") for n in shape.split(","))]
    for i, parent, kind in sorted(nodes, key=lambda n: -n[0]):
        members = [(holds, score) for above, holds, score in done if above == i]
        hit = F.element_at(leaves, F.lit(i))
        if kind in ("any", "all", "none"):
            holds, score = F.lit(kind != "any"), F.lit(0.0)
            for held, value in members:
                holds = holds | held if kind == "any" else holds & held if kind == "all" else holds & ~held
                score = score if kind == "none" else score + F.when(held, value).otherwise(F.lit(0.0))
        else:
            holds, score = hit.isNotNull(), F.coalesce(hit, F.lit(0.0))
        done.append((parent, holds, score))
    return done[-1][1:]


def _judged(found: DataFrame, sound: DataFrame, few: bool) -> DataFrame:
    """query_id, doc_id, holds, score of the pairs of request and document by the scores of their ``leaves``."""
    send = F.broadcast if few else (lambda rows: rows)
    shapes = [r["shape"] for r in sound.select(_shape(F.col("clause")).alias("shape")).distinct().limit(SHAPES + 1).collect()]
    # Nodes without an id, a parent or a kind are left to the general way, as are trees of very many shapes.
    whole = all(re.fullmatch(r"-?\d+:-?\d+:[a-z]+", n) for shape in shapes for n in shape.split(","))
    if not shapes or not whole or len(shapes) > SHAPES or sum(shape.count(",") + 1 for shape in shapes) > SHAPE_NODES:
        judged = found.join(send(sound), "query_id").withColumn("_e", evaluated(F.col("clause"), F.col("leaves")))
        return judged.select("query_id", "doc_id", "_e.holds", "_e.score")
    number = F.coalesce(*[F.when(_shape(F.col("clause")) == shape, F.lit(k)) for k, shape in enumerate(shapes)])
    holds, score = F.lit(False), F.lit(0.0)
    for k, shape in enumerate(shapes):
        held, value = _compiled(shape, F.col("leaves"))
        holds, score = F.when(F.col("_shape") == k, held).otherwise(holds), F.when(F.col("_shape") == k, value).otherwise(score)
    return found.join(send(sound.select("query_id", number.alias("_shape"))), "query_id").select(
        "query_id", "doc_id", holds.alias("holds"), score.alias("score"))


def _cut(index: TextIndex, nodes: DataFrame) -> TextIndex:
    """The index with the words that the leaves name or begin, where they name few."""
    if index.counted is None:
        return index
    text = F.lower("text")
    named = nodes.where(F.col("kind").isin("word", "phrase")).select(F.lit(0).alias("n"), F.explode(tokens(text)).alias("text"))
    begun = nodes.where((F.col("kind") == "prefix") & (F.length("text") > 0)).select(F.length(text).alias("n"), text.alias("text"))
    asked = [(r["n"], r["text"]) for r in named.unionByName(begun).distinct().limit(NAMED_TEXTS + 1).collect()]
    if len(asked) > NAMED_TEXTS:
        return index
    lengths = sorted({n for n, _ in asked})

    def keep(term: Column) -> Column:
        kept = F.lit(False)
        for n in lengths:
            texts = sorted(t for m, t in asked if m == n)
            kept = kept | (F.substring(term, 1, n).isin(texts) if n else term.isin(texts))
        return kept

    return index.only(keep)


def clause_reason(clause: Column) -> Column:
    """Why a tree is not taken, or null.

    ``clause_without_words``: documents without any of its words match, that is, nearly all documents do.
    """
    known = F.forall(clause, lambda n: n["kind"].isin("any", "all", "none", "word", "prefix", "phrase")
                     & ((n["id"] == 0) | (n["parent"] < n["id"])))
    empty = F.create_map().cast("map<int,double>")
    return (F.when(F.coalesce(F.size(clause), F.lit(0)) <= 0, F.lit("no_clause")).when(~known, F.lit("bad_clause"))
            .when(evaluated(clause, empty)["holds"], F.lit("clause_without_words")))


def refused_clauses(requests: DataFrame, query_id: str = "query_id", clause: str = "clause") -> DataFrame:
    """(query_id, reason) of the requests that :func:`search_many` does not take."""
    return requests.select(F.col(query_id).alias("query_id"), clause_reason(F.col(clause)).alias("reason")).where("reason is not null")


def search_many(index: TextIndex, field: str, requests: DataFrame, query_id: str = "query_id", clause: str = "clause") -> DataFrame:
    """(query_id, doc_id, score) of the documents that match the tree of each request, scored as by :func:`search`.

    Requests that :func:`refused_clauses` names find nothing.
    """
    refused = refused_clauses(requests, query_id, clause).select("query_id")
    sound = requests.select(F.col(query_id).alias("query_id"), F.col(clause).alias("clause")).join(refused, "query_id", "left_anti")
    nodes = sound.select("query_id", F.inline("clause"))
    index = _cut(index, nodes)
    leaf = F.struct("query_id", "id").alias("leaf")

    def of(kind: str) -> DataFrame:
        return nodes.where(F.col("kind") == kind).select(leaf, F.lower("text").alias("text"))

    asked = _prepared(index, field, of("word"), "leaf", "text", tokens)
    words = asked.weighed(asked.postings).groupBy(F.col("query_id").alias("leaf"), "doc_id").agg(
        F.sum(asked.value(F.col("tf"), F.col("dl"))).alias("score"))
    hits = words.unionByName(_prefixes(index, field, of("prefix"))).unionByName(_phrases(index, field, of("phrase")))
    leaves = F.map_from_entries(F.collect_list(F.struct(F.col("leaf.id"), "score"))).alias("leaves")
    found = hits.groupBy(F.col("leaf.query_id").alias("query_id"), "doc_id").agg(leaves)
    judged = _judged(found, sound, has_at_most(nodes))
    return judged.where("holds").select("query_id", "doc_id", F.round("score", SCORE_DIGITS).alias("score"))


def search_pages(index: TextIndex, field: str, requests: DataFrame, size: int, skip: int = 0, query_id: str = "query_id",
                 clause: str = "clause") -> DataFrame:
    """The same page of the hits of :func:`search_many` for every request, with its ``rank``.

    Requests with the same tree are searched and ranked once.
    """
    once, whose = asked_once(requests.select(F.col(query_id).alias("query_id"), F.col(clause).alias("clause")))
    return answered(page_per_query(search_many(index, field, once), size, skip), whose)


def _of_terms(index: TextIndex, field: str, terms: DataFrame, *columns: str) -> DataFrame:
    """Postings of a table of terms, with its other columns."""
    postings, keys = index.postings.where(F.col("field") == field), ["term"]
    if index.buckets is not None:
        terms, keys = terms.withColumn("bucket", term_bucket(F.col("term"), index.buckets)), ["bucket", "term"]
    rows = postings.join(F.broadcast(terms) if has_at_most(terms) else terms, keys)
    return rows.select(*columns, "doc_id", "dl", "tf", "positions")


def _prefixes(index: TextIndex, field: str, leaves: DataFrame) -> DataFrame:
    """leaf, doc_id, score: 1 for every document with a word that starts with the prefix.

    Terms are joined by their beginnings of the lengths that are asked for.
    """
    asked = leaves.where(F.length("text") > 0).withColumn("n", F.length("text"))
    lengths = asked.agg(F.array_sort(F.collect_set("n")).alias("n")).scalar()
    stats = index.term_stats.where(F.col("field") == field).select("term", F.explode(lengths).alias("n"))
    begun = stats.where(F.col("n") <= F.length("term")).withColumn("text", F.substring(F.col("term"), F.lit(1), F.col("n")))
    terms = begun.join(asked, ["n", "text"]).select("leaf", "term")
    found = _of_terms(index, field, terms, "leaf").select("leaf", "doc_id").distinct()
    return found.select("leaf", "doc_id", F.lit(1.0).alias("score"))


def _phrases(index: TextIndex, field: str, leaves: DataFrame) -> DataFrame:
    """leaf, doc_id, score by the number of places where the words of a phrase stand in sequence."""
    split = leaves.select("leaf", tokens(F.col("text")).alias("words")).where(F.size("words") > 0)
    places = split.select("leaf", F.size("words").alias("n"), F.posexplode("words").alias("place", "term"))
    stats, keys = index.term_stats.where(F.col("field") == field), ["term"]
    asked = places.select("term").distinct()
    if index.buckets is not None:
        asked, keys = asked.withColumn("bucket", range_bucket(F.col("term"), index.bounds)), ["bucket", "term"]
    asked = F.broadcast(asked) if has_at_most(asked) else asked
    counts = stats.join(asked, keys, "left_semi").select("term", "df")
    n_docs, avg_dl = index.statistics(field)
    weighed = places.join(counts, "term")
    idf = weighed.groupBy("leaf").agg(F.sum(inverse_document_frequency(n_docs, F.col("df"))).alias("idf"))
    starts = _of_terms(index, field, weighed.select("leaf", "n", "place", "term"), "leaf", "n", "place").select(
        "leaf", "n", "place", "doc_id", "dl", F.explode(F.transform("positions", lambda p: p - F.col("place"))).alias("start"))
    whole = starts.groupBy("leaf", "n", "doc_id", "dl", "start").agg(F.count(F.lit(1)).alias("met")).where("met = n")
    frequent = whole.groupBy("leaf", "doc_id", "dl").agg(F.count(F.lit(1)).alias("f"))
    return frequent.join(idf, "leaf").select(
        "leaf", "doc_id", (F.col("idf") * term_weight(F.col("f"), F.col("dl"), avg_dl)).alias("score"))
