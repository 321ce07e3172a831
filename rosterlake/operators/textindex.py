"""Inverted index as DataFrames: postings, per-term and per-field statistics, document lengths."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import MAX_GRAM, edge_ngrams, tokens

WHOLE = ""  # term under which a document stands for itself; no token is empty
EVERYTHING = "everything"  # name of the field that combines all text fields


def field_tokens(docs: DataFrame, id_column: str, fields: Mapping[str, Column],
                 analyzer: Callable[[Column], Column] = tokens) -> DataFrame:
    """(field, doc_id, toks): the tokens of every field of every document that has any.

    Fields are unfolded through a generator, also a single one: its output is a plain column, so
    later steps use the tokens as often as they like without analysing the text again.
    """
    per_field = F.array(*[
        F.struct(F.lit(name).alias("field"), analyzer(text).alias("toks"))
        for name, text in fields.items()
    ])
    return (
        docs.select(F.col(id_column).alias("doc_id"), F.inline(per_field))
        .select("field", "doc_id", "toks").where(F.size("toks") > 0)
    )


def combined(columns: Iterable[str]) -> Column:
    """All named columns as one text, for searches over everything."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def range_bucket(term: Column, bounds: Sequence[str]) -> Column:
    """The range of terms that a term is in; ranges begin at the ``bounds``."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= term))


LENGTH_CLASSES = 64  # halves of a doubling of the length


def block_of(doc_id: Column, dl: Column, spread: int) -> Column:
    """The block of a document: one of ``spread`` for documents of similar length, whose weights for a word are alike."""
    length = F.least(F.floor(2 * F.log2(F.greatest(dl, F.lit(1)))), F.lit(LENGTH_CLASSES - 1))
    return (length * spread + F.pmod(F.xxhash64(doc_id, F.lit("block")), F.lit(spread))).cast("int")


@dataclass(frozen=True)
class TextIndex:
    """The tables a search reads, whether they come from disk or are computed from documents.

    ``postings``: field, term, doc_id, dl (field length in tokens), tf, positions.
    ``term_stats``: field, term, df. ``field_stats``: field, n_docs, avg_dl (one row per field).
    ``lengths``: field, doc_id, dl. ``buckets`` is set when postings are stored with a ``bucket`` partition column
    computed from the term; term statistics then have one of ranges of terms, which begin at ``bounds``, and ``known``
    holds the statistics per field as (documents, average length). ``similar``: field, variant (and ``bucket``), term
    leads from the deletions of the head of a word to the heads (or whole words) that have them. ``blocks``: field, term, block, max_tf, min_dl
    (and ``bucket``) bound what a word adds to the score of a document of a block; documents of one length class lie in
    ``spread`` blocks. ``counted`` makes the postings and term statistics of some terms of a computed index. ``rows`` of a computed index are its postings plus one
    row per document under the empty term: a search that reads them learns the statistics from the
    same pass over the text.
    """

    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    lengths: DataFrame
    buckets: int | None = None
    known: Mapping[str, tuple[int, float]] | None = None
    rows: DataFrame | None = None
    bounds: Sequence[str] = ()
    similar: DataFrame | None = None
    blocks: DataFrame | None = None
    spread: int = 0
    counted: Callable[[Callable[[Column], Column]], tuple[DataFrame, DataFrame]] | None = None

    def only(self, keep: Callable[[Column], Column]) -> "TextIndex":
        """The same index for searches that need no other terms than ``keep`` has. A computed one leaves the other words
        out inside the documents, before it sorts and counts what is left."""
        if self.counted is None:
            return self
        postings, stats = self.counted(keep)
        return replace(self, postings=postings, term_stats=stats)

    def statistics(self, field: str) -> tuple[Column, Column]:
        """Number of documents and average length of one field: constants, or scalar subqueries."""
        if self.known is not None:
            n_docs, avg_dl = self.known.get(field, (0, 0.0))
            return F.lit(n_docs), F.lit(avg_dl)
        one = self.field_stats.where(F.col("field") == field)
        return one.select("n_docs").scalar(), one.select("avg_dl").scalar()

    def has_term(self, words: Iterable[str]) -> Column:
        """Condition on postings: the term is one of ``words``.

        On a stored index it also names the buckets of the words, so other directories are not read.
        """
        words = sorted(set(words))
        found = F.col("term").isin(words)
        if self.buckets is None:
            return found
        return found & F.col("bucket").isin([term_bucket(F.lit(w), self.buckets) for w in words])

    def counts_term(self, words: Iterable[str]) -> Column:
        """The same condition on term statistics."""
        words = sorted(set(words))
        found = F.col("term").isin(words)
        if self.buckets is None:
            return found
        return found & F.col("bucket").isin(sorted({bisect_right(self.bounds, w) for w in words}))

    def begins_with(self, prefix: str) -> Column:
        """Condition on term statistics: the term starts with ``prefix``. Stored ranges beyond it are not read."""
        found = F.col("term").startswith(prefix)
        if self.buckets is None or not prefix:
            return found
        last = bisect_right(self.bounds, prefix + chr(0x10FFFF))
        return found & F.col("bucket").between(bisect_right(self.bounds, prefix), last)

    @staticmethod
    def over(docs: DataFrame, id_column: str, fields: Mapping[str, Column],
             analyzer: Callable[[Column], Column] = tokens, first: Callable[[Column], Column] = F.lit) -> "TextIndex":
        """Index computed on the fly; ``id_column`` should be unique in ``docs``, rows of one id are gathered otherwise.

        ``postings`` are made inside each document, without a shuffle. Filters on ``field``/``term`` of a search
        move below the aggregation of ``rows``, so that only the words asked for are counted and shuffled. The postings
        of a document come in the order of ``first`` of the term, then of the term: a later sort by both finds long runs.
        """
        toks = field_tokens(docs, id_column, fields, analyzer)
        placed = F.transform("toks", lambda t, i: F.struct(first(t).alias("first"), t.alias("term"), i.alias("pos")))
        repeated = ids_repeat(docs, id_column)
        postings = _whole_postings(toks, placed, repeated)
        # Where a row is a document, its different words are all that counting them needs.
        stats = term_stats(postings) if repeated else toks.select(
            "field", F.explode(F.array_distinct("toks")).alias("term")).groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        lengths = toks.select("field", "doc_id", F.size("toks").alias("dl"))
        rows = _postings(toks.select("field", "doc_id", F.size("toks").alias("dl"),
                                     F.posexplode(F.array_append("toks", F.lit(WHOLE))).alias("pos", "term")))

        def counted(keep: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
            kept = toks.select("field", "doc_id", F.size("toks").alias("dl"),
                               F.inline(F.array(F.struct(F.filter(placed, lambda w: keep(w["term"])).alias("placed")))))
            some = _gathered(kept.where(F.size("placed") > 0), repeated)
            if repeated:
                return some, term_stats(some)
            words = toks.select("field", F.explode(F.array_distinct(F.filter("toks", keep))).alias("term"))
            return some, words.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))

        return TextIndex(postings, stats, field_stats(lengths), lengths, rows=rows, counted=counted)

    @staticmethod
    def over_prefixes(docs: DataFrame, id_column: str, fields: Mapping[str, Column],
                      max_gram: int = MAX_GRAM, analyzer: Callable[[Column], Column] = tokens,
                      first: Callable[[Column], Column] = F.lit) -> "TextIndex":
        """Edge n-gram index: every prefix of every token is a term at the position of its token.

        A document is as long as it has tokens, while the average length counts all n-grams, as
        the scoring library does for terms that share a position.
        """
        toks = field_tokens(docs, id_column, fields, analyzer)
        placed = F.flatten(F.transform("toks", lambda t, i: F.transform(
            edge_ngrams(t, max_gram), lambda gram: F.struct(first(gram).alias("first"), gram.alias("term"), i.alias("pos")))))
        postings = _whole_postings(toks, placed, ids_repeat(docs, id_column))
        gram_count = F.aggregate(
            "toks", F.lit(0), lambda n, t: n + F.least(F.lit(max_gram), F.length(t)))
        lengths = toks.select("field", "doc_id", F.size("toks").alias("dl"),
                              gram_count.alias("weight"))
        stats = lengths.groupBy("field").agg(
            F.count(F.lit(1)).alias("n_docs"),
            (F.sum("weight") / F.count(F.lit(1))).alias("avg_dl"),
        )
        return TextIndex(postings, term_stats(postings), stats, lengths.drop("weight"))


def ids_repeat(docs: DataFrame, id_column: str) -> bool:
    """Whether rows share an id (null counts as one); reads the ids alone."""
    return not docs.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def ids_met(docs: DataFrame, id_column: str) -> tuple[bool, bool]:
    """Whether rows share an id (null counts as one), and whether one has none; reads the ids alone."""
    key = F.col(id_column)
    met = docs.groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("most"), F.max(F.col("id").isNull()).alias("null")).first()
    return (met["most"] or 0) > 1, bool(met["null"])


def _by_term(placed: Column) -> Column:
    """Array of (term, positions) with one entry per term, from an array of (first, term, pos) in any order.

    Sorting puts the places of a term together; an entry reaches from where the term begins to where the next begins.
    """
    def entries(ordered: Column, starts: Column) -> Column:
        def entry(start: Column, k: Column) -> Column:
            after = F.coalesce(F.get(starts, k + 1), F.size(ordered))
            return F.struct(F.get(ordered, start)["term"].alias("term"),
                            F.slice(ordered, start + 1, after - start)["pos"].alias("positions"))

        return F.transform(starts, entry)

    def grouped(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda i: (i == 0) | ~F.get(ordered, i)["term"].eqNullSafe(F.get(ordered, i - 1)["term"]))
        return F.flatten(F.transform(F.array(starts), lambda s: entries(ordered, s)))

    # Arrays of one array, so that the sorted places and the starts are computed once and not per entry.
    return F.flatten(F.transform(F.array(F.sort_array(placed)), grouped))


def _whole_postings(toks: DataFrame, placed: Column, repeated: bool) -> DataFrame:
    """Postings of all words, counted inside each document: nothing is exploded before it is counted, so nothing has
    to be sorted or shuffled. Rows of one id and length count as one document; they are gathered first."""
    return _gathered(toks.select("field", "doc_id", F.size("toks").alias("dl"), placed.alias("placed")), repeated)


def _gathered(docs: DataFrame, repeated: bool) -> DataFrame:
    """Postings of the placed words of documents (field, doc_id, dl, placed), of which each has one at least."""
    if repeated:
        docs = docs.groupBy("field", "doc_id", "dl").agg(F.flatten(F.collect_list("placed")).alias("placed"))
    words = docs.select("field", "doc_id", "dl", F.inline(_by_term(F.col("placed"))))
    return words.select("field", "term", "doc_id", "dl", F.size("positions").alias("tf"), "positions")


def _postings(words: DataFrame) -> DataFrame:
    return words.groupBy("field", "term", "doc_id", "dl").agg(
        F.count(F.lit(1)).cast("int").alias("tf"),
        F.array_sort(F.collect_list("pos")).alias("positions"),
    )


def term_stats(postings: DataFrame) -> DataFrame:
    """Document frequency per term; it reads ``tf`` so that a search computed on the fly shares one
    shuffle between its postings and their frequencies."""
    return postings.groupBy("field", "term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def field_stats(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"),
        (F.sum("dl") / F.count(F.lit(1))).alias("avg_dl"),
    )
