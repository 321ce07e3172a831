"""Full-text search over a :class:`TextIndex`: ranked match and structured clauses.

A search is one pass over the postings of its words: rows are summed per document into one score and
one flag per leaf clause, and the clause tree is then an ordinary boolean column over those flags.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import SIMILAR_EDITS, SIMILAR_HEAD, head_of, query_tokens, tokens, word_deletions
from .bounded import has_at_most
from .scoring import SCORE_DIGITS, inverse_document_frequency, page_per_query, term_weight
from .textindex import LENGTH_CLASSES, WHOLE, TextIndex, block_of, range_bucket, term_bucket


# -- clauses ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Word:
    """Documents with this token."""

    text: str


@dataclass(frozen=True)
class Prefix:
    """Documents with a token that starts with ``text``; constant score 1."""

    text: str


@dataclass(frozen=True)
class Fuzzy:
    """Documents with a token within ``edits`` edits; ``transpositions`` lets an adjacent swap count once."""

    text: str
    edits: int = 2
    transpositions: bool = False


@dataclass(frozen=True)
class Phrase:
    """Documents with the words in sequence; ``slop`` is how far words may be from their place."""

    words: tuple[str, ...]
    slop: int = 0


@dataclass(frozen=True)
class AnyOf:
    clauses: tuple


@dataclass(frozen=True)
class AllOf:
    clauses: tuple


@dataclass(frozen=True)
class NoneOf:
    """Documents that match none of the clauses; scores 0, usually a member of :class:`AllOf`."""

    clauses: tuple


def any_of(*clauses) -> AnyOf:
    return AnyOf(tuple(clauses))


def all_of(*clauses) -> AllOf:
    return AllOf(tuple(clauses))


def none_of(*clauses) -> NoneOf:
    return NoneOf(tuple(clauses))


def phrase(words: str | list[str], slop: int = 0) -> Phrase:
    return Phrase(tuple(words.split() if isinstance(words, str) else words), slop)


_GROUPS = (AnyOf, AllOf, NoneOf)


def _leaves(clause) -> list:
    if isinstance(clause, _GROUPS):
        return [leaf for c in clause.clauses for leaf in _leaves(c)]
    return [clause]


def _or(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# -- words of a leaf -------------------------------------------------------------------------

def _swapped(word: str) -> set[str]:
    """The word with one pair of adjacent characters swapped, in all ways that change it."""
    return {word[:i] + word[i + 1] + word[i] + word[i + 2:] for i in range(len(word) - 1)} - {word}


def _edits(term: Column, leaf: Fuzzy) -> Column:
    """Edits between a vocabulary term and the word, or null beyond the limit.

    Lengths are compared before distances. With transpositions a term may also be reached from the
    word with some adjacent characters swapped, each swap being one edit.
    """
    starts = [{leaf.text}]
    while leaf.transpositions and len(starts) <= leaf.edits:
        starts.append({s for word in starts[-1] for s in _swapped(word)} - set().union(*starts))
    near = F.abs(F.length(term) - len(leaf.text)) <= leaf.edits
    ways = []
    for swaps, words in enumerate(starts):
        left = leaf.edits - swaps
        if swaps and not left:
            ways += [F.when(term.isin(sorted(words)), F.lit(swaps))] if words else []
            continue
        for word in sorted(words):
            distance = F.levenshtein(term, F.lit(word), left)
            ways.append(F.when(near & (distance >= 0), distance + swaps))
    return ways[0] if len(ways) == 1 else F.least(*ways)


def _hit(term: Column, leaf) -> Column:
    if isinstance(leaf, Word):
        return term == leaf.text
    if isinstance(leaf, Prefix):
        return term.startswith(leaf.text)
    if isinstance(leaf, Phrase):
        return term.isin(sorted(set(leaf.words)))
    return _edits(term, leaf).isNotNull()


def _named(leaves: list) -> list[str]:
    """The words that the leaves name."""
    return [w for leaf in leaves for w in ([leaf.text] if isinstance(leaf, Word) else leaf.words if isinstance(leaf, Phrase) else [])]


def _looked_up(index: TextIndex, field: str, leaves: list) -> DataFrame | None:
    """(term, df) of a stored vocabulary for the leaves that name no word, without the words that others name.

    A prefix reads a range of terms. Similar words are those whose head has a deletion in common with the word asked
    for, found by an equi-join and compared then; without stored deletions, or beyond their edits, all terms are compared.
    """
    term, stats, found = F.col("term"), index.term_stats.where(F.col("field") == field), None
    for leaf in leaves:
        if isinstance(leaf, Prefix):
            part = stats.where(index.begins_with(leaf.text))
        elif isinstance(leaf, Fuzzy) and index.similar is not None and leaf.edits <= SIMILAR_EDITS:
            variants = word_deletions(leaf.text)
            near = index.similar.where(
                (F.col("field") == field) & F.col("variant").isin(variants)
                & F.col("bucket").isin([term_bucket(F.lit(v), index.buckets) for v in variants])).select(head_of(term).alias("head")).distinct()
            head = F.col("head")
            # A short head is a whole word; the words with a long one lie in the ranges from it to its last continuation.
            near = near.where((F.length(head) == SIMILAR_HEAD) | _hit(head, leaf)).select("head", F.explode(F.sequence(
                range_bucket(head, index.bounds), range_bucket(F.concat(head, F.lit(chr(0x10FFFF))), index.bounds))).alias("bucket"))
            compared = stats.where(_hit(term, leaf)).withColumn("head", head_of(term))
            part = compared.join(F.broadcast(near) if has_at_most(near) else near, ["bucket", "head"], "left_semi")
        elif isinstance(leaf, Fuzzy):
            part = stats.where(_hit(term, leaf))
        else:
            continue
        part = part.select("term", "df")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return None
    names = sorted(set(_named(leaves)))
    return found.where(~term.isin(names)).distinct() if names else found.distinct()


def _stored_rows(index: TextIndex, field: str, leaves: list) -> tuple[DataFrame, DataFrame]:
    """Postings of the terms that the leaves need in a stored index, and (term, df) of those terms."""
    names, found = _named(leaves), _looked_up(index, field, leaves)
    postings, stats = index.postings.where(F.col("field") == field), index.term_stats.where(F.col("field") == field)
    if found is None:
        return postings.where(index.has_term(names)), stats.where(index.counts_term(names)).select("term", "df")
    # Joined by bucket and term: where few terms are found, dynamic pruning opens their buckets only.
    terms = found.select("term", term_bucket(F.col("term"), index.buckets).alias("bucket"))
    if has_at_most(terms):
        terms = F.broadcast(terms)
    rows = postings.join(terms, ["bucket", "term"], "left_semi").select(*postings.columns)
    if not names:
        return rows, found
    return (rows.unionByName(postings.where(index.has_term(names))),
            found.unionByName(stats.where(index.counts_term(names)).select("term", "df")))


def _rows_of(field: str, leaves: list) -> Column:
    """Condition on the postings of a computed index for the terms that the leaves need."""
    return (F.col("field") == field) & _or([_hit(F.col("term"), leaf) for leaf in leaves])


# -- phrases ---------------------------------------------------------------------------------


def _shifted(positions: Column, place: int) -> Column:
    """Positions of a word moved back by its place in the phrase."""
    return F.transform(positions, lambda x: x - place)


def _exact_frequency(positions: list[Column]) -> Column:
    """How often the exact sequence occurs: start positions shared by all words after shifting."""
    starts = [_shifted(p, k) for k, p in enumerate(positions)]
    return F.coalesce(F.size(reduce(F.array_intersect, starts)), F.lit(0)).cast("double")


def _sloppy_frequency(per_doc: DataFrame, words: list[str], columns: list[str], slop: int,
                      out: str) -> DataFrame:
    """Add ``out``: sum over minimal windows of 1 / (1 + spread), for windows no wider than the slop.

    Every occurrence is moved back by the place of its word in the phrase; a window is a stretch that
    holds a moved occurrence for each place. Going down a document, the nearest occurrence for a place
    is a running minimum, so the work is linear in the occurrences. Places of the same word must use
    different occurrences: each takes the first one after that of the place before, for which an
    occurrence carries the few that follow it.
    """
    repeats = {w: words.count(w) for w in words}

    def occurrences(place: int) -> Column:
        at, few = F.col(columns[place]), repeats[words[place]]
        return F.transform(at, lambda x, i: F.struct(
            (x - place).alias("at"), F.lit(place).alias("place"), F.slice(at, i + 1, few).alias("next")))

    at_or_after = (
        Window.partitionBy("doc_id").orderBy(F.desc("at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    nearest = [
        F.min(F.when(F.col("place") == k, F.struct("at", "next"))).over(at_or_after).alias(f"_p{k}")
        for k in range(len(words))
    ]
    found = (
        per_doc.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
        .select("doc_id", F.inline(F.concat(*[occurrences(k) for k in range(len(words))])))
        .select("doc_id", *nearest)
    )
    last: dict[str, str] = {}
    for k, word in enumerate(words):
        following = F.col(f"_p{k}.next")
        if word in last:
            taken = F.col(last[word])
            following = F.filter(following, lambda x: x > taken)  # noqa: B023 - used at once
        found = found.withColumn(f"_at{k}", F.get(following, 0))
        last[word] = f"_at{k}"
    places = F.array(*[F.col(f"_at{k}") - k for k in range(len(words))])
    windows = (
        found.where(reduce(lambda a, b: a & b, [F.col(f"_at{k}").isNotNull() for k in range(len(words))]))
        .select("doc_id", F.array_min(places).alias("begin"), F.array_max(places).alias("end"))
        .where(F.col("end") - F.col("begin") <= slop)
        # Of the windows with the same end only the narrowest counts.
        .groupBy("doc_id", "end").agg(F.max("begin").alias("begin"))
        .groupBy("doc_id").agg(F.sum(1 / (1.0 + F.col("end") - F.col("begin"))).alias(out))
    )
    return per_doc.join(windows, "doc_id", "left").withColumn(out, F.coalesce(out, F.lit(0.0)))


# -- clause tree -----------------------------------------------------------------------------


def _holds(clause, flags: dict) -> Column:
    if isinstance(clause, AnyOf):
        return _or([_holds(c, flags) for c in clause.clauses])
    if isinstance(clause, AllOf):
        return reduce(lambda a, b: a & b, [_holds(c, flags) for c in clause.clauses])
    if isinstance(clause, NoneOf):
        return ~_or([_holds(c, flags) for c in clause.clauses])
    return flags[clause]


def _score(clause, flags: dict, scores: dict) -> Column:
    if isinstance(clause, NoneOf):
        return F.lit(0.0)
    if isinstance(clause, _GROUPS):
        return reduce(lambda a, b: a + b, [
            F.when(_holds(c, flags), _score(c, flags, scores)).otherwise(F.lit(0.0))
            for c in clause.clauses
        ])
    return scores[clause]


def _holds_without_words(clause) -> bool:
    """Whether a document that has none of the clause's words matches."""
    if isinstance(clause, AnyOf):
        return any(_holds_without_words(c) for c in clause.clauses)
    if isinstance(clause, AllOf):
        return all(_holds_without_words(c) for c in clause.clauses)
    if isinstance(clause, NoneOf):
        return not any(_holds_without_words(c) for c in clause.clauses)
    return False


# -- searches --------------------------------------------------------------------------------


def search(index: TextIndex, field: str, clause) -> DataFrame:
    """(doc_id, score) of the documents that match a clause tree on one field.

    The score adds up the matching words (BM25), similar words (BM25 weakened by their edits) and
    phrases (BM25 of the phrase count); a prefix adds 1 and an excluded clause nothing.
    """
    leaves = list(dict.fromkeys(_leaves(clause)))
    if not leaves:
        raise ValueError("a search needs at least one clause")
    term = F.col("term")
    fuzzy = any(isinstance(leaf, Fuzzy) for leaf in leaves)
    scored = [leaf for leaf in leaves if not isinstance(leaf, Prefix)]
    one_pass = index.rows is not None and len(scored) == len(leaves)
    if index.buckets is not None:
        postings, vocabulary = _stored_rows(index, field, leaves)
    elif one_pass:
        needed = _rows_of(field, leaves)
        # Words, their frequencies and the field's statistics all come from these rows. No branch
        # filters them further, so the branches share one shuffle.
        postings = index.rows.where((F.col("field") == field) & (needed | (term == WHOLE)))
    else:
        postings = index.postings.where(_rows_of(field, leaves))
        vocabulary = index.term_stats.where(_rows_of(field, scored)).select("term", "df") if scored else None

    if scored:
        if one_pass:
            # Always true; it names the columns that the scores read, or the shuffles would differ.
            read = []
            if any(not isinstance(leaf, Phrase) for leaf in leaves):
                read.append(F.col("tf") > 0)
            if any(isinstance(leaf, Phrase) for leaf in leaves):
                read.append(F.size("positions") > 0)
            vocabulary = postings.groupBy("term").agg(
                F.count_if(reduce(lambda a, b: a & b, read)).alias("df"), F.sum("dl").alias("length"))
            whole = term == WHOLE
            documents, length = F.max(F.when(whole, F.col("df"))), F.max(F.when(whole, F.col("length")))
            n_docs = vocabulary.agg(documents.alias("n")).scalar()
            avg_dl = vocabulary.agg((length / documents).alias("avg")).scalar()
            vocabulary = vocabulary.drop("length")
        else:
            n_docs, avg_dl = index.statistics(field)
        for i, leaf in enumerate(leaves):
            if isinstance(leaf, Fuzzy):
                # Similar words are weighed by the frequency of the most frequent of them.
                most = vocabulary.agg(F.max(F.when(_hit(term, leaf), F.col("df"))).alias("most"))
                vocabulary = vocabulary.withColumn(f"_most{i}", most.scalar())
        if len(_named(leaves)) and len(_named(leaves)) == sum(len(leaf.words) if isinstance(leaf, Phrase) else 1 for leaf in leaves):
            vocabulary = F.broadcast(vocabulary)  # at most one row per named word
        postings = postings.join(vocabulary, "term", "left")
        weight = term_weight(F.col("tf"), F.col("dl"), avg_dl)

    sums: list[Column] = []
    phrase_words: dict[str, str] = {}
    for i, leaf in enumerate(leaves):
        if isinstance(leaf, Word):
            value = inverse_document_frequency(n_docs, F.col("df")) * weight
        elif isinstance(leaf, Fuzzy):
            shorter = F.least(F.length(term), F.lit(len(leaf.text)))
            closeness = F.greatest(F.lit(0.0), 1 - _edits(term, leaf) / shorter)
            value = closeness * inverse_document_frequency(n_docs, F.col(f"_most{i}")) * weight
        elif isinstance(leaf, Prefix):
            value = F.lit(1.0)
        else:
            for word in leaf.words:
                phrase_words.setdefault(word, f"_w{len(phrase_words)}")
            continue
        combine = F.max if isinstance(leaf, Prefix) else F.sum
        sums.append(combine(F.when(_hit(term, leaf), value)).alias(f"_s{i}"))
    for word, name in phrase_words.items():
        own = term == word
        sums.append(F.any_value(F.when(own, F.col("positions")), F.lit(True)).alias(f"{name}_at"))
        sums.append(F.max(F.when(own, F.col("df"))).alias(f"{name}_df"))
    if phrase_words:
        sums.append(F.max("dl").alias("dl"))

    per_doc = postings.groupBy("doc_id").agg(*sums)
    flags, scores = {}, {}
    for i, leaf in enumerate(leaves):
        if isinstance(leaf, Phrase):
            names = [phrase_words[w] for w in leaf.words]
            frequency = F.col(f"_f{i}")
            if leaf.slop:
                per_doc = _sloppy_frequency(
                    per_doc, list(leaf.words), [f"{n}_at" for n in names], leaf.slop, f"_f{i}")
            else:
                per_doc = per_doc.withColumn(f"_f{i}", _exact_frequency([F.col(f"{n}_at") for n in names]))
            idf = reduce(lambda a, b: a + b, [
                inverse_document_frequency(n_docs, F.col(f"{n}_df")) for n in names])
            flags[leaf] = F.coalesce(frequency > 0, F.lit(False))
            scores[leaf] = idf * term_weight(frequency, F.col("dl"), avg_dl)
        else:
            flags[leaf] = F.col(f"_s{i}").isNotNull()
            scores[leaf] = F.col(f"_s{i}")

    if _holds_without_words(clause) and not one_pass:
        every = index.lengths.where(F.col("field") == field).select("doc_id")
        per_doc = every.join(per_doc, "doc_id", "left")
    return per_doc.where(_holds(clause, flags)).select(
        "doc_id", F.round(_score(clause, flags, scores), SCORE_DIGITS).alias("score"))


def match(index: TextIndex, field: str, text: str, **rules) -> DataFrame:
    """(doc_id, score) of documents with any token of ``text``, by BM25; a repeated token counts again."""
    words = query_tokens(index.postings.sparkSession, text, **rules)
    if not words:
        nothing = index.lengths.where(F.lit(False))
        return nothing.select("doc_id", F.lit(0.0).alias("score"))
    return search(index, field, AnyOf(tuple(Word(w) for w in words)))


@dataclass(frozen=True)
class _Requests:
    """What a table of requests asks of an index: its words with their weight, and the postings of those words."""

    weights: DataFrame   # query_id, field, term, qtf, df and, without a common field, n_docs and avg_dl
    postings: DataFrame
    words: DataFrame     # field, term
    fields: Column
    n_docs: Column
    avg_dl: Column
    few: bool            # whether words and weights may be sent to all tasks

    def value(self, tf: Column, dl: Column) -> Column:
        idf = inverse_document_frequency(self.n_docs, F.col("df"))
        return F.col("qtf") * idf * term_weight(tf, dl, self.avg_dl)

    def weighed(self, rows: DataFrame) -> DataFrame:
        """Rows of a word joined to the requests that ask for it."""
        return rows.join(F.broadcast(self.weights) if self.few else self.weights, ["field", "term"])


def _prepared(index: TextIndex, field: str | None, queries: DataFrame, query_id: str, text: str, analyzer) -> _Requests:
    own_field = F.lit(field) if field is not None else F.col("field")
    exploded = queries.select(
        F.col(query_id).alias("query_id"), own_field.alias("field"),
        F.explode(analyzer(F.col(text))).alias("term"))
    few = has_at_most(exploded)
    word = ["field", "term"]
    wanted = exploded.groupBy("query_id", *word).agg(F.count(F.lit(1)).alias("qtf"))
    words = exploded.select(*word).distinct()
    sent = F.broadcast(words) if few else words
    fields = F.lit(True) if field is None else F.col("field") == field
    if index.buckets is None:
        postings = index.postings.where(fields).join(sent, word, "left_semi")
        frequency = index.term_stats.where(fields).join(sent, word, "left_semi").select(*word, "df")
    else:
        # Joined by bucket as well: where few words are asked for, dynamic pruning opens their buckets only.
        by_hash, by_range = term_bucket(F.col("term"), index.buckets), range_bucket(F.col("term"), index.bounds)
        placed = ["bucket", *word]
        postings = index.postings.where(fields).join(sent.withColumn("bucket", by_hash), placed, "left_semi")
        frequency = index.term_stats.where(fields).join(sent.withColumn("bucket", by_range), placed, "left_semi").select(*word, "df")
    weights = wanted.join(frequency, word)
    if field is None:
        # One row per indexed field.
        weights = weights.join(F.broadcast(index.field_stats), "field")
        n_docs, avg_dl = F.col("n_docs"), F.col("avg_dl")
    else:
        n_docs, avg_dl = index.statistics(field)
    return _Requests(weights, postings, sent, fields, n_docs, avg_dl, few)


def match_many(index: TextIndex, field: str | None, queries: DataFrame, query_id: str = "query_id",
               text: str = "query", analyzer=tokens) -> DataFrame:
    """(query_id, doc_id, score) for a table of requests; all of them share one pass over the postings.

    ``field`` is searched by all requests, or each names its own in a ``field`` column when it is None.
    The words of the requests are counted first. Up to a fixed size they are sent to all tasks, and
    postings placed by document are then scored where they are, and of a stored index only the buckets of those
    words are read. Beyond the size the postings are joined by
    word, and adaptive execution splits the hot ones.
    """
    asked = _prepared(index, field, queries, query_id, text, analyzer)
    return _scores(asked.weighed(_by_document(index, asked)).withColumn("value", asked.value(F.col("tf"), F.col("dl"))))


def _by_document(index: TextIndex, asked: _Requests) -> DataFrame:
    """Postings of the requests' words, those of a stored index moved to their document.

    Requests have words in common: their postings are fewer than the pairs of request and document, which then need no
    shuffle. Computed postings lie by document already.
    """
    return asked.postings.repartition(F.col("doc_id")) if asked.few and index.buckets is not None else asked.postings


def _scores(valued: DataFrame) -> DataFrame:
    return valued.groupBy("query_id", "doc_id").agg(F.round(F.sum("value"), SCORE_DIGITS).alias("score"))


# Blocks of all requests together that are sent to all tasks; beyond it a table of requests is ranked without them.
BLOCKS_SENT = 4_000_000
SEED_BLOCKS = 8  # scored first, and as many again as the page is long


def top_many(index: TextIndex, field: str, queries: DataFrame, size: int, query_id: str = "query_id", text: str = "query",
             analyzer=tokens) -> DataFrame:
    """The ``size`` best documents of every request with their ``rank``, exactly those of the full ranking.

    A stored index with blocks knows for every word and block of documents the greatest frequency and the least
    length, hence a bound of the score of any document of a block. The documents of the best few blocks of a request
    are scored first; the last score of their page is a threshold, and postings of blocks whose bound is below it are
    left out before documents are gathered.
    """
    asked = _prepared(index, field, queries, query_id, text, analyzer)
    valued = asked.weighed(_by_document(index, asked)).withColumn("value", asked.value(F.col("tf"), F.col("dl")))
    if index.blocks is None or not asked.few or queries.count() * LENGTH_CLASSES * index.spread > BLOCKS_SENT:
        return page_per_query(_scores(valued), size)
    kept = _blocks_within(index, asked, valued, size)
    return page_per_query(_scores(in_blocks(index, valued, kept)), size)


def in_blocks(index: TextIndex, valued: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of requests and documents that are in these blocks of the request."""
    placed = valued.withColumn("block", block_of(F.col("doc_id"), F.col("dl"), index.spread))
    return placed.join(F.broadcast(blocks), ["query_id", "block"], "left_semi")


def _blocks_within(index: TextIndex, asked: _Requests, valued: DataFrame, size: int) -> DataFrame:
    """(query_id, block): the blocks that may hold a document of the request's page."""
    by_hash = term_bucket(F.col("term"), index.buckets)
    rows = index.blocks.where(asked.fields).join(asked.words.withColumn("bucket", by_hash), ["bucket", "field", "term"], "left_semi")
    bound = asked.value(F.col("max_tf"), F.col("min_dl"))
    upper = asked.weighed(rows).groupBy("query_id", "block").agg(F.sum(bound).alias("bound"))
    best = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    seeds = upper.withColumn("at", F.row_number().over(best)).where(F.col("at") <= SEED_BLOCKS + size).select("query_id", "block")
    seeded = page_per_query(_scores(in_blocks(index, valued, seeds)), size)
    threshold = seeded.where(F.col("rank") == size).select("query_id", F.col("score").alias("least"))
    # Scores are rounded; a bound is taken a little higher.
    within = F.col("bound") + 2 * 10.0 ** -SCORE_DIGITS >= F.col("least")
    return upper.join(threshold, "query_id", "left").where(F.col("least").isNull() | within).select("query_id", "block")
