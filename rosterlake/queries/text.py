"""Full-text queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators.requests import normalise
from ..operators.clauses import NODES, search_pages
from ..operators.facets import facet_terms
from ..operators.scoring import page, page_after, page_deep, page_per_query, total_hits
from ..operators.search import (
    Fuzzy, Prefix, Word, all_of, any_of, match, match_many, none_of, phrase, search, top_many,
)
from ..operators.textindex import EVERYTHING, TextIndex, combined
from ..plans.indexing import StoredIndex
from ..session import scratch
from .registry import query, table

FIELD = "text"


def _index(spark, folder, whole=False, **fields):
    """Index of the documents, computed on the fly.

    A search for a few words filters them before anything is shuffled. Where most words are needed
    (``whole``), documents are first placed by id: their text is smaller than their postings, and
    everything counted per document afterwards stays where it is.
    """
    docs = table(spark, folder, "documents")
    if whole:
        docs = docs.repartition(F.col("doc_id"))
    return TextIndex.over(docs, "doc_id", fields or {FIELD: F.col("text")})


# -- the same computation as SQL -------------------------------------------------------------

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def _tables(text: str = "text", source: str = "documents", key: str = "doc_id") -> str:
    """Common table expressions: words, postings p, document frequencies d, statistics s."""
    return f"""
toks as (select {key} as doc_id, {TOKENS.format(text)} as toks from {source}),
words as (select doc_id, len(toks) as dl, unnest(toks) as term, generate_subscripts(toks, 1) - 1 as pos
          from toks),
p as (select doc_id, dl, term, count(*) as tf from words group by all),
d as (select term, count(*) as df from p group by term),
s as (select count(*) as n, avg(len(toks)) as avgdl from toks where len(toks) > 0)"""


def _bm25(tf: str = "tf", df: str = "df", dl: str = "dl") -> str:
    return (f"ln(1 + (n - {df} + 0.5) / ({df} + 0.5)) * {tf} * 2.2"
            f" / ({tf} + 1.2 * (0.25 + 0.75 * {dl} / avgdl))")


def _words_sql(words: list[str]) -> str:
    values = ", ".join(f"('{w}')" for w in words)
    return f"q as (select * from (values {values}) v(term))"


def _matched(words: list[str], text: str = "text") -> str:
    return f"""with {_tables(text)}, {_words_sql(words)},
hits as (select doc_id, round(sum({_bm25()}), 6) as score
         from q join p using (term) join d using (term), s group by doc_id)"""


# -- analysis and index ----------------------------------------------------------------------


@query(f"with {_tables()} select doc_id, cast(pos as integer) as pos, term from words")
def tokenize(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "term"))


@query(f"""with {_tables()}
select doc_id, term, cast(dl as integer) as dl, cast(count(*) as integer) as tf,
       string_agg(cast(pos as varchar), ' ' order by pos) as positions
from words group by doc_id, term, dl""")
def build_postings(spark, folder):
    return _index(spark, folder, whole=True).postings.select(
        "doc_id", "term", "dl", "tf", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"))


@query(f"with {_tables()} select term, df from d")
def term_statistics(spark, folder):
    return _index(spark, folder, whole=True).term_stats.select("term", "df")


# -- ranked match ----------------------------------------------------------------------------

TEXT = "The of and the re"


@query(_matched(["the", "of", "and", "the", "re"]) + """
select doc_id, score from hits order by score desc, doc_id limit 100""")
def match_topk(spark, folder):
    return page(match(_index(spark, folder), FIELD, TEXT), 100)


@query(_matched(["the", "of", "and", "the", "re"]) + """
select h.doc_id, h.score, t.lang, t.source from hits h join documents t using (doc_id)
order by h.score desc, h.doc_id limit 100""")
def match_topk_rows(spark, folder):
    best = page(match(_index(spark, folder), FIELD, TEXT), 100)  # at most 100 rows to send around
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return docs.join(F.broadcast(best), "doc_id")


_BATCH_SQL = f"""with {_tables()},
q as (select item_id as query_id, unnest({TOKENS.format('text')}) as term from benchmark),
qt as (select query_id, term, count(*) as qtf from q group by all),
hits as (select query_id, doc_id, round(sum(qtf * {_bm25()}), 6) as score
         from qt join p using (term) join d using (term), s group by all)
select query_id, doc_id, score, cast(rank as integer) as rank from (
  select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from hits)
where rank <= 10"""


@query(_BATCH_SQL)
def match_topk_batch(spark, folder):
    requests = table(spark, folder, "benchmark")
    return page_per_query(match_many(_index(spark, folder, whole=True), FIELD, requests, "item_id", "text"), 10)


@query(_matched(["en", "src3", "the"], "concat_ws(' ', text, lang, source)") + """
select doc_id, score from hits order by score desc, doc_id limit 100""")
def match_all_fields(spark, folder):
    index = _index(spark, folder, **{EVERYTHING: combined(["text", "lang", "source"])})
    return page(match(index, EVERYTHING, "EN src3 the"), 100)


# -- structured clauses ----------------------------------------------------------------------


@query(_matched(["the", "of", "and"]) + """
select doc_id, score from hits where doc_id in (
  select doc_id from p where term in ('the', 'of', 'and') group by doc_id having count(*) = 3)
order by score desc, doc_id limit 100""")
def match_all_of(spark, folder):
    return page(search(_index(spark, folder), FIELD, all_of(Word("the"), Word("of"), Word("and"))), 100)


@query(_matched(["the", "of"]) + """
select doc_id, score from hits where doc_id not in (select doc_id from p where term in ('and', 'le'))""")
def match_none_of(spark, folder):
    return search(_index(spark, folder), FIELD,
                  all_of(any_of(Word("the"), Word("of")), none_of(Word("and"), Word("le"))))


@query(f"""with {_tables()}
select doc_id, 0.0::double as score from toks where len(toks) > 0
and doc_id not in (select doc_id from p where term in ('the', 'la'))""")
def match_only_none_of(spark, folder):
    return search(_index(spark, folder), FIELD, none_of(Word("the"), Word("la")))


def _phrase_idf(words: list[str]) -> str:
    return " + ".join(
        f"(select ln(1 + (n - df + 0.5) / (df + 0.5)) from d, s where term = '{w}')" for w in words)


_PHRASE_SQL = f"""with {_tables()},
f as (select a.doc_id, a.dl, cast(count(*) as double) as f from words a
      join words b on b.doc_id = a.doc_id and b.pos = a.pos + 1 and b.term = 'the'
      where a.term = 'of' group by all)
select doc_id, round(({_phrase_idf(['of', 'the'])}) * f * 2.2
       / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) as score from f, s"""


@query(_PHRASE_SQL)
def match_phrase(spark, folder):
    return search(_index(spark, folder), FIELD, phrase("of the"))


@query(f"""with {_tables()},
o as (select doc_id, dl, pos as beg, 0 as k from words where term = 'of'
      union all select doc_id, dl, pos - 1, 1 from words where term = 'the'
      union all select doc_id, dl, pos - 2, 2 from words where term = 'and'),
w as (select doc_id, dl, beg, greatest(
        min(case when k = 0 then beg end) over u, min(case when k = 1 then beg end) over u,
        min(case when k = 2 then beg end) over u) as until,
        count(case when k = 0 then 1 end) over u as n0, count(case when k = 1 then 1 end) over u as n1,
        count(case when k = 2 then 1 end) over u as n2
      from o window u as (partition by doc_id order by beg desc)),
m as (select doc_id, dl, until, max(beg) as beg from w
      where n0 > 0 and n1 > 0 and n2 > 0 and until - beg <= 2 group by all),
f as (select doc_id, dl, sum(1.0::double / (1 + until - beg)) as f from m group by all)
select doc_id, round(({_phrase_idf(['of', 'the', 'and'])}) * f * 2.2
       / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) as score from f, s""")
def match_phrase_slop(spark, folder):
    return search(_index(spark, folder), FIELD, phrase("of the and", slop=2))


_PREFIX_SQL = f"""with {_tables()}
select distinct doc_id, 1.0::double as score from p where term like 'thr%'"""


@query(_PREFIX_SQL)
def match_prefix(spark, folder):
    return search(_index(spark, folder), FIELD, Prefix("thr"))


_FUZZY_SQL = f"""with {_tables()},
c as (select term, df, levenshtein(regexp_replace(term, '[^a-z0-9]', '?', 'g'), 'there') as edits from d),
e as (select term, df, greatest(0, 1 - edits / least(length(term), 5)) as boost from c where edits <= 2),
x as (select max(df) as maxdf from e)
select doc_id, round(sum(boost * {_bm25(df='maxdf')}), 6) as score
from p join e using (term), s, x group by doc_id"""


@query(_FUZZY_SQL)
def match_fuzzy(spark, folder):
    return search(_index(spark, folder), FIELD, Fuzzy("there", 2))


@query(f"""with {_tables()},
t as (select doc_id, term, {_bm25()} as w from p join d using (term), s
      where term in ('the', 'of', 'and', 'le', 'la')),
g as (select doc_id, sum(case when term = 'the' then w end) as the_, sum(case when term = 'of' then w end) as of_,
             sum(case when term = 'and' then w end) as and_, sum(case when term = 'le' then w end) as le_,
             sum(case when term = 'la' then w end) as la_ from t group by doc_id)
select doc_id, round(
  case when the_ is not null and of_ is not null then the_ + of_ else 0 end
  + case when le_ is not null and and_ is null then le_ else 0 end, 6) as score
from g where (the_ is not null and of_ is not null and la_ is null)
          or (le_ is not null and and_ is null and la_ is null)""")
def match_nested_bool(spark, folder):
    clause = all_of(
        any_of(all_of(Word("the"), Word("of")), all_of(Word("le"), none_of(Word("and")))),
        none_of(Word("la")),
    )
    return search(_index(spark, folder), FIELD, clause)


# -- pages and requests ----------------------------------------------------------------------


@query(_matched(["the", "of"]) + """
select doc_id, score from hits order by score desc, doc_id limit 50 offset 100""")
def search_page(spark, folder):
    return page(match(_index(spark, folder), FIELD, "the of"), 50, 100)


@query(_matched(["the", "of"]) + """
select doc_id, score from hits where score < 0.5 or (score = 0.5 and doc_id > 10)
order by score desc, doc_id limit 50""")
def search_page_after(spark, folder):
    return page_after(match(_index(spark, folder), FIELD, "the of"), 0.5, 10, 50)


@query(_matched(["the", "of"]) + " select count(*) as total from hits")
def search_total_hits(spark, folder):
    return total_hits(match(_index(spark, folder), FIELD, "the of"))


@query("""
select c_custkey as query_id,
       case when c_custkey % 4 = 0 then 'everything' else 'city' end as field,
       case when c_custkey % 5 = 0 then '' else lower(c_mktsegment) end as query,
       case when c_custkey % 3 = 0 then cast(c_custkey % 100 as double) end as distance_km,
       case when c_custkey % 3 = 0 and c_custkey % 6 <> 0 then 1.5::double end as lat,
       case when c_custkey % 3 = 0 and c_custkey % 9 <> 0 then -2.5::double end as lon,
       cast(case when c_custkey % 7 = 0 then 100 else c_custkey % 50 end as integer) as size,
       cast(case when c_custkey % 8 = 0 then 0 when c_custkey % 8 = 1 then -5 else c_custkey % 20 end as integer) as skip,
       case when reason is null then
         case when c_custkey % 3 = 0 then 'geo' when c_custkey % 2 = 0 then 'clauses' else 'match' end end as mode,
       reason
from (select *, case when c_custkey % 5 = 0 and c_custkey % 3 <> 0 then 'query_and_distance_empty'
                     when c_custkey % 9 = 0 then 'bad_lon' when c_custkey % 6 = 0 then 'bad_lat'
                     when c_custkey % 8 = 1 then 'negative_page' end as reason from customer)
""")
def search_request_defaults(spark, folder):
    key = F.col("c_custkey")
    requests = table(spark, folder, "customer").select(
        key.alias("query_id"),
        F.when(key % 4 == 0, F.lit("")).otherwise(F.lit("city")).alias("field"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("query"),
        F.when(key % 3 == 0, (key % 100).cast("string")).alias("distance"),
        F.when(key % 6 == 0, F.lit("")).otherwise(F.lit("1.5")).alias("lat"),
        F.when(key % 9 == 0, F.lit("x")).otherwise(F.lit("-2.5")).alias("lon"),
        F.when(key % 7 == 0, F.lit("5.0")).otherwise((key % 50).cast("string")).alias("l"),
        F.when(key % 8 == 0, F.lit(None).cast("string")).when(key % 8 == 1, F.lit("-5"))
        .otherwise((key % 20).cast("string")).alias("s"),
        F.when(key % 2 == 0, F.lit("true")).otherwise(F.lit("")).alias("w"),
    )
    return normalise(requests)


# -- stored index ----------------------------------------------------------------------------


@query(_matched(["the", "of", "and", "the", "re"]) + """
select doc_id, score from hits order by score desc, doc_id limit 100""")
def stored_match_topk(spark, folder):
    stored = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16)
    stored.build(table(spark, folder, "documents"))
    return page(match(stored.open(), FIELD, TEXT), 100)


@query(_BATCH_SQL)
def stored_match_batch(spark, folder):
    """The table of requests against an index on disk."""
    stored = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16)
    stored.build(table(spark, folder, "documents"))
    return page_per_query(match_many(stored.open(), FIELD, table(spark, folder, "benchmark"), "item_id", "text"), 10)


@query(_BATCH_SQL)
def stored_match_batch_bounded(spark, folder):
    """The same with blocks of documents left out that cannot be on a page."""
    index = _stored(spark, folder, blocks=16)
    return top_many(index, FIELD, table(spark, folder, "benchmark"), 10, "item_id", "text")


@query(f"""with {_tables()}
select term as key, df as count from d order by df desc, term limit 10""")
def stored_facet_token(spark, folder):
    """The most frequent words, from the term statistics of an index on disk."""
    stored = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16)
    stored.build(table(spark, folder, "documents"))
    return facet_terms(stored.open().term_stats, 10)


def _stored(spark, folder, **options):
    index = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16, **options)
    index.build(table(spark, folder, "documents"))
    return index.open()


@query(_PREFIX_SQL)
def stored_match_prefix(spark, folder):
    """A prefix against an index on disk: a range of its terms, then their buckets."""
    return search(_stored(spark, folder), FIELD, Prefix("thr"))


@query(_FUZZY_SQL)
def stored_match_fuzzy(spark, folder):
    """Similar words from the deletions that an index on disk keeps."""
    return search(_stored(spark, folder, similar=True), FIELD, Fuzzy("there", 2))


@query(_PHRASE_SQL)
def stored_match_phrase(spark, folder):
    return search(_stored(spark, folder), FIELD, phrase("of the"))


@query(f"""with mixed as (
  select doc_id, case when doc_id % 3 = 0 then source || ' ' || text else text end as body
  from documents where doc_id % 5 <> 1),
{_tables('body', 'mixed')}, {_words_sql(['the', 'of', 'src3'])}
select doc_id, round(sum({_bm25()}), 6) as score
from q join p using (term) join d using (term), s group by doc_id""")
def index_refresh(spark, folder):
    """Index everything, then change every third document and remove every fifth."""
    docs = table(spark, folder, "documents")
    key = F.col("doc_id")
    stored = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16)
    stored.build(docs)
    changed = docs.where((key % 3 == 0) & (key % 5 != 1)).withColumn("text", F.concat_ws(" ", "source", "text"))
    stored.refresh(changed, docs.where(key % 5 == 1))
    return match(stored.open(), FIELD, "the of src3")


@query(f"""with mixed as (
  select doc_id, case when doc_id % 4 = 0 then source || ' ' || text when doc_id % 4 = 2 then lang || ' the ' || text
                 else text end as body
  from documents where doc_id % 5 <> 1),
{_tables('body', 'mixed')}, {_words_sql(['the', 'of', 'src3', 'en'])}
select doc_id, round(sum({_bm25()}), 6) as score
from q join p using (term) join d using (term), s group by doc_id""")
def index_refresh_incremental(spark, folder):
    """A third of the documents indexed, the others and all later texts in several refreshes, some merged on the way."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    key = F.col("doc_id")
    stored = StoredIndex(spark, scratch(spark, "index"), "doc_id", {FIELD: F.col("text")}, buckets=16, merge_after=2)
    stored.build(docs.where(key % 3 == 0))
    stored.refresh(docs.where(key % 3 == 1))
    stored.refresh(docs.where(key % 3 == 2).withColumn("text", F.concat_ws(" ", F.lit("draft the"), "text")))
    stored.refresh(docs.where((key % 3 == 2) & (key % 4 != 0)), docs.where(key % 5 == 1))
    stored.refresh(docs.where((key % 4 == 0) & (key % 5 != 1)).withColumn("text", F.concat_ws(" ", "source", "text")))
    stored.refresh(docs.where((key % 4 == 2) & (key % 5 != 1)).withColumn("text", F.concat_ws(" ", "lang", F.lit("the"), "text")),
                   docs.where(key % 5 == 1))
    return match(stored.open(), FIELD, "the of src3 en")


_CLAUSE_REQUESTS = """select s_suppkey as query_id, s_suppkey % 4 as kind,
  case s_suppkey % 3 when 0 then 'the' when 1 then 'of' else 'le' end as a,
  case s_suppkey % 5 when 0 then 'and' when 1 then 'la' when 2 then 're' when 3 then 'the' else 'er' end as b,
  case s_suppkey % 7 when 0 then 'der' when 1 then 'en' when 2 then 'th' else 'ing' end as c from supplier"""


@query(f"""with {_tables()}, req as ({_CLAUSE_REQUESTS}),
bm as (select doc_id, term, df, {_bm25()} as w from p join d using (term), s
       where term in (select a from req union select b from req)),
bad as (select distinct term, doc_id from p where term in (select c from req)),
ph as (select query_id, x.doc_id, x.dl, count(*) as f from req
       join words x on x.term = a join words y on y.term = b and y.doc_id = x.doc_id and y.pos = x.pos + 1
       where kind = 2 group by all),
hits as (
  select query_id, x.doc_id, x.w + y.w as score from req join bm x on x.term = a
    join bm y on y.term = b and y.doc_id = x.doc_id where kind = 0
  union all
  select query_id, bm.doc_id, sum(w * (cast(term = a as integer) + cast(term = b as integer))) from req join bm on bm.term = a or bm.term = b
    where kind = 1 and not exists (select 1 from bad where bad.term = c and bad.doc_id = bm.doc_id) group by all
  union all
  select query_id, doc_id, (ia.i + ib.i) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)) from ph join req using (query_id)
    join (select term, ln(1 + (n - df + 0.5) / (df + 0.5)) as i from d, s) ia on ia.term = a
    join (select term, ln(1 + (n - df + 0.5) / (df + 0.5)) as i from d, s) ib on ib.term = b, s
  union all
  select distinct query_id, p.doc_id, 1.0::double from req join p on starts_with(p.term, b)
    where kind = 3 and not exists (select 1 from bad where bad.term = c and bad.doc_id = p.doc_id)),
rounded as (select query_id, doc_id, round(score, 6) as score from hits)
select query_id, doc_id, score, cast(rank as integer) as rank from (
  select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from rounded) where rank <= 10""")
def search_requests_clauses(spark, folder):
    """A table of requests that each bring a clause tree: all of, none of, a phrase, a prefix."""
    table(spark, folder, "supplier").createOrReplaceTempView("_suppliers")
    asked = spark.sql(_CLAUSE_REQUESTS.replace("from supplier", "from _suppliers"))

    def node(i, parent, kind, text=None):
        return F.struct(F.lit(i).alias("id"), F.lit(parent).alias("parent"), F.lit(kind).alias("kind"),
                        (F.lit(None).cast("string") if text is None else F.col(text)).alias("text"))

    both = F.array(node(0, -1, "all"), node(1, 0, "word", "a"), node(2, 0, "word", "b"))
    either = F.array(node(0, -1, "all"), node(1, 0, "any"), node(2, 1, "word", "a"), node(3, 1, "word", "b"),
                     node(4, 0, "none"), node(5, 4, "word", "c"))
    sequence = F.array(node(0, -1, "phrase", "ab"))
    begins = F.array(node(0, -1, "all"), node(1, 0, "prefix", "b"), node(2, 0, "none"), node(3, 2, "word", "c"))
    kind = F.col("kind")
    requests = asked.withColumn("ab", F.concat_ws(" ", "a", "b")).select("query_id", F.when(kind == 0, both).when(
        kind == 1, either).when(kind == 2, sequence).otherwise(begins).cast(NODES).alias("clause"))
    return search_pages(_index(spark, folder, whole=True), FIELD, requests, 10)


@query(_matched(["the", "of", "and", "the", "re"]) + """
select doc_id, score from hits order by score desc, doc_id limit 60 offset 300""")
def search_page_deep(spark, folder):
    """A page far down the ranking, whose beginning is found by counting."""
    return page_deep(match(_index(spark, folder), FIELD, TEXT), 60, 300, at_most=20, buckets=16)
