"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.queries import registry
from rosterlake.queries.registry import Entry, Runner

from . import (html_blocks, jaccard_join, language_gru, learning, lm_trie, merkle_manifest, mixing, pieces, pii_context,
               quality_model, quality_rules, token_alignment, toxic_spans, voronoi_knn)
from .common import fold
from .shipping import ship_package

CATALOGUE: dict[str, Entry] = {}


def query(sql: str | None = None):
    def register(run: Runner) -> Runner:
        CATALOGUE[run.__name__] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return registry.table(spark, sf_dir, name)


def runners() -> dict[str, Runner]:
    return {name: entry.run for name, entry in CATALOGUE.items()}


def oracles() -> dict[str, str]:
    return {name: entry.sql for name, entry in CATALOGUE.items() if entry.sql}


@query("""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
  from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighed as (
  select source, source_size, 3 * source_size as cap, sum(source_size) over () as total,
    [5, 2, 1][1 + (row_number() over (order by encode(source) nulls last) - 1) % 3] as weight
  from totals),
levels as (
  select *, total - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0) as rest_weight
  from weighed window w as (order by cast(cap as double) / weight, encode(source) nulls last)),
filled as (select *, weight * rest >= cap * rest_weight as is_full from levels),
shared as (
  select *, max(case when not is_full then rest_weight end) over () as share_weight,
    max(case when not is_full then rest end) over () as share_rest
  from filled),
targets as (
  select source, source_size,
    case when is_full then cast(cap as double)
         else cast(cast(weight * share_rest as bigint) as double) / cast(share_weight as double) end as target
  from shared),
rated as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0 end as rate,
    cast(('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) / 4503599627370496.0 as u
  from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size, target,
  cast(size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from rated
""")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carried=F.col("doc_id"))
    return mixed.select(F.col("row").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), carried=F.lit(None).cast("boolean")).drop("row")


def tokenizer(name: str) -> str:
    """File of a public tokenizer; its place is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return tokenizer("piece_bpe_32k.model")


@query()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    encoded = pieces.encode(table(spark, sf_dir, "documents"), piece_model())
    decoded = pieces.decode(encoded, piece_model())
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), pieces.digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), pieces.digest(F.col("ends")).alias("ends_sha256"))


@query()
def op10_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = html_blocks.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _learned(name: str, modulus: int, held: int):
    """Condition that an id is not held out."""
    return fold(F.col(name), modulus) != held


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels, learn = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _learned("doc_id", 5, 0)
    settings = quality_model.Settings()
    sample = learning.labelled_sample(docs, labels, "quality", learn, settings.per_label, settings.longest)
    model = quality_model.fit(sample, learning.label_counts(labels, "quality", learn), settings)
    return quality_model.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, and how many tokens offend."""
    docs, labels, learn = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _learned("doc_id", 5, 0)
    settings = toxic_spans.Settings()
    sample = learning.labelled_sample(docs, labels, "toxic", learn, settings.per_label, settings.longest)
    model = toxic_spans.fit(sample, learning.label_counts(labels, "toxic", learn), settings)
    return toxic_spans.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat(s["begin"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
        .alias("spans"))


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    sample = language_gru.training_windows(docs, _learned("doc_id", 4, 2))
    predicted = language_gru.predict(docs, language_gru.fit(sample))
    return predicted.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
""")
def op3_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest products of every query vector."""
    return voronoi_knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("""
with recursive split as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select r, doc_id, case when len(w) >= 5
      then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
      when len(w) > 0 then [array_to_string(w, ' ')] else cast([] as varchar[]) end as s
  from split),
shingles as (select r, len(s) as n, unnest(s) as g from sets),
links as (
  select a.r as x, b.r as y from shingles a join shingles b on a.g = b.g and a.r <> b.r
  group by a.r, b.r, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(x, y) as (select r, r from sets union select reach.x, links.y from reach join links on reach.y = links.x)
select sets.doc_id, cast(len(sets.s) as bigint) as n_shingles, min(other.doc_id) as component_id
from sets join reach on reach.x = sets.r join sets other on other.r = reach.y
group by sets.r, sets.doc_id, sets.s
""")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    groups = jaccard_join.similar_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


@query()
def op6_pii_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = pii_context.attach(docs, pii_context.find(docs), F.col("doc_id"))

    def count(place: int) -> Column:
        return F.size(F.filter("base", lambda s: s["place"] == place)).cast("long")

    return rows.select(
        F.col("row").alias("doc_id"), *[count(i + 1).alias(f"n_{k}") for i, k in enumerate(pii_context.KINDS)],
        F.sha2(pii_context.shown(F.col("base")), 256).alias("base_sha256"), pii_context.shown(F.col("all")).alias("spans"))


@query("""
with recursive written as (
  select row_number() over () as r, doc_id, lang,
    [cast(doc_id as varchar), source, lang, cast(n_chars as varchar), text] as own,
    [cast(doc_id as varchar), source, lang, cast(n_chars + 1 as varchar), text] as altered,
    xor(list_reduce(list_prepend(4294967295, [cast(ascii(c) as bigint) for c in string_split(cast(doc_id as varchar), '')]),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::bigint for i in range(8)]),
        lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 7 = 0 as tampered
  from documents),
leaves as (
  select r, doc_id, lang, tampered,
    sha256(array_to_string([coalesce(cast(octet_length(encode(v)) as varchar) || ':' || v, '-') for v in own], '')) as leaf,
    sha256(array_to_string([coalesce(cast(octet_length(encode(v)) as varchar) || ':' || v, '-') for v in altered], '')) as other
  from written),
placed as (
  select *, row_number() over (partition by lang order by doc_id, leaf) - 1 as place, count(*) over (partition by lang) as n
  from leaves),
nodes(lang, lvl, place, n, h) as (
  select lang, 0, place, n, leaf from placed
  union all
  select lang, lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place))
  from nodes where n > 1 group by lang, lvl, place // 2, n),
subroots as (
  select lang, h, row_number() over (order by encode(lang) nulls first) - 1 as place, count(*) over () as n from nodes where n = 1),
tops(lvl, place, n, h) as (
  select 0, place, n, h from subroots
  union all
  select lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place)) from tops where n > 1 group by lvl, place // 2, n),
inner_steps as (
  select p.r, x.lvl, case when s.h is null then '-' when s.place < (p.place >> x.lvl) then 'L' || s.h else 'R' || s.h end as step
  from placed p join (select distinct lang, lvl from nodes where n > 1) x on p.lang is not distinct from x.lang
  left join nodes s on s.lang is not distinct from p.lang and s.lvl = x.lvl and s.place = xor(p.place >> x.lvl, 1)),
outer_steps as (
  select p.r, 1000 + x.lvl as lvl,
    case when s.h is null then '-' when s.place < (t.place >> x.lvl) then 'L' || s.h else 'R' || s.h end as step
  from placed p join subroots t on t.lang is not distinct from p.lang
  join (select distinct lvl from tops where n > 1) x on true
  left join tops s on s.lvl = x.lvl and s.place = xor(t.place >> x.lvl, 1)),
paths as (
  select r, list(step order by lvl) as steps from (select * from inner_steps union all select * from outer_steps) group by r),
folded as (
  select p.*, t.h as subroot, (select h from tops where n = 1) as root, coalesce(s.steps, cast([] as varchar[])) as steps
  from placed p join subroots t on t.lang is not distinct from p.lang left join paths s on s.r = p.r),
done as (
  select doc_id, leaf, subroot, root,
    sha256(array_to_string([case when s = '-' then '' else s[2:] end for s in steps], '')) as proof_sha256,
    list_reduce(list_prepend(case when tampered then other else leaf end, steps), lambda h, s:
      sha256(case s[1] when 'L' then s[2:] || h when 'R' then h || s[2:] else h end)) as folded_root
  from folded)
select *, folded_root = root as verified from done
""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest tree of all documents, every document's proof, and where a tampered one shows."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), tampered).drop("proof")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizations of every document aligned, and how often the corpus links their ids."""
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), piece_model())
    kept = aligned.select(
        "doc_id", "n_a", "n_b", F.size("cuts").cast("long").alias("n_groups"), "n_links",
        F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"), "pairs", "times")
    return token_alignment.with_counts(kept, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])


@query()
def op13_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, the model being learned from nine tenths of them."""
    scored = lm_trie.score(table(spark, sf_dir, "documents"), _learned("doc_id", 10, 0), lm_trie.Settings(each_rare=True))
    return scored.select("doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), *scored.columns[1:])
