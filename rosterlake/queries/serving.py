"""The whole path: profiles upserted, indexed, and searched like the search page does."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.wire import to_serving
from ..operators.textindex import TextIndex
from ..plans.indexing import StoredIndex
from ..plans.profiles import ProfileTable
from ..plans.service import ProfileSearch, text_fields
from ..session import scratch
from . import standins
from .lookup import DISTANCE
from .registry import query, table
from .text import TOKENS


@query(f"""
with profiles as ({standins.PROFILE_SQL}),
toks as (select id, {TOKENS.format('city')} as toks from profiles),
p as (select id, len(toks) as dl, term, count(*) as tf
      from (select id, toks, unnest(toks) as term from toks) group by all),
d as (select term, count(*) as df from p group by term),
s as (select count(*) as n, avg(len(toks)) as avgdl from toks where len(toks) > 0),
hits as (select id, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                          / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) as score
         from p join d using (term), s where term = 'machinery')
select id, nickname, city, cast(nullif(dob, '0000-00-00') as date) as dob, score
from hits join profiles using (id) order by score desc, id limit 50 offset 50""")
def profile_search_page(spark, folder):
    work = scratch(spark, "search")
    people = standins.profiles(table(spark, folder, "customer"))
    store = ProfileTable(spark, f"{work}/profiles", buckets=8)
    store.upsert(people.select(
        "*", F.lit(None).cast("timestamp").alias("_ts"), F.lit(0).alias("_partition"),
        F.col("id").alias("_offset")))
    store.compact()
    index = StoredIndex(spark, f"{work}/index", "id", text_fields(), buckets=8)
    index.build(store.read())
    searching = ProfileSearch(store.with_buckets(), index.open(), buckets=8)
    rows, _ = searching.users(size=50, skip=50, field="city", query="Machinery")
    return rows.select("id", "nickname", "city", "dob", "score")


@query(f"""
with words as (
  select distinct id, unnest({TOKENS.format("concat_ws(' ', email, nickname, city, caption)")}) as term
  from ({standins.PROFILE_SQL}))
select term, count(*) as df from words group by 1""")
def profile_vocabulary(spark, folder):
    people = standins.profiles(table(spark, folder, "customer"))
    text = F.concat_ws(" ", "email", "nickname", "city", "caption")
    index = TextIndex.over(people, "id", {"all": text})
    return index.term_stats.select("term", "df")


_REQUESTS = """
select s_suppkey as query_id, s_suppkey % 4 as kind, s_suppkey % 3 as skip,
       case s_suppkey % 3 when 0 then 'machinery' when 1 then 'building furniture' else 'zzz' end as words,
       150 + s_suppkey % 50 as height, cast(1950 + s_suppkey % 40 as varchar) as year,
       cast((s_suppkey * 29) % 181 - 90 as double) as lat0, cast((s_suppkey * 53) % 361 - 180 as double) as lon0,
       cast(200 + (s_suppkey * 97) % 1500 as double) as km
from supplier"""


@query(f"""
with profiles as ({standins.PROFILE_SQL}), requests as ({_REQUESTS}),
toks as (select id, {TOKENS.format('city')} as toks from profiles),
p as (select id, len(toks) as dl, term, count(*) as tf
      from (select id, toks, unnest(toks) as term from toks) group by all),
d as (select term, count(*) as df from p group by term),
s as (select count(*) as n, avg(len(toks)) as avgdl from toks where len(toks) > 0),
hits as (
  select query_id, skip, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                                 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) as score
  from (select query_id, skip, unnest(string_split(words, ' ')) as term from requests where kind = 0)
  join p using (term) join d using (term), s group by all
  union all select query_id, skip, id, 1.0 from requests join profiles using (height) where kind = 1
  union all select query_id, skip, id, 1.0 from requests join profiles on year = dob[1:4]
    where kind = 2 and dob <> '0000-00-00'
  union all select query_id, skip, id, 1.0 from requests, profiles
    where kind = 3 and {DISTANCE.format(lat1='lat0', lon1='lon0', lat2='lat', lon2='lon')} <= km)
select query_id, cast(rank as integer) as rank, id, score from (
  select *, row_number() over (partition by query_id order by score desc, id) as rank from hits)
where rank > skip and rank <= skip + 5""")
def search_requests_batch(spark, folder):
    """A table of text, number, date and distance requests, each with its own page."""
    people = to_serving(standins.profiles(table(spark, folder, "customer")))
    key = F.col("s_suppkey")
    kind = key % 4

    def given(which, value):
        return F.when(kind == which, value).otherwise(F.lit(""))

    words = F.when(key % 3 == 0, F.lit("Machinery")).when(key % 3 == 1, F.lit("BUILDING furniture")).otherwise(F.lit("zzz"))
    requests = table(spark, folder, "supplier").select(
        key.alias("query_id"),
        F.when(kind == 0, F.lit("city")).when(kind == 1, F.lit("height")).otherwise(F.lit("dob")).alias("field"),
        F.when(kind == 0, words).when(kind == 1, (150 + key % 50).cast("string"))
        .otherwise((1950 + key % 40).cast("string")).alias("query"),
        given(3, (200 + (key * 97) % 1500).cast("string")).alias("distance"),
        given(3, ((key * 29) % 181 - 90).cast("string")).alias("lat"),
        given(3, ((key * 53) % 361 - 180).cast("string")).alias("lon"),
        F.lit("5").alias("l"), (key % 3).cast("string").alias("s"), F.lit("").alias("w"),
    )
    pages, _ = ProfileSearch(people, TextIndex.over(people, "id", text_fields())).answer_many(requests)
    return pages
