"""Field matches, geo search, suggestions, facets and display."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.display import gender_name, kilograms, map_markers
from ..functions.text import edge_ngrams, tokens
from ..functions.wire import to_serving
from ..operators.around import within_radius, within_radius_many
from ..operators.facets import facet_dates, facet_tokens, facet_values
from ..operators.fields import match_date, match_number
from ..operators.suggest import suggest, suggest_many, with_echo
from ..operators.textindex import TextIndex
from ..plans.indexing import StoredIndex
from ..plans.places import StoredPlaces
from ..session import scratch
from . import standins
from .registry import query, table
from .text import TOKENS

# -- number and date fields ------------------------------------------------------------------


@query("select p_partkey, p_size, 1.0::double as score from part where p_size = 11")
def match_exact(spark, folder):
    return match_number(table(spark, folder, "part"), "p_size", "11").select("p_partkey", "p_size", "score")


@query("""
select o_orderkey, cast(o_orderdate as date) as day, 1.0::double as score from orders
where o_orderdate >= date '1997-05-01' and o_orderdate < date '1997-06-01'""")
def match_date_period(spark, folder):
    hits = match_date(table(spark, folder, "orders"), "o_orderdate", "1997-05")
    return hits.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "score")


# -- geo -------------------------------------------------------------------------------------

DISTANCE = """2 * 6371.0087714 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2)
  + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


@query(f"""
select id, lat, lon, round(d, 6) as distance_km, 1.0::double as score from (
  select *, {DISTANCE.format(lat1='51.1', lon1='175.5', lat2='lat', lon2='lon')} as d
  from ({standins.PROFILE_SQL})) where d <= 2500""")
def geo_radius(spark, folder):
    people = standins.profiles(table(spark, folder, "customer"))
    hits = within_radius(people, 51.1, 175.5, 2500)
    return hits.select("id", "location.lat", "location.lon", F.round("distance_km", 6).alias("distance_km"), "score")


_CIRCLES_SQL = """
select s_suppkey as query_id, cast((s_suppkey * 29) % 181 - 90 as double) as q_lat,
       cast((s_suppkey * 53) % 361 - 180 as double) as q_lon,
       cast(20 + (s_suppkey * 97) % 3000 as double) as radius_km from supplier"""


@query(f"""
select id, lat, lon, round(d, 6) as distance_km, 1.0::double as score from (
  select *, {DISTANCE.format(lat1='51.1', lon1='175.5', lat2='lat', lon2='lon')} as d
  from ({standins.PROFILE_SQL})) where d <= 2500""")
def stored_geo_radius(spark, folder):
    people = to_serving(standins.profiles(table(spark, folder, "customer")))
    places = StoredPlaces(spark, scratch(spark, "places"))
    places.build(people)
    hits = places.near(51.1, 175.5, 2500)
    return hits.select("id", "location.lat", "location.lon", F.round("distance_km", 6).alias("distance_km"), "score")


def _circles(spark, folder):
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("query_id"),
        ((key * 29) % 181 - 90).cast("double").alias("lat"),
        ((key * 53) % 361 - 180).cast("double").alias("lon"),
        (20 + (key * 97) % 3000).cast("double").alias("radius_km"),
    )


@query(f"""
select query_id, id, round(d, 6) as distance_km from (
  select *, {DISTANCE.format(lat1='q_lat', lon1='q_lon', lat2='lat', lon2='lon')} as d
  from ({standins.PROFILE_SQL}), ({_CIRCLES_SQL})) where d <= radius_km""")
def geo_radius_batch(spark, folder):
    people = standins.profiles(table(spark, folder, "customer"))
    hits = within_radius_many(people, _circles(spark, folder))
    return hits.select("query_id", "id", F.round("distance_km", 6).alias("distance_km"))


@query(f"""
select query_id, id, round(d, 6) as distance_km from (
  select *, {DISTANCE.format(lat1='q_lat', lon1='q_lon', lat2='lat', lon2='lon')} as d
  from ({standins.PROFILE_SQL}), ({_CIRCLES_SQL})) where d <= radius_km""")
def stored_geo_radius_batch(spark, folder):
    people = to_serving(standins.profiles(table(spark, folder, "customer")))
    places = StoredPlaces(spark, scratch(spark, "places"))
    places.build(people)
    hits = places.near_many(_circles(spark, folder))
    return hits.select("query_id", "id", F.round("distance_km", 6).alias("distance_km"))


@query(f"""
select lon as lng, lat, '{{"id":' || id || ',"nickname":"' || nickname
         || '","location":{{"lon":' || lon || ',"lat":' || lat || '}}}}' as message, true as focus
from (select *, {DISTANCE.format(lat1='10', lon1='20', lat2='lat', lon2='lon')} as d
      from ({standins.PROFILE_SQL})) where d <= 3000""", name="map_markers")
def map_marker_rows(spark, folder):
    people = standins.profiles(table(spark, folder, "customer"))
    found = within_radius(people, 10, 20, 3000)
    return map_markers(found.select("id", "nickname", "location"))


@query(f"""
select id, nickname, case gender when 1 then 'female' when 2 then 'male' end as gender,
       weight / 1000 as weight from ({standins.PROFILE_SQL})""")
def display_projection(spark, folder):
    people = standins.profiles(table(spark, folder, "customer"))
    return people.select("id", "nickname", gender_name(F.col("gender")).alias("gender"),
                         kilograms(F.col("weight")).alias("weight"))


# -- suggestions -----------------------------------------------------------------------------

_GRAMS = f"""
toks as (select p_partkey as doc_id, p_name, {TOKENS.format('p_name')} as toks from part),
words as (select doc_id, len(toks) as dl, unnest(toks) as word from toks),
grams as (select doc_id, dl, substr(word, 1, n) as term from words,
          (select unnest(range(1, 21)) as n) where n <= length(word)),
p as (select doc_id, dl, term, count(*) as tf from grams group by all),
d as (select term, count(*) as df from p group by term),
s as (select (select count(*) from toks where len(toks) > 0) as n, count(*)
             / (select count(*) from toks where len(toks) > 0) as avgdl from grams)"""
_WEIGHT = "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))"
_SUGGESTED = f"""with {_GRAMS},
hits as (select doc_id, round(sum({_WEIGHT}), 6) as score from p join d using (term), s
         where term in ('re', 'wid') group by doc_id),
best as (select doc_id, row_number() over (order by score desc, doc_id) as rank from hits)"""


def _prefixes(spark, folder):
    part = table(spark, folder, "part")
    return TextIndex.over_prefixes(part, "p_partkey", {"name": F.col("p_name")}), part


@query(f"with {_GRAMS} select doc_id, term, cast(tf as integer) as tf from p")
def edge_ngram_index(spark, folder):
    index, _ = _prefixes(spark, folder)
    return index.postings.select("doc_id", "term", "tf")


@query(f"with {_GRAMS} select doc_id, term from grams", name="edge_ngrams")
def edge_ngram_rows(spark, folder):
    part = table(spark, folder, "part")
    words = part.select(F.col("p_partkey").alias("doc_id"), F.explode(tokens(F.col("p_name"))).alias("word"))
    return words.select("doc_id", F.explode(edge_ngrams(F.col("word"))).alias("term"))


_SUGGESTED_20 = _SUGGESTED + """
select cast(rank as integer) as rank, p_name as name from best join part on p_partkey = doc_id
where rank <= 20"""
_SUGGESTED_BATCH = f"""with {_GRAMS},
typed as (select min(p_partkey) as query_id, substr(p_name, 1, 4) as query from part group by 2),
hits as (select query_id, doc_id, round(sum({_WEIGHT}), 6) as score
         from (select query_id, unnest({TOKENS.format('query')}) as term from typed)
         join p using (term) join d using (term), s group by all),
best as (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from hits)
select query_id, cast(rank as integer) as rank, p_name as name from best join part on p_partkey = doc_id
where rank <= 20"""


def _typed(part):
    """The first four characters of every name, typed once each."""
    return part.groupBy(F.substring("p_name", 1, 4).alias("query")).agg(F.min("p_partkey").alias("query_id"))


@query(_SUGGESTED_20)
def autocomplete(spark, folder):
    index, part = _prefixes(spark, folder)
    return suggest(index, "name", "Re wid", part, "p_partkey", "p_name")


@query(_SUGGESTED + """
select cast(rank as integer) as rank, p_name as name from best join part on p_partkey = doc_id
where rank <= 20 union all select 0, 'Re wid'""")
def autocomplete_with_echo(spark, folder):
    index, part = _prefixes(spark, folder)
    return with_echo(suggest(index, "name", "Re wid", part, "p_partkey", "p_name"), "Re wid")


@query(_SUGGESTED_BATCH)
def autocomplete_batch(spark, folder):
    index, part = _prefixes(spark, folder)
    return suggest_many(index, "name", _typed(part), part, "p_partkey", "p_name")


def _stored_prefixes(spark, folder):
    """The prefixes of all names on disk: first names that are wrong or too many, then refreshed to what they are."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    stored = StoredIndex.of_prefixes(spark, scratch(spark, "prefixes"), "p_partkey", {"name": F.col("p_name")}, buckets=16)
    early = part.select("p_partkey", F.when(key % 4 == 1, F.concat(F.lit("red "), "p_name")).otherwise(F.col("p_name")).alias("p_name"))
    extra = part.where(key % 7 == 0).select((F.lit(-1) - key).alias("p_partkey"), F.lit("rewind wide").alias("p_name"))
    stored.build(early.where(key % 9 != 2).unionByName(extra))
    stored.refresh(part.where((key % 4 == 1) | (key % 9 == 2)).select("p_partkey", "p_name"), extra)
    return stored.open(), part


@query(_SUGGESTED_20)
def stored_autocomplete(spark, folder):
    """Suggestions from a stored table of prefixes that was refreshed after it was built."""
    index, part = _stored_prefixes(spark, folder)
    return suggest(index, "name", "Re wid", part, "p_partkey", "p_name")


@query(_SUGGESTED_BATCH)
def stored_autocomplete_batch(spark, folder):
    index, part = _stored_prefixes(spark, folder)
    return suggest_many(index, "name", _typed(part), part, "p_partkey", "p_name")


# -- facets ----------------------------------------------------------------------------------


@query("""
select c_mktsegment as key, count(*) as count from customer where c_mktsegment is not null
group by 1 order by 2 desc, 1 limit 10""")
def facet_value(spark, folder):
    return facet_values(table(spark, folder, "customer"), "c_mktsegment")


@query(f"""
select key, count(*) as count from (
  select distinct doc_id, unnest({TOKENS.format('text')}) as key from documents)
group by 1 order by 2 desc, 1 limit 10""")
def facet_token(spark, folder):
    return facet_tokens(table(spark, folder, "documents"), "text")


@query("""
select cast(epoch_ms(cast(cast(o_orderdate as date) as timestamp)) as bigint) as key, count(*) as count
from orders group by 1 order by 2 desc, 1 limit 10""")
def facet_date(spark, folder):
    return facet_dates(table(spark, folder, "orders"), "o_orderdate")
