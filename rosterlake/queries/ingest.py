"""Readers, codecs and the upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.wire import decode_messages, encode, parse_required, to_serving
from ..operators.latest import latest_by_key
from ..plans.feed import run_feed
from ..session import scratch
from ..sources import arrays, database, delimited, messages
from ..sources.rejects import rejects_by_reason, split_rejects
from . import standins
from .registry import query, table


def _delimited_rows(spark, folder):
    path = scratch(spark, "lines")
    standins.delimited_lines(table(spark, folder, "customer")).write.text(path)
    return delimited.type_rows(delimited.scan(spark, path))


@query(standins.TYPED_SQL)
def csv_typed_scan(spark, folder):
    good, _ = split_rejects(_delimited_rows(spark, folder))
    return good.select(
        "id", "email", "dob", "weight", "height", "nickname", "country", "city", "caption",
        F.col("location.lon").alias("lon"), F.col("location.lat").alias("lat"), "gender", "suspect_location")


@query(f"""
select reason, count(*) as rejects from (select {standins.LINE_REASON_SQL} as reason from customer)
where reason is not null group by reason
""")
def csv_rejects_by_reason(spark, folder):
    return rejects_by_reason(_delimited_rows(spark, folder))


@query(f"select id, lon, lat from ({standins.TYPED_SQL}) where suspect_location")
def zero_coord_warning(spark, folder):
    good, _ = split_rejects(_delimited_rows(spark, folder))
    return good.where("suspect_location").select("id", "location.lon", "location.lat")


_DATABASE_SQL = """
with rows as (
  select o_orderkey,
         case when o_orderkey % 11 = 3 then null else o_orderkey end as pnum,
         case when o_orderkey % 7 = 1 then null else cast(o_custkey % 40 as integer) end as country,
         case when o_orderkey % 13 = 5 then null else cast(o_custkey % 360 - 180 as double) end as lon,
         cast(o_custkey % 180 - 90 as double) as lat, o_orderstatus as nickname
  from orders {limit})
select pnum as id, country, nickname, lon, lat from rows
where pnum is not null and country is not null and lon is not null
"""


def _database_rows(spark, folder):
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 11 != 3, key).alias("pnum"),
        F.lit(None).cast("string").alias("dob"),
        F.lit(None).cast("int").alias("weight"), F.lit(None).cast("int").alias("height"),
        F.col("o_orderstatus").alias("nickname"),
        F.when(key % 7 != 1, (customer % 40).cast("int")).alias("country"),
        F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("caption"),
        F.when(key % 13 != 5, (customer % 360 - 180).cast("double")).alias("longitude"),
        (customer % 180 - 90).cast("double").alias("latitude"),
        F.lit(None).cast("int").alias("gender"),
    )
    return rows


def _database_profiles(rows):
    good, _ = split_rejects(database.type_rows(rows))
    return good.select("id", "country", "nickname", "location.lon", "location.lat")


@query(_DATABASE_SQL.format(limit=""))
def db_row_gate(spark, folder):
    return _database_profiles(database.first_rows(_database_rows(spark, folder)))


@query(_DATABASE_SQL.format(limit="order by pnum nulls last limit 500"))
def db_row_cap(spark, folder):
    """The first 500 rows by key; rows without a key come last."""
    return _database_profiles(database.first_rows(_database_rows(spark, folder), 500))


@query(f"""
select id, '{{' || concat_ws(',',
    case when id <> 0 then '"id":' || id end,
    '"email":"' || email || '"', '"dob":"' || dob || '"', '"weight":' || weight, '"height":' || height,
    '"nickname":"' || nickname || '"',
    case when country <> 0 then '"country":' || country end,
    '"city":"' || city || '"', '"caption":"' || caption || '"',
    '"location":{{' || concat_ws(',', case when lon <> 0 then '"lon":' || lon end,
                                      case when lat <> 0 then '"lat":' || lat end) || '}}',
    '"gender":' || gender) || '}}' as value
from ({standins.PROFILE_SQL})
""")
def wire_encode(spark, folder):
    rows = standins.profiles(table(spark, folder, "customer"))
    return rows.select("id", encode().alias("value"))


_DECODED = ["id", "email", "dob", "weight", "height", "nickname", "country", "city", "caption", "location.lon", "location.lat", "gender"]


@query(standins.WHOLE_SQL.format(decoded=standins.LENIENT_SQL))
def wire_decode(spark, folder):
    good, _ = decode_messages(standins.json_messages(table(spark, folder, "customer"), whole=True))
    return good.select(*_DECODED)


@query(standins.WHOLE_SQL.format(decoded=standins.STRICT_SQL))
def wire_decode_strict(spark, folder):
    rows = standins.json_messages(table(spark, folder, "customer"), whole=True)
    good, _ = decode_messages(rows, unknown_fields="reject")
    return good.select(*_DECODED)


@query("""
select c_custkey as key, c_custkey % 13 as kind from customer where c_custkey % 13 in (1, 2, 6, 7, 8, 10, 12)
""")
def wire_dead_letters(spark, folder):
    _, dead = decode_messages(standins.json_messages(table(spark, folder, "customer")))
    return dead.select("key", (F.col("key") % 13).alias("kind"))


@query("""
select o_orderkey as id,
       case when o_orderkey % 5 = 0 or o_orderkey % 5 = 1 then null else cast(o_orderdate as date) end as dob
from orders
""")
def sentinel_null(spark, folder):
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(key % 5 == 0, F.lit("0000-00-00")).when(key % 5 == 1, F.lit("1988-1-8")).otherwise(day)
    return to_serving(table(spark, folder, "orders").select(key.alias("id"), text.alias("dob")))


@query("""
select c_custkey as key,
       case c_custkey % 7 when 1 then 'missing_weight' when 2 then 'missing_location_lat'
            when 3 then 'not_a_record' when 4 then 'missing_id' when 5 then 'not_a_record' end as reason,
       case when c_custkey % 7 in (0, 6) then c_custkey end as id,
       case when c_custkey % 7 in (0, 6) then cast(c_custkey % 100 as integer) end as weight,
       case when c_custkey % 7 in (0, 6) then c_name end as nickname
from customer
""")
def strict_record_parse(spark, folder):
    key, kind = F.col("c_custkey"), F.col("c_custkey") % 7
    weight = F.when(kind == 1, F.lit("")).otherwise(
        F.concat(F.lit('"weight":'), key % 100, F.lit(".9,")))
    lat = F.when(kind == 2, F.lit("")).otherwise(F.lit(',"lat":2'))
    nick = F.when(kind == 3, F.lit("5")).otherwise(F.concat(F.lit('"'), "c_name", F.lit('"')))
    ident = F.when(kind == 4, F.lit("null")).otherwise(key.cast("string"))
    body = F.concat(
        F.lit('{"id":'), ident, F.lit(","), weight, F.lit('"height":180,"nickname":'), nick,
        F.lit(',"country":1,"city":"c","caption":"","location":{"lon":1'), lat, F.lit('},"gender":1}'))
    rows = table(spark, folder, "customer").select(
        key.alias("key"), F.when(kind == 5, F.lit('"text"')).otherwise(body).alias("value"))
    return parse_required(rows).select(
        "key", "reason", "record.id", "record.weight", "record.nickname")


def _bodies(spark, folder):
    """Arrays of up to eight orders; some bodies hold a malformed element or are no array."""
    key = F.col("o_orderkey")
    bunch = F.floor(key / 8)
    text = F.concat(F.lit('{"id":'), key, F.lit(',"city":"'), F.col("o_orderstatus"), F.lit('"'),
                    F.lit(',"country":'), F.when((bunch % 7 == 2) & (key % 8 == 3), F.lit('"x"'))
                    .otherwise((F.col("o_custkey") % 40).cast("string")), F.lit("}"))
    joined = F.array_join(F.collect_list("text"), ",")
    return (
        table(spark, folder, "orders").select(bunch.alias("bunch"), text.alias("text"))
        .groupBy("bunch").agg(joined.alias("joined"))
        .select(
            F.concat(F.lit("client"), F.col("bunch") % 10).alias("client"),
            F.when(F.col("bunch") % 11 == 4, F.concat(F.lit('{"users":['), "joined", F.lit("]}")))
            .when(F.col("bunch") % 11 == 6, F.concat(F.lit("["), "joined", F.lit("] x]")))
            .otherwise(F.concat(F.lit("\n ["), "joined", F.lit("]\r\n"))).alias("body"),
        )
    )


_BUNCHES_SQL = """
select o_orderkey // 8 as bunch, o_orderkey, o_orderstatus, o_custkey,
       bool_or((o_orderkey // 8) % 7 = 2 and o_orderkey % 8 = 3) over (partition by o_orderkey // 8)
         or (o_orderkey // 8) % 11 in (4, 6) as refused
from orders
"""


@query(f"""
select 'client' || (bunch % 10) as client, o_orderkey as id, cast(o_custkey % 40 as integer) as country,
       o_orderstatus as city
from ({_BUNCHES_SQL}) where not refused
""")
def json_batch_explode(spark, folder):
    good, _ = arrays.split_bodies(_bodies(spark, folder))
    return good.select("client", "id", "country", "city")


@query(f"""
select 'client' || (bunch % 10) as client,
       cast(sum(case when refused then 0 else 1 end) as bigint) as received,
       count(distinct case when refused then bunch end) as received_err
from ({_BUNCHES_SQL}) group by 1
""")
def json_batch_counters(spark, folder):
    good, bad = arrays.split_bodies(_bodies(spark, folder))
    return arrays.received_by_client(good, bad)


@query("""
select user_id, event_id, ts, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
""")
def upsert_latest_by_key(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by_key(rows, ["user_id"], ["ts", "event_id"])


@query(f"""
with r as (select {standins.LINE_REASON_SQL} as reason from customer)
select m.metric, m.label, cast(case when m.good then count(*) filter (reason is null)
                                    when m.metric = 'read_total_err' then count(*) filter (reason is not null)
                                    else 0 end as double) as value
from r cross join (values ('read_total', 'csv', true), ('read_total_err', 'csv', false),
                          ('sent_total', 'users', true), ('sent_total_err', 'users', false))
                   m(metric, label, good)
group by m.metric, m.label, m.good
union all select 'feed_duration_seconds', null, 1 union all select 'feed_last_timestamp_seconds', null, 1
""")
def feed_run_summary(spark, folder):
    target = scratch(spark, "topic")
    summary = run_feed(_delimited_rows(spark, folder), lambda m: messages.publish_to_folder(m, target),
                       "csv", "users")
    label = F.coalesce(F.col("labels")["source"], F.col("labels")["topic"])
    # The two times differ from run to run: 1 says that they are there and not negative.
    timeless = F.when(label.isNull(), (F.col("value") >= 0).cast("double")).otherwise(F.col("value"))
    return summary.select("metric", label.alias("label"), timeless.alias("value"))
