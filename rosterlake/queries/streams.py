"""Streaming queries: the test tables are streamed to completion and the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.wire import decode_messages
from ..plans.profiles import ProfileTable
from ..session import scratch
from ..sources.messages import follow_folder
from ..streaming.counts import tumbling_counts
from ..streaming.jobs import country_counts, drain, index_profiles, latest_counts, parquet_log
from ..streaming.totals import WindowTotals, late_row_log, running_count_log
from . import standins
from .registry import query, table


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


def _without_zone(counts):
    """Window limits as in the source table, which has no time zone."""
    return counts.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("""
select time_bucket(interval 10 second, ts) as window_start,
       time_bucket(interval 10 second, ts) + interval 10 second as window_end, event_type, count(*) as count
from events where event_type is not null group by all""")
def stream_tumbling_count(spark, folder):
    work = scratch(spark, "counts")
    drain(tumbling_counts(_event_stream(spark, folder), "ts", "event_type"),
          f"{work}/checkpoint", parquet_log(f"{work}/log", f"{work}/checkpoint"), mode="update")
    return _without_zone(latest_counts(spark.read.parquet(f"{work}/log"), "event_type"))


@query("""
with w as (select time_bucket(interval 1 hour, ts) as window_start,
                  time_bucket(interval 1 hour, ts) + interval 1 hour as window_end, event_type, count(*) as n
           from events group by all)
select window_start, window_end, event_type,
       case when window_end <= (select date_trunc('milliseconds', max(ts)) - interval 1 day from events)
            then n else 2 * n end as count from w""")
def stream_late_drop(spark, folder):
    """All events, one marker that lets the watermark pass, then all events again: the second time
    only the windows of the last day still take them."""
    work = scratch(spark, "late")
    events = table(spark, folder, "events").select("ts", "event_type")
    marker = events.agg(F.max("ts").alias("ts")).withColumn("event_type", F.lit("marker"))
    for part in (events, marker, events):
        part.write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        drain(tumbling_counts(stream, "ts", "event_type", "1 hour"),
              f"{work}/checkpoint", parquet_log(f"{work}/log", f"{work}/checkpoint"), mode="update")
    counts = latest_counts(spark.read.parquet(f"{work}/log"), "event_type")
    return _without_zone(counts.where(F.col("event_type") != "marker"))


@query("""
with m as (select o_orderdate + to_seconds(o_orderkey % 40) as ts, cast(o_custkey % 7 as integer) as country
           from orders where o_orderkey % 10 not in (3, 6))
select time_bucket(interval 10 second, ts) as window_start,
       time_bucket(interval 10 second, ts) + interval 10 second as window_end, country, count(*) as count
from m where country <> 0 group by all""")
def stream_country_count(spark, folder):
    """Orders as profile messages: country 0 is left out of the text, some texts have an unknown field or
    are cut off."""
    work = scratch(spark, "country")
    key = F.col("o_orderkey")
    head = F.concat(F.lit('{"id":'), key, F.when(F.col("o_custkey") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"country":'), F.col("o_custkey") % 7)))
    tail = F.when(key % 10 == 3, F.lit(',"extra":1}')).when(key % 10 == 6, F.lit("")).otherwise(F.lit("}"))
    sent = F.timestamp_add("SECOND", (key % 40).cast("int"), F.col("o_orderdate").cast("timestamp"))
    table(spark, folder, "orders").select(
        F.concat(head, tail).alias("value"), sent.alias("timestamp")).write.parquet(f"{work}/topic")
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{work}/topic")
    drain(country_counts(stream), f"{work}/checkpoint", parquet_log(f"{work}/log", f"{work}/checkpoint"))
    return _without_zone(latest_counts(spark.read.parquet(f"{work}/log"), "country"))


@query(standins.LENIENT_SQL)
def stream_decode(spark, folder):
    work = scratch(spark, "decode")
    standins.json_messages(table(spark, folder, "customer")).select("value").write.text(f"{work}/topic")
    good, _ = decode_messages(follow_folder(spark, f"{work}/topic"))
    rows = good.select("id", "nickname", "country", F.col("location.lon").alias("lon"),
                       F.col("location.lat").alias("lat"))
    drain(rows, f"{work}/checkpoint", "parquet", mode="append", path=f"{work}/out")
    return spark.read.parquet(f"{work}/out")


_NEWEST = """
select user_id as id, event_type as nickname, cast(floor(value) as integer) as weight, event_id as height from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""


def _event_topic(events, path):
    """Events as profile messages in several files, in order of time."""
    profile = F.struct(
        F.col("user_id").alias("id"), F.col("event_type").alias("nickname"),
        F.floor("value").cast("int").alias("weight"), F.col("event_id").cast("int").alias("height"))
    (
        events.select(
            F.to_json(profile).alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
        .repartitionByRange(4, "timestamp").write.mode("append").parquet(path)
    )


def _follow_topic(spark, path):
    return (
        spark.readStream.schema("value string, timestamp timestamp, partition int, offset bigint")
        .option("maxFilesPerTrigger", 1).parquet(path)
    )


def _stored_events(profiles):
    return profiles.read().select("id", "nickname", "weight", F.col("height").cast("bigint").alias("height"))


@query(_NEWEST)
def stream_upsert(spark, folder):
    """Events as profile messages in several micro-batches, upserted by user."""
    work = scratch(spark, "upsert")
    _event_topic(table(spark, folder, "events"), f"{work}/topic")
    profiles = ProfileTable(spark, f"{work}/profiles", buckets=8, compact_after=3)
    index_profiles(_follow_topic(spark, f"{work}/topic"), profiles, f"{work}/checkpoint",
                   available_now=True).awaitTermination()
    return _stored_events(profiles)


@query(_NEWEST)
def stream_upsert_two_streams(spark, folder):
    """Two topics with half of the events each, upserted into one table by two streams."""
    work = scratch(spark, "upsert-two")
    events = table(spark, folder, "events")
    profiles = ProfileTable(spark, f"{work}/profiles", buckets=8, compact_after=3)
    for half in (0, 1):
        _event_topic(events.where(F.col("event_id") % 2 == half), f"{work}/topic{half}")
        index_profiles(_follow_topic(spark, f"{work}/topic{half}"), profiles, f"{work}/checkpoint{half}",
                       available_now=True).awaitTermination()
    return _stored_events(profiles)


@query(_NEWEST)
def stream_upsert_new_checkpoint(spark, folder):
    """The older half of the events, then the newer half from a topic of its own after the checkpoint was lost."""
    work = scratch(spark, "upsert-new")
    events = table(spark, folder, "events")
    middle = events.agg(F.expr("percentile_approx(unix_micros(cast(ts as timestamp)), 0.5)").alias("m")).first()["m"]
    dated = events.withColumn("late", F.expr(f"unix_micros(cast(ts as timestamp)) > {middle}"))
    profiles = ProfileTable(spark, f"{work}/profiles", buckets=8, compact_after=3)
    for run, half in enumerate((~F.col("late"), F.col("late"))):
        _event_topic(dated.where(half).select(*events.columns), f"{work}/topic{run}")
        index_profiles(_follow_topic(spark, f"{work}/topic{run}"), profiles, f"{work}/checkpoint-of-run{run}",
                       available_now=True).awaitTermination()
    return _stored_events(profiles)


@query("""
select date_trunc('hour', ts) as window_start, event_type, event_id,
       count(*) over (partition by date_trunc('hour', ts), event_type order by event_id
                      rows unbounded preceding) as running_count from events""")
def stream_running_count(spark, folder):
    """Events in four micro-batches by their number; every count goes on where the batch before ended."""
    work = scratch(spark, "running")
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    last = events.agg(F.max("event_id").alias("m")).first()["m"]
    totals = WindowTotals(spark, f"{work}/totals", buckets=4, merge_after=2)
    sink = running_count_log(f"{work}/log", totals, f"{work}/checkpoint", "ts", "event_type", None, "event_id", "1 hour")
    for part in range(4):
        mine = F.floor(F.col("event_id") * 4 / (last + 1)) == part
        events.where(mine).write.mode("append").parquet(f"{work}/in")
        drain(spark.readStream.schema(events.schema).parquet(f"{work}/in"), f"{work}/checkpoint", sink, mode="append")
    return spark.read.parquet(f"{work}/log").select("window_start", "event_type", "event_id", "running_count")


@query("""
with w as (select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n from events
           where event_type is not null group by all),
m as (select max(ts) - interval 1 day as mark from events where event_type is not null)
select window_start, event_type, 2 * n as total, case when window_start + interval 1 hour <= mark then n else 0 end as late
from w, m""")
def stream_late_rows(spark, folder):
    """All events, then all again: what was counted and what came too late, per window and type."""
    work = scratch(spark, "late-rows")
    events = table(spark, folder, "events").select("ts", "event_type")
    totals = WindowTotals(spark, f"{work}/totals", buckets=4)
    sink = late_row_log(f"{work}/late", totals, f"{work}/checkpoint", "ts", "event_type", "1 hour")
    for _ in range(2):
        events.write.mode("append").parquet(f"{work}/in")
        drain(spark.readStream.schema(events.schema).parquet(f"{work}/in"), f"{work}/checkpoint", sink, mode="append")
    late = spark.read.parquet(f"{work}/late").groupBy("window_start", "event_type").agg(F.count(F.lit(1)).alias("late"))
    counted = totals.read().withColumnRenamed("key", "event_type")
    both = counted.join(late, ["window_start", "event_type"], "full")
    return both.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
        (F.coalesce("count", F.lit(0)) + F.coalesce("late", F.lit(0))).alias("total"), F.coalesce("late", F.lit(0)).alias("late"))
