"""Windowed counts on batch input, counters, histograms and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import client_label, path_label
from ..operators.counters import DURATION_BUCKETS, duration_histogram, labelled_counts, run_times
from ..streaming.counts import running_counts, tumbling_counts
from .registry import query, table


@query("""
select time_bucket(interval 10 second, ts) as window_start,
       time_bucket(interval 10 second, ts) + interval 10 second as window_end, event_type, count(*) as count
from events where event_type is not null group by all""")
def tumbling_count(spark, folder):
    return tumbling_counts(table(spark, folder, "events"), "ts", "event_type")


@query("""
select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end,
       user_id, count(*) as count from events where user_id is not null group by all""")
def tumbling_count_hourly(spark, folder):
    return tumbling_counts(table(spark, folder, "events"), "ts", "user_id", "1 hour")


@query("""
select date_trunc('hour', ts) as window_start, event_type, event_id,
       count(*) over (partition by date_trunc('hour', ts), event_type order by event_id
                      rows unbounded preceding) as running_count from events""")
def changelog_running_count(spark, folder):
    return running_counts(table(spark, folder, "events"), "ts", "event_type", None, "event_id", "1 hour")


@query("""
select event_type as label, count(*) filter (value < 400) as ok,
       count(*) filter (not coalesce(value < 400, false)) as err from events group by 1""")
def labelled_counters(spark, folder):
    return labelled_counts(table(spark, folder, "events"), "event_type", F.col("value") < 400)


@query("""
select cast(200 + 100 * cast(floor(value / 200) as integer) as varchar) as status, count(*) as requests
from events group by 1""")
def requests_by_status(spark, folder):
    status = (200 + 100 * F.floor(F.col("value") / 200)).cast("string")
    return table(spark, folder, "events").groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("requests"))


_BOUNDS_SQL = ", ".join(f"('{b:g}', {b})" for b in DURATION_BUCKETS)


@query(f"""
select event_type, user_id % 3 as status, le, count(*) filter (value / 40 <= bound) as bucket_count,
       round(sum(value / 40), 4) as total_seconds, count(*) as observations
from events, (values {_BOUNDS_SQL}, ('+Inf', 'infinity'::double)) b(le, bound) group by 1, 2, 3""")
def latency_histogram(spark, folder):
    events = table(spark, folder, "events").withColumn("status", F.col("user_id") % 3)
    rows = duration_histogram(events, ["event_type", "status"], F.col("value") / 40)
    return rows.withColumn("total_seconds", F.round("total_seconds", 4))


@query("""
select event_type, max(ts) as completed_at,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as duration_seconds from events group by 1""")
def feed_times(spark, folder):
    return run_times(table(spark, folder, "events"), "event_type", "ts")


@query(r"""
select page_id, case when label = '' then 'root' else label end as label from (
  select page_id, lower(trim(regexp_replace(path, '[^a-zA-Z0-9]+', '_', 'g'), '_')) as label from (
    select page_id, regexp_extract(url, '^https?://[^/]+(/?.*)$', 1) as path from pages)
  union all select -page_id - 1, lower(trim(regexp_replace(url, '[^a-zA-Z0-9]+', '_', 'g'), '_')) from pages)""", name="path_label")
def path_labels(spark, folder):
    pages = table(spark, folder, "pages")
    path = F.regexp_extract("url", "^https?://[^/]+(/?.*)$", 1)
    both = pages.select("page_id", path.alias("path")).unionByName(
        pages.select((-F.col("page_id") - 1).alias("page_id"), F.col("url").alias("path")))
    return both.select("page_id", path_label(F.col("path")).alias("label"))


@query("""
select c_custkey, case when c_custkey % 3 = 0 then 'ip' || c_custkey
                       when c_custkey % 2 = 0 then 'fwd' || c_custkey else 'remote' end as client
from customer""", name="client_label")
def client_labels(spark, folder):
    key = F.col("c_custkey")
    real = F.when(key % 3 == 0, F.concat(F.lit("ip"), key)).when(key % 3 == 1, F.lit(""))
    forwarded = F.when(key % 2 == 0, F.concat(F.lit("fwd"), key)).otherwise(F.lit(""))
    return table(spark, folder, "customer").select(
        "c_custkey", client_label(real, forwarded, F.lit("remote")).alias("client"))
