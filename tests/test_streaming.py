import datetime
import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterlake.operators.search import match
from rosterlake.plans.indexing import StoredIndex
from rosterlake.plans.profiles import VERSION, ProfileTable
from rosterlake.schema import PROFILE
from rosterlake.sources.messages import follow_folder
from rosterlake.streaming.totals import WindowTotals, late_row_log, running_count_log
from rosterlake.streaming.counts import running_counts, tumbling_counts
from rosterlake.streaming.progress import StreamCounters, counted
from rosterlake.streaming.jobs import country_counts, drain, index_profiles, latest_counts, parquet_log, start

SCHEMA = "ts timestamp, country int"


def at(day, second):
    return datetime.datetime(2024, 1, day) + datetime.timedelta(seconds=second)


def add_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


class Topic:
    """A folder read as a stream, drained once per batch of rows."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.batches = spark, str(tmp_path), []

    def feed(self, rows):
        add_file(self.spark, f"{self.root}/in", rows)
        seen = []

        def sink(batch, batch_id):
            seen.extend((r["window_start"], r["country"], r["count"]) for r in batch.collect())

        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in")
        query = drain(tumbling_counts(stream, "ts", "country"), f"{self.root}/cp", sink)
        self.dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
        return sorted(seen)


def test_updates_restarts_and_late_records(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    first, second, third = at(1, 0), at(1, 10), at(3, 0)
    assert topic.feed([(at(1, 1), 1), (at(1, 9), 1), (at(1, 10), 1)]) == [(first, 1, 2), (second, 1, 1)]
    # Every feed is a new run on the same checkpoint: counts go on from the stored state.
    assert topic.feed([(at(1, 5), 1), (at(1, 11), None)]) == [(first, 1, 3)]
    assert topic.feed([(at(3, 0), 2)]) == [(third, 2, 1)]
    topic.feed([(at(3, 1), 2)])
    assert topic.feed([(at(1, 6), 1), (at(3, 2), 2)]) == [(third, 2, 3)]
    assert topic.dropped == 1


def test_stream_and_batch_agree(spark, tmp_path):
    rng = random.Random(4)
    rows = [(at(1, rng.randint(0, 300)), rng.choice([1, 1, 1, 2, None])) for _ in range(500)]
    for i in range(0, 500, 100):
        add_file(spark, str(tmp_path / "in"), rows[i:i + 100])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    drain(tumbling_counts(stream, "ts", "country"), str(tmp_path / "cp"), parquet_log(str(tmp_path / "log"), str(tmp_path / "cp")))
    streamed = latest_counts(spark.read.parquet(str(tmp_path / "log")), "country")
    batch = tumbling_counts(spark.createDataFrame(rows, SCHEMA), "ts", "country")
    columns = ["window_start", "window_end", "country", "count"]
    assert sorted(streamed.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert sum(r["count"] for r in batch.collect()) == sum(c is not None for _, c in rows)


def test_console_and_memory_sinks(spark, tmp_path, capfd):
    add_file(spark, str(tmp_path / "in"), [(at(1, 1), 7)])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    counts = tumbling_counts(stream, "ts", "country")
    drain(counts, str(tmp_path / "cp1"), "memory", name="seen", mode="update")
    assert spark.table("seen").select("country", "count").collect() == [(7, 1)]
    query = start(counts, str(tmp_path / "cp2"), "console", available_now=True)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_counters(spark, tmp_path):
    counters = StreamCounters()
    spark.streams.addListener(counters)
    try:
        for n in range(2):
            add_file(spark, str(tmp_path / "in"), [(at(1, n), 1), (at(1, n), None), (at(1, n), 2)])
            stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
            drain(counted(stream, "users", F.col("country").isNotNull()), str(tmp_path / "cp"), "noop", mode="append")
        for _ in range(100):  # progress events arrive a little later
            if counters.totals().get("users") == (4, 2):
                break
            time.sleep(0.1)
        assert [tuple(r) for r in counters.table(spark).collect()] == [("users", 4, 2)]
    finally:
        spark.streams.removeListener(counters)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_running_counts(spark, chunk):
    rng = random.Random(9)
    rows = [(p, o, at(1, o // 3), rng.choice(["hot"] * 8 + ["a", "b", None])) for p in range(3) for o in range(120)]
    df = spark.createDataFrame(rows, "part int, off bigint, ts timestamp, key string")
    got = {(r["part"], r["off"]): r["running_count"]
           for r in running_counts(df, "ts", "key", "part", "off", chunk=chunk).collect()}
    so_far, want = Counter(), {}
    for p, o, ts, key in sorted(rows, key=lambda r: r[:2]):
        if key is not None:
            window = (ts.replace(second=ts.second // 10 * 10), key)
            so_far[window] += 1
            want[p, o] = so_far[window]
    assert got == want


# -- upsert ----------------------------------------------------------------------------------


def change(i, tag, ts, offset=0):
    return (i, tag, "0000-00-00", 1, 1, "n", 1, "c", "", (1.0, 2.0), 1, at(1, ts), 0, offset)


CHANGES = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PROFILE) + (
    ", _ts timestamp, _partition int, _offset bigint")


def contents(table):
    return {r["id"]: r["email"] for r in table.read().collect()}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
@pytest.mark.parametrize("compact_after", [1, 2, 100])
def test_the_order_of_batches_does_not_matter(spark, tmp_path, order, compact_after):
    batches = [
        [change(i, "a", 0) for i in range(20)],
        [change(3, "b", 5), change(3, "c", 5, 1), change(4, "b", 5)],
        [change(3, "old", 1), change(50, "new", 1)],
    ]
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=4, compact_after=compact_after)
    assert contents(table) == {}
    for n, which in enumerate(order):
        table.upsert(spark.createDataFrame(batches[which], CHANGES), n)
        table.upsert(spark.createDataFrame([change(99, "replayed", 9)], CHANGES), n)  # committed already
    want = {**{i: "a" for i in range(20)}, 3: "c", 4: "b", 50: "new"}
    assert contents(table) == want
    table.compact()
    assert contents(table) == want and not any(table.parts.pending().values())
    assert table.parts.clean(hours=0) >= 3 and contents(table) == want and not table.parts.batches()
    table.upsert(spark.createDataFrame([change(99, "replayed", 9)], CHANGES), 1)  # its folder is gone, the batch is not
    assert contents(table) == want


def test_a_batch_merges_its_share_of_the_buckets(spark, tmp_path):
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=4, compact_after=2)
    merged = []
    for n in range(4):
        table.upsert(spark.createDataFrame([change(i, f"b{n}", n) for i in range(40)], CHANGES), n)
        merged.append(sum(table.parts.state(s)["base"] is not None for s in range(table.parts.shares)))
    assert merged == [0, 1, 2, 2]
    assert contents(table) == {i: "b3" for i in range(40)}


def test_current_rows_of_some_ids(spark, tmp_path):
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=4, compact_after=2)
    table.upsert(spark.createDataFrame([change(i, "a", 0) for i in range(30)], CHANGES), 0)
    table.upsert(spark.createDataFrame([change(i, "b", 1) for i in (3, 4)], CHANGES), 1)
    ids = spark.createDataFrame([(3,), (3,), (7,), (99,)], "id bigint")
    found = table.current(ids)
    assert {r["id"]: r["email"] for r in found.collect()} == {3: "b", 7: "a"} and found.count() == 2
    assert table.current(ids.where("id = 99")).count() == 0


def test_two_writers_keep_each_others_rows(spark, tmp_path):
    """One starts its batch before the other has written its own."""
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2)
    other = ProfileTable(spark, str(tmp_path / "t"), buckets=2)
    write = table.parts._write

    def slow_write(*args):
        if not other.parts.batches():
            other.upsert(spark.createDataFrame([change(i, "winner", 0) for i in range(10)], CHANGES), 0, "other")
        write(*args)

    table.parts._write = slow_write
    table.upsert(spark.createDataFrame([change(i, "late", 1) for i in range(8, 20)], CHANGES), 0, "one")
    want = {**{i: "winner" for i in range(8)}, **{i: "late" for i in range(8, 20)}}
    assert contents(table) == want == contents(other)


def test_batches_that_arrive_during_a_merge_keep_waiting(spark, tmp_path):
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2, compact_after=100)
    table.upsert(spark.createDataFrame([change(i, "a", 0) for i in range(6)], CHANGES))
    write = table.parts._write

    def slow_write(name, rows):
        write(name, rows)
        if name.startswith("part=base.") and len(table.parts.batches()) == 1:
            ProfileTable(spark, str(tmp_path / "t")).upsert(spark.createDataFrame([change(3, "b", 1)], CHANGES))

    table.parts._write = slow_write
    table.compact()
    assert contents(table) == {**{i: "a" for i in range(6)}, 3: "b"}
    table.compact()
    assert contents(table) == {**{i: "a" for i in range(6)}, 3: "b"}


def test_two_merges_at_once_lose_nothing(spark, tmp_path):
    """A merge that began before another batch ends after a merge that has that batch."""
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2, compact_after=100)
    other = ProfileTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([change(i, "a", 0) for i in range(6)], CHANGES), 0, "s")
    write = table.parts._write

    def slow_write(name, rows):
        write(name, rows)
        if not any(state["base"] for state in other.parts.states().values()):
            other.upsert(spark.createDataFrame([change(3, "b", 1)], CHANGES), 1, "s")
            other.compact()

    table.parts._write = slow_write
    table.compact()
    want = {**{i: "a" for i in range(6)}, 3: "b"}
    assert contents(table) == want
    table.compact()
    assert contents(table) == want == contents(other)


def test_a_batch_that_was_broken_off_does_not_count(spark, tmp_path):
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2)
    rows = spark.createDataFrame([change(1, "a", 0)], CHANGES)
    table.upsert(rows, 0, "s")
    (tmp_path / "t" / "part=change.s.000000000000" / "_SUCCESS").unlink()
    assert contents(table) == {}
    table.upsert(spark.createDataFrame([change(1, "again", 0)], CHANGES), 0, "s")
    assert contents(table) == {1: "again"}
    with pytest.raises(ValueError):
        table.upsert(rows, 0, "../x")


def test_batch_numbers_belong_to_their_stream(spark, tmp_path):
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2)
    for stream, email in (("a", "x"), ("b", "y"), ("a", "skipped")):
        rows = [change(ord(stream) if email != "skipped" else 1, email, 0)]
        table.upsert(spark.createDataFrame(rows, CHANGES), 0, stream)
    assert contents(table) == {97: "x", 98: "y"} and table.parts.batches() == [("a", 0), ("b", 0)]


def test_an_existing_table_is_opened_as_it_is(spark, tmp_path):
    ProfileTable(spark, str(tmp_path / "t"), buckets=2).upsert(
        spark.createDataFrame([change(1, "a", 0)], CHANGES))
    again = ProfileTable(spark, str(tmp_path / "t"), buckets=64)
    assert contents(again) == {1: "a"} and again.parts.buckets == 2


def test_messages_reach_the_table_and_bad_ones_the_dead_letters(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2)

    def run():
        index_profiles(follow_folder(spark, str(topic)), table, str(tmp_path / "cp"),
                       dead_letters=str(tmp_path / "dead"), available_now=True).awaitTermination()

    (topic / "1.txt").write_text("\n".join([json.dumps({"id": 1, "email": "x"}), "garbage"]))
    run()
    (topic / "2.txt").write_text(json.dumps({"id": 2, "email": "y", "dob": "1990-02-03"}))
    run()
    assert contents(table) == {1: "x", 2: "y"}
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["garbage"]
    assert {c for c in VERSION} <= set(table.parts.read().columns)


def test_a_stream_keeps_the_index_current(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    table = ProfileTable(spark, str(tmp_path / "t"), buckets=2)
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", {"city": F.col("city")}, buckets=2)

    def run(name, *records):
        (topic / name).write_text("\n".join(map(json.dumps, records)))
        index_profiles(
            follow_folder(spark, str(topic)), table, str(tmp_path / "cp"), available_now=True,
            after=lambda profiles, _: index.refresh(table.current(profiles)),
        ).awaitTermination()
        return {r["doc_id"] for r in match(index.open(), "city", "york").collect()}

    assert run("1.txt", {"id": 1, "city": "New York"}, {"id": 2, "city": "York"}, {"id": 3, "city": "Paris"}) == {1, 2}
    assert run("2.txt", {"id": 2, "city": "Rome"}, {"id": 3, "city": "york"}) == {1, 3}


def test_countries_of_messages(spark):
    rows = [('{"id":1,"country":5}', at(1, 1)), ('{"id":2,"country":5}', at(1, 9)), ('{"id":3}', at(1, 2)),
            ('{"id":4,"country":5,"x":1}', at(1, 3)), ("nope", at(1, 3)), ('{"id":5,"country":5}', at(1, 10))]
    counts = country_counts(spark.createDataFrame(rows, "value string, timestamp timestamp"))
    assert sorted((r["window_start"], r["country"], r["count"]) for r in counts.collect()) == [
        (at(1, 0), 5, 2), (at(1, 10), 5, 1)]


# -- totals over micro-batches ---------------------------------------------------------------


def checkpoint_of(folder, name):
    folder.mkdir()
    (folder / "metadata").write_text(json.dumps({"id": name}))
    return str(folder)


def test_running_counts_go_on_over_batches_replays_and_streams(spark, tmp_path):
    rng = random.Random(21)
    rows = [(n, at(1, rng.randrange(30)), rng.choice(["hot"] * 6 + ["a", None])) for n in range(400)]
    totals = WindowTotals(spark, str(tmp_path / "totals"), buckets=4, merge_after=2)
    sinks = {s: running_count_log(str(tmp_path / "log"), totals, checkpoint_of(tmp_path / s, s), "ts", "key", None, "off")
             for s in ("first", "second")}

    def batch(n):
        return spark.createDataFrame(rows[n * 80:(n + 1) * 80], "off bigint, ts timestamp, key string")

    for n in range(3):
        sinks["first"](batch(n), n)
        if n != 1:
            sinks["first"](batch(n), n)  # replayed after a failure
    again = WindowTotals(spark, str(tmp_path / "totals"))  # a restart
    assert any(again.counts.state(s)["base"] for s in range(again.counts.shares))
    for n in (3, 4):
        sinks["second"](batch(n), n - 3)  # a fresh checkpoint starts its numbers anew
    got = {r["off"]: r["running_count"] for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    so_far, want = Counter(), {}
    for off, ts, key in rows:
        if key is not None:
            group = (ts.replace(second=ts.second // 10 * 10), key)
            so_far[group] += 1
            want[off] = so_far[group]
    assert got == want
    assert {(r["window_start"], r["key"]): r["count"] for r in again.read().collect()} == dict(so_far)


def minute(m, second):
    return at(1, 60 * m + second)


def test_rows_that_come_too_late_are_logged_with_their_window(spark, tmp_path):
    totals = WindowTotals(spark, str(tmp_path / "totals"), buckets=2)
    sink = late_row_log(str(tmp_path / "late"), totals, checkpoint_of(tmp_path / "cp", "s"), "ts", "key", retention="1 minute")

    def batch(n, *rows):
        sink(spark.createDataFrame(list(rows), "ts timestamp, key string, value int"), n)

    batch(0, (minute(1, 5), "a", 1), (minute(9, 0), "a", 2))  # late rows of its own batch are in time
    batch(1, (minute(7, 55), "a", 3), (minute(8, 1), "a", 4), (minute(1, 6), None, 5), (minute(12, 0), "b", 6))
    batch(1, (minute(7, 55), "a", 3), (minute(8, 1), "a", 4), (minute(1, 6), None, 5), (minute(12, 0), "b", 6))
    batch(2, (minute(10, 59), "a", 7), (minute(11, 0), "b", 8))
    late = {r["value"]: r["window_end"] for r in spark.read.parquet(str(tmp_path / "late")).collect()}
    assert late == {3: minute(8, 0), 7: minute(11, 0)}
    counts = {(r["window_start"], r["key"]): r["count"] for r in totals.read().collect()}
    assert counts == {(minute(1, 0), "a"): 1, (minute(9, 0), "a"): 1, (minute(8, 0), "a"): 1, (minute(12, 0), "b"): 1, (minute(11, 0), "b"): 1}
