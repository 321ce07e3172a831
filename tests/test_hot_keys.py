"""Inputs in which one key holds a third of all rows or more: results stay whole."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterlake.operators.facets import facet_tokens, facet_values
from rosterlake.operators.latest import latest_by_key
from rosterlake.operators.scoring import page_per_query
from rosterlake.operators.search import match, match_many
from rosterlake.operators.textindex import TextIndex
from rosterlake.plans.indexing import StoredIndex
from rosterlake.streaming.counts import running_counts, tumbling_counts

N = 3000


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    keys = [0 if i % 3 == 0 else rng.randint(1, 900) for i in range(N)]
    data = [(i, k, f"w{k}" + (" common" if i % 2 else ""), i // 500) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "id bigint, key int, text string, minute int")
    return data, df.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60 + F.col("id") % 10)).persist()


def test_upsert_and_counts(rows):
    data, df = rows
    newest = {k: i for i, k, *_ in data}
    got = latest_by_key(df.select("key", "id"), ["key"], ["id"]).collect()
    assert {r["key"]: r["id"] for r in got} == newest
    assert facet_values(df, "key", 1).first()["count"] == Counter(k for _, k, *_ in data)[0]
    assert facet_tokens(df, "text", 1).first()["count"] == N // 2
    per_window = {(m, k): n for (m, k), n in Counter((m, k) for _, k, _, m in data).items()}
    counts = tumbling_counts(df, "ts", "key").collect()
    assert len(counts) == len(per_window) and sum(r["count"] for r in counts) == N
    running = running_counts(df, "ts", "key", None, "id", chunk=50).where("key = 0")
    assert running.count() == N // 3
    assert running.agg(F.max("running_count")).first()[0] == max(n for (_, k), n in per_window.items() if k == 0)


@pytest.mark.parametrize("stored", [False, True])
def test_a_word_of_half_the_documents(spark, rows, tmp_path, stored):
    _, df = rows
    fields = {"text": F.col("text")}
    index = TextIndex.over(df, "id", fields)
    if stored:
        on_disk = StoredIndex(spark, str(tmp_path / "ix"), "id", fields, buckets=4)
        on_disk.build(df)
        index = on_disk.open()
    assert match(index, "text", "common").count() == N // 2
    requests = spark.createDataFrame([(q, "common w0") for q in range(5)], "query_id int, query string")
    hits = match_many(index, "text", requests)
    assert hits.count() == 5 * hits.where("query_id = 0").count()
    best = page_per_query(hits, 30).collect()
    assert Counter(r["query_id"] for r in best) == {q: 30 for q in range(5)}
