import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.functions.wire import decode_messages, encode, parse_required, to_serving
from rosterlake.schema import PROFILE
from rosterlake.sources.arrays import split_bodies


def decode(spark, *texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    good, dead = decode_messages(df, **options)
    return {r["n"]: r for r in good.collect()}, {r["n"]: r["value"] for r in dead.collect()}


def test_what_the_lenient_decoder_takes(spark):
    good, dead = decode(
        spark, '{"id":1,"extra":{"a":1}}', '{"country":"5"}', '{"country":5.7}', '{"city":5}', "[1]", "nope", "",
        '{"id":2,"location":{"lat":3}}', '{"id":3,"score":1.5,"city":null}', '{"id":4} tail', '{"score":"x"}')
    assert sorted(good) == [0, 7, 8] and sorted(dead) == [1, 2, 3, 4, 5, 6, 9, 10]
    assert good[0]["country"] == 0 and good[0]["location"] is None
    assert tuple(good[7]["location"]) == (0.0, 3.0)


def test_the_whole_text_is_one_record(spark):
    texts = ['{"id":1}\n', '\r\n\t {"id":2} ', '{"id":3} {"id":4}', '{"id":5} x}', '{"id":6}]', '{"id":7},{"id":8}',
             '{"ID":9,"Nickname":"x","LOCATION":{"Lon":2}}', '{"id":1,"ID":10}', '{"id":11,"caption":"\\"ID\\": 5"}',
             '{"id":12}],{"id":13}', None]
    good, dead = decode(spark, *texts)
    assert {n: r["id"] for n, r in good.items()} == {0: 1, 1: 2, 6: 9, 7: 10, 8: 11}
    assert good[6]["nickname"] == "x" and good[6]["location"]["lon"] == 2.0 and good[8]["caption"] == '"ID": 5'
    assert sorted(dead) == [2, 3, 4, 5, 9, 10]
    good, _ = decode(spark, '{"ID":9}', unknown_fields="reject")
    assert not good


def test_bodies_are_one_array(spark):
    bodies = ['\n[{"id":1},{"ID":2}]\r\n', '[{"id":3}] junk', '[{"id":3}][', ' {"id":4}', '[{"id":5},null]', "[]", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(bodies)], "n int, body string")
    good, bad = split_bodies(rows)
    assert sorted((r["n"], r["id"]) for r in good.collect()) == [(0, 1), (0, 2), (4, 0), (4, 5)]
    assert {r["n"]: r["reason"] for r in bad.collect()} == {n: "not_an_array" for n in (1, 2, 3, 6)}


def test_what_the_strict_decoder_takes(spark):
    good, _ = decode(
        spark, '{"id":1,"extra":1}', '{"location":{"lon":1,"alt":2}}', '{"id":5,"location":{"lon":1}}',
        unknown_fields="reject")
    assert sorted(good) == [2] and good[2]["country"] is None
    with pytest.raises(ValueError):
        decode(spark, "{}", unknown_fields="maybe")


text = st.none() | st.text(st.characters(blacklist_categories=("Cs", "Cc")), max_size=6)
small = st.none() | st.integers(-5, 5)
profile = st.fixed_dictionaries({
    "id": st.integers(-3, 2**40), "email": text, "dob": text, "weight": small, "height": small, "nickname": text,
    "country": st.integers(-2, 2), "city": text, "caption": text,
    "location": st.none() | st.tuples(st.sampled_from([0.0, 1.5, -7.25]), st.sampled_from([0.0, 2.5])),
    "gender": small})


@settings(max_examples=8, deadline=None)
@given(st.lists(profile, min_size=1, max_size=20))
def test_encoding_reads_back(spark, people):
    rows = [tuple(p[n] for n in PROFILE.fieldNames()) for p in people]
    df = spark.createDataFrame(rows, PROFILE).withColumn("n", F.monotonically_increasing_id())
    sent = df.select("n", encode().alias("value")).collect()
    for row, person in zip(sorted(sent), people):
        body = json.loads(row["value"])
        absent = {k for k, v in person.items() if v is None or (k in ("id", "country") and v == 0)}
        assert set(body) == set(person) - absent
    good, dead = decode_messages(spark.createDataFrame(sent))
    assert dead.count() == 0
    back = [tuple(r) for r in good.orderBy("n").select(*PROFILE.fieldNames()).collect()]
    assert back == rows


FULL = {"id": 1.9, "weight": -5.5, "height": 2, "nickname": "n", "country": 1, "city": "c", "caption": "",
        "location": {"lat": 1, "lon": 2}, "gender": 1}


def required(spark, *records, **options):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "n int, value string")
    return parse_required(df, **options).orderBy("n")


def test_required_fields(spark):
    def without(name):
        return {k: v for k, v in FULL.items() if k != name}

    rows = required(spark, FULL, without("id"), {**FULL, "city": None}, {**FULL, "location": {"lat": 1}},
                    {**FULL, "weight": "5"}, {**FULL, "nickname": 5}, [1], {**FULL, "email": 5}).collect()
    assert [r["reason"] for r in rows] == [
        None, "missing_id", "missing_city", "missing_location_lon", "not_a_record", "not_a_record",
        "not_a_record", "not_a_record"]
    record = rows[0]["record"]
    assert (record["id"], record["weight"], record["email"]) == (1, -5, None) and rows[1]["record"] is None


def test_fail_fast(spark):
    assert required(spark, FULL, fail_fast=True).first()["record"]["id"] == 1
    with pytest.raises(Exception, match="missing_gender"):
        required(spark, {k: v for k, v in FULL.items() if k != "gender"}, fail_fast=True).collect()


def test_unknown_dates_become_null(spark):
    df = spark.createDataFrame([("0000-00-00",), ("1988-1-8",), ("1988-01-08",), (None,)], "dob string")
    assert [str(r["dob"]) for r in to_serving(df).collect()] == ["None", "None", "1988-01-08", "None"]


def test_no_text_is_special(spark):
    bodies = {'{"id":1,"caption":"rosterlake-end-of-text"}': True, '{"id":1,"caption":"],[,0]"}': True, ' {"id":2}\n': True,
              '{"id":1}],[{"id":2}': False, '{"id":1},0],[1': False, '{"id":1},{"id":2}': False, '{"id":1}]': False, "": False, "]": False,
              '{"id":1},': False, '"open': False, '{"id":3} x': False}
    good, dead = decode_messages(spark.createDataFrame([(b,) for b in bodies], "value string"))
    assert good.count() == sum(bodies.values())
    assert {r["value"] for r in dead.collect()} == {b for b, fine in bodies.items() if not fine}
