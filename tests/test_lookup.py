import datetime
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brute import kilometres
from rosterlake.functions.geo import bounding_box
from rosterlake.functions.labels import client_label, path_label
from rosterlake.operators.around import within_radius, within_radius_many
from rosterlake.operators.counters import duration_histogram, labelled_counts
from rosterlake.operators.facets import facet_dates, facet_tokens, facet_values
from rosterlake.operators.fields import date_period, match_date, match_number
from rosterlake.operators.requests import normalise
from rosterlake.operators.suggest import suggest, suggest_many, with_echo
from rosterlake.operators.textindex import TextIndex

POINTS = [(lat, lon) for lat in (-90.0, -89.5, -60.0, 0.0, 51.1, 89.9, 90.0)
          for lon in (-180.0, -179.9, -90.0, 0.0, 16.9, 179.95, 180.0)]
rng = random.Random(1)
POINTS += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
POINTS += [(51.1 + rng.uniform(-1, 1), 16.9 + rng.uniform(-1, 1)) for _ in range(150)]  # a crowded place

CENTRES = [(51.1, 16.9, 50.0), (0.0, 179.99, 300.0), (89.9, 10.0, 500.0), (-90.0, 0.0, 1000.0), (10.0, -179.0, 4000.0),
           (51.1, 16.9, 0.0), (0.0, 0.0, 30000.0), (45.0, 170.0, 9000.0), (88.0, 100.0, 220.0)]


@pytest.fixture(scope="module")
def places(spark):
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(POINTS)] + [(9999, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double")
    return df.select("id", F.struct("lon", "lat").alias("location")).persist()


def around(lat, lon, radius):
    return {i for i, p in enumerate(POINTS) if kilometres(lat, lon, *p) <= radius}


@pytest.mark.parametrize("lat,lon,radius", CENTRES)
def test_radius(places, lat, lon, radius):
    hits = within_radius(places, lat, lon, radius).collect()
    assert {r["id"] for r in hits} == around(lat, lon, radius)
    assert all(r["score"] == 1.0 and r["distance_km"] <= radius for r in hits)


def test_a_table_of_circles_equals_single_circles(spark, places):
    rows = [(q, *c) for q, c in enumerate(CENTRES)]
    circles = spark.createDataFrame(rows, "query_id int, lat double, lon double, radius_km double")
    got = {(r["query_id"], r["id"]) for r in within_radius_many(places, circles).collect()}
    assert got == {(q, i) for q, c in enumerate(CENTRES) for i in around(*c)}


def test_radius_must_not_be_negative(places):
    with pytest.raises(ValueError):
        within_radius(places, 0, 0, -1)


@settings(max_examples=200, deadline=None)
@given(st.floats(-90, 90), st.floats(-180, 180), st.floats(0, 21000), st.floats(-90, 90), st.floats(-180, 180))
def test_the_box_contains_the_circle(lat, lon, radius, plat, plon):
    if kilometres(lat, lon, plat, plon) <= radius:
        box = bounding_box(lat, lon, radius)
        assert box["south"] <= plat <= box["north"]
        if box["wraps"]:
            assert plon >= box["west"] or plon <= box["east"]
        else:
            assert box["west"] <= plon <= box["east"]


def test_number_and_date_fields(spark):
    df = spark.createDataFrame(
        [(1, 5, datetime.date(1990, 12, 31)), (2, 6, datetime.date(1991, 1, 1)), (3, None, None)],
        "id int, size int, day date")
    assert [tuple(r) for r in match_number(df, "size", "+5").select("id", "score").collect()] == [(1, 1.0)]
    with pytest.raises(ValueError):
        match_number(df, "size", "5.0")
    found = {q: [r["id"] for r in match_date(df, "day", q).collect()] for q in ("1990", "1990-12", "1991-01-01", "1992")}
    assert found == {"1990": [1], "1990-12": [1], "1991-01-01": [2], "1992": []}
    assert date_period("2024-02") == (datetime.date(2024, 2, 1), datetime.date(2024, 3, 1))
    for bad in ("1990-13", "90", "1990-1-1", "x"):
        with pytest.raises(ValueError):
            date_period(bad)


NAMES = {1: "Anna", 2: "anna maria", 3: "Annabel", 4: "Bert", 5: "Anna", 6: "Mann"}


def test_suggestions(spark):
    names = spark.createDataFrame(list(NAMES.items()), "id bigint, nickname string")
    index = TextIndex.over_prefixes(names, "id", {"nickname": F.col("nickname")})
    found = suggest(index, "nickname", "ANN", names, "id", "nickname")
    ranked = [r["name"] for r in found.orderBy("rank").collect()]
    assert ranked == ["Anna", "Annabel", "Anna", "anna maria"]  # ties in id order
    echoed = with_echo(found, "ANN").orderBy("rank").collect()
    assert echoed[0]["name"] == "ANN" and [r["rank"] for r in echoed] == [0, 1, 2, 3, 4]
    assert suggest(index, "nickname", "..", names, "id", "nickname").count() == 0
    with pytest.raises(ValueError):
        suggest(index, "nickname", "", names, "id", "nickname")
    typed = spark.createDataFrame([(1, "ANN"), (2, "ber"), (3, "q")], "query_id int, query string")
    many = suggest_many(index, "nickname", typed, names, "id", "nickname").collect()
    assert [r["name"] for r in sorted((r for r in many if r["query_id"] == 1), key=lambda r: r["rank"])] == ranked
    assert [(r["query_id"], r["name"]) for r in many if r["query_id"] != 1] == [(2, "Bert")]


def test_facets(spark):
    df = spark.createDataFrame(
        [("b x b", "1970-01-02"), ("b", "1970-01-02"), ("a", None), (None, "1969-12-31")], "t string, d string")
    assert [tuple(r) for r in facet_values(df, "t").collect()] == [("a", 1), ("b", 1), ("b x b", 1)]
    assert [tuple(r) for r in facet_tokens(df, "t", 2).collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in facet_dates(df, "d").collect()] == [(86_400_000, 2), (-86_400_000, 1)]


def test_requests(spark):
    columns = "n int, field string, query string, distance string, lat string, lon string, l string, s string, w string"
    df = spark.createDataFrame([
        (0, None, "Hello", None, None, None, None, None, None), (1, "city", "", "", "", "", "", "", ""),
        (2, "", "x", "5", "1.5", "2", "10", "20", "true"), (3, "", "", "5", "", "2", "", "", ""),
        (4, "", "", "5", "1", "east", "", "", ""), (5, "city", "x", "", "", "", "ten", "-1", "true"),
        (6, "city", "x", "", "q", "q", "7", "", "true")], columns)
    rows = {r["n"]: r for r in normalise(df).collect()}
    assert (rows[0]["field"], rows[0]["query"], rows[0]["size"], rows[0]["skip"], rows[0]["mode"]) == (
        "everything", "hello", 100, 0, "match")
    assert rows[1]["reason"] == "query_and_distance_empty" and rows[1]["mode"] is None
    assert (rows[2]["mode"], rows[2]["distance_km"], rows[2]["lat"], rows[2]["lon"], rows[2]["size"]) == (
        "geo", 5.0, 1.5, 2.0, 10)
    assert [rows[n]["reason"] for n in (3, 4, 5, 6)] == ["bad_lat", "bad_lon", "negative_page", None]
    assert rows[6]["mode"] == "clauses" and rows[6]["lat"] is None


def test_labels(spark):
    df = spark.createDataFrame([("/api//Users/",), ("",), ("/",), ("a-b",), ("_x_",)], "p string")
    assert [r[0] for r in df.select(path_label(F.col("p"))).collect()] == ["api_users", "root", "root", "a_b", "x"]
    df = spark.createDataFrame([("r", "f", "a"), ("", "f", "a"), (None, "", "a"), (None, None, "")],
                               "r string, f string, a string")
    assert [r[0] for r in df.select(client_label(F.col("r"), F.col("f"), F.col("a"))).collect()] == ["r", "f", "a", ""]


def test_counters_and_histogram(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 3.0), ("a", 99.0), ("b", None)], "path string, took double")
    counts = {r["label"]: (r["ok"], r["err"]) for r in labelled_counts(df, "path", F.col("took") < 50).collect()}
    assert counts == {"a": (2, 1), "b": (0, 1)}
    rows = duration_histogram(df, ["path"], F.col("took")).collect()
    buckets = {r["le"]: r["bucket_count"] for r in rows}
    assert buckets["0.005"] == 1 and buckets["2.5"] == 1 and buckets["5"] == 2 and buckets["+Inf"] == 3
    assert {r["path"] for r in rows} == {"a"} and rows[0]["total_seconds"] == pytest.approx(102.005)
