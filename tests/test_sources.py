import pytest
from pyspark.sql import functions as F

from rosterlake.schema import DATABASE_COLUMNS
from rosterlake.sources import arrays, database, delimited, load_profiles, messages
from rosterlake.sources.rejects import rejects_by_reason

GOOD = ["1", "16.5", "51.1", "a@b", "70000", "180", "nick", "5", "City", "hello", "2", "1990-01-02"]


def line(**changes):
    names = ["pnum", "lon", "lat", "email", "weight", "height", "nickname", "country", "city", "caption",
             "gender", "dob"]
    row = dict(zip(names, GOOD))
    row.update(changes)
    return "|".join(row.values())


def read(spark, tmp_path, *lines, **options):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "users.csv").write_text("\n".join(lines), encoding="utf-8")
    return delimited.read_profiles(spark, str(tmp_path / "in"), **options)


def test_a_good_line(spark, tmp_path):
    good, bad = read(spark, tmp_path, line(), "", line(pnum="2", lon="0"))
    rows = good.orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2] and bad.count() == 0
    assert rows[0]["location"].lon == 16.5 and rows[0]["weight"] == 70000 and rows[0]["dob"] == "1990-01-02"
    assert [r["suspect_location"] for r in rows] == [False, True]


@pytest.mark.parametrize("change,reason", [
    ({"pnum": "x"}, "bad_pnum"), ({"lon": ""}, "bad_lon"), ({"lat": "1.0d"}, "bad_lat"),
    ({"weight": " 5 "}, "bad_weight"), ({"height": "5.0"}, "bad_height"), ({"country": ""}, "bad_country"),
    ({"gender": "99999999999"}, "bad_gender"), ({"pnum": "x", "gender": "y"}, "bad_pnum"),
    ({"lat": "q", "weight": "w"}, "bad_lat"), ({"caption": "a|b"}, "wrong_field_count"),
    ({"caption": '"open'}, "wrong_field_count"),
])
def test_the_first_fault_names_the_reject(spark, tmp_path, change, reason):
    good, bad = read(spark, tmp_path, line(**change), line())
    assert [r["reason"] for r in bad.collect()] == [reason]
    assert good.count() == 1


def test_eleven_and_thirteen_fields(spark, tmp_path):
    _, bad = read(spark, tmp_path, line() + "|x", line().rsplit("|", 1)[0], line())
    assert [(r["reason"], r["rejects"]) for r in rejects_by_reason(bad).collect()] == [("wrong_field_count", 2)]
    assert bad.where(F.col("line") == line() + "|x").count() == 1


@pytest.mark.parametrize("written,value", [
    ('"a|b"', "a|b"), ('"say ""hi"""', 'say "hi"'), ('it"s', 'it"s'), ('""', ""), ("", ""), ('"ab"cd"', 'ab"cd'),
])
def test_lazy_quotes(spark, tmp_path, written, value):
    good, _ = read(spark, tmp_path, line(caption=written))
    assert good.first()["caption"] == value


def test_strict_width_stops_the_job(spark, tmp_path):
    good, _ = read(spark, tmp_path, line(), line() + "|x", strict_width=True)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        good.collect()


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown profile source"):
        load_profiles(spark, "ftp")


def test_json_source(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1}\nnope\n')
    good, dead = load_profiles(spark, "json", path=str(tmp_path))
    assert [r["id"] for r in good.collect()] == [1] and [r["value"] for r in dead.collect()] == ["nope"]


def test_jdbc_options_read_named_columns_in_ranges():
    options = database.jdbc_options("jdbc:x", "members", lower_bound=0, upper_bound=100, num_partitions=4)
    assert options["dbtable"] == f"(select {', '.join(DATABASE_COLUMNS)} from members) profiles"
    assert "email" not in options["dbtable"] and options["partitionColumn"] == "pnum"
    with pytest.raises(ValueError):
        database.jdbc_options("jdbc:x", "members", lower_bound=0)


def test_database_rows_are_capped_before_they_are_checked(spark):
    rows = spark.range(10).select(
        F.col("id").alias("pnum"), *[F.lit(None).cast("string").alias(c) for c in ("dob", "nickname", "city", "caption")],
        *[F.lit(None).cast("int").alias(c) for c in ("weight", "height", "gender")],
        F.when(F.col("id") != 2, F.lit(1)).alias("country"),
        F.when(F.col("id") != 3, F.lit(1.0)).alias("longitude"), F.lit(2.0).alias("latitude"))
    typed = database.type_rows(database.first_rows(rows, 5))
    assert sorted(r["id"] for r in typed.where("reason is null").collect()) == [0, 1, 4]
    assert typed.where("reason is not null").count() == 2


def test_bodies(spark):
    bodies = spark.createDataFrame([
        ("a", '[{"id":1},{"id":2,"city":"x"}]'), ("b", '{"id":1}'), ("c", '[{"id":1},{"id":"x"}]'),
        ("d", "[]"), ("e", "nope"), ("a", ' [{"id":3,"unknown":1}]'), ("g", "[1]"), ("h", '[{"city":5}]'),
    ], "client string, body string")
    good, bad = arrays.split_bodies(bodies)
    assert sorted((r["client"], r["id"]) for r in good.collect()) == [("a", 1), ("a", 2), ("a", 3)]
    assert {r["client"]: r["reason"] for r in bad.collect()} == {
        "b": "not_an_array", "c": "malformed_element", "e": "not_an_array", "g": "malformed_element",
        "h": "malformed_element"}
    counts = {r["client"]: (r["received"], r["received_err"]) for r in arrays.received_by_client(good, bad).collect()}
    assert counts["a"] == (3, 0) and counts["b"] == (0, 1) and "d" not in counts


def test_publishing_to_a_folder(spark, tmp_path):
    people = spark.createDataFrame([(1, "x", 0)], "id bigint, city string, country int")
    messages.publish_to_folder(messages.to_messages(people), str(tmp_path / "topic"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "topic")).collect()] == ['{"id":1,"city":"x"}']
    assert messages.kafka_options("b:9092", "users")["kafka.retries"] == "10"


def test_database_rows_are_all_taken_unless_a_cap_is_named(spark):
    rows = spark.createDataFrame([(None,), (5,), (None,), (3,)], "pnum bigint")
    assert database.first_rows(rows).count() == 4 and database.rows_cut(rows, None) == 0
    assert [r["pnum"] for r in database.first_rows(rows, 2).collect()] == [3, 5] and database.rows_cut(rows, 2) == 2
