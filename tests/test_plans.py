"""The shape of physical plans, and whole jobs."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from rosterlake.functions.wire import decode_messages
from rosterlake.operators.around import within_radius
from rosterlake.operators.facets import facet_values
from rosterlake.operators.fields import match_date
from rosterlake.operators.latest import latest_by_key
from rosterlake.operators.scoring import page, page_per_query
from rosterlake.operators.clauses import NODES, as_nodes
from rosterlake.operators.search import Fuzzy, Prefix, Word, all_of, match, match_many, none_of, phrase, search
from rosterlake.operators.textindex import TextIndex
from rosterlake.plans import indexing
from rosterlake.plans.feed import run_feed
from rosterlake.plans.indexing import StoredIndex
from rosterlake.plans.parts import PartTable
from rosterlake.plans.profiles import ProfileTable
from rosterlake.plans.service import ProfileSearch, text_fields
from rosterlake.schema import PROFILE
from rosterlake.session import scratch, shared_dir
from rosterlake.sources import messages
from rosterlake.streaming.counts import tumbling_counts

PEOPLE = [
    (i, f"user{i}@test.com", f"19{50 + i % 40}-0{1 + i % 9}-01", 50000 + i, 150 + i % 40, f"Nick {i}", i % 5,
     ["Gdansk", "New York", "York"][i % 3], "hello there" if i % 2 else "greetings !", (float(i % 50), float(i % 40)),
     1 + i % 2)
    for i in range(1, 121)
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    table = ProfileTable(spark, str(root / "profiles"), buckets=8)
    people = spark.createDataFrame(PEOPLE, PROFILE)
    table.upsert(people.select("*", F.lit(None).cast("timestamp").alias("_ts"), F.lit(0).alias("_partition"),
                               F.lit(0).cast("bigint").alias("_offset")))
    table.compact()
    index = StoredIndex(spark, str(root / "index"), "id", text_fields(), buckets=8)
    index.build(table.read())
    prefixes = TextIndex.over_prefixes(table.read(), "id", {"nickname": F.col("nickname")})
    return ProfileSearch(table.with_buckets(), index.open(), prefixes, buckets=8)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_search_requests(stored):
    rows, total = stored.users(field="city", query="YORK", size=10, skip=5)
    york = [p[0] for p in PEOPLE if p[7] == "York"] + [p[0] for p in PEOPLE if p[7] == "New York"]
    assert ids(rows) == york[5:15] and total.first()["total"] == len(york)
    first = rows.first()
    assert first["score"] > 0 and first["email"].startswith("user") and isinstance(first["dob"], datetime.date)
    rows, total = stored.users(query="user7 greetings", size=3)
    assert ids(rows)[0] == 7 or total.first()["total"] > 3
    rows, _ = stored.users(field="gender", query="2", size=200)
    assert sorted(ids(rows)) == [p[0] for p in PEOPLE if p[10] == 2]
    rows, _ = stored.users(field="dob", query="1951", size=200)
    assert sorted(ids(rows)) == [p[0] for p in PEOPLE if p[2].startswith("1951")]
    rows, _ = stored.users(field="city", query="ignored", distance="10", lat="10", lon="10")
    assert ids(rows) == [10]
    rows, _ = stored.users(field="city", query="yo", clause=Prefix("gda"), size=500)
    assert sorted(ids(rows)) == [p[0] for p in PEOPLE if p[7] == "Gdansk"]


def test_a_table_of_requests_equals_single_ones(spark, stored):
    columns = ["field", "query", "distance", "lat", "lon", "l", "s", "w"]
    asked = {
        1: ("city", "York new", "", "", "", "7", "3", ""), 2: ("", "user7 greetings", "", "", "", "", "", ""),
        3: ("gender", "2", "", "", "", "500", "10", ""), 4: ("dob", "1951", "", "", "", "", "", ""),
        5: ("dob", "1952-03", "", "", "", "", "", ""), 6: ("", "", "700", "10", "10", "5", "2", ""),
        7: ("id", "77", "", "", "", "", "", ""), 8: ("nickname", "nick", "", "", "", "0", "", ""),
        9: ("gender", "male", "", "", "", "", "", ""), 10: ("dob", "spring", "", "", "", "", "", ""),
        11: ("shoe", "x", "", "", "", "", "", ""), 12: ("", "", "", "", "", "", "", ""),
        13: ("height", "160", "", "", "", "", "", ""),
    }
    table = spark.createDataFrame(
        [(q, *r) for q, r in asked.items()], "query_id int, " + ", ".join(f"{c} string" for c in columns))
    pages, refused = stored.answer_many(table)
    assert {r["query_id"]: r["reason"] for r in refused.collect()} == {
        9: "not_a_number", 10: "not_a_date", 11: "unknown_field", 12: "query_and_distance_empty"}
    got = {}
    for r in pages.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    for q in (1, 2, 3, 4, 5, 6, 7, 8, 13):
        field, query, distance, lat, lon, size, skip, _ = asked[q]
        size, skip = int(size or 100), int(skip or 0)
        rows, _ = stored.users(field=field, query=query, distance=distance, lat=lat, lon=lon, size=size, skip=skip)
        want = [(skip + n + 1, r["id"], r["score"]) for n, r in enumerate(rows.collect())]
        assert sorted(got.get(q, [])) == want, q
    assert len(got[1]) == 7 and len(got[6]) == 5 and got[7][0][1] == 77 and 8 not in got


def test_no_request_spoils_the_others(spark, stored):
    columns = ["field", "query", "distance", "lat", "lon", "l", "s", "w"]
    odd = {
        1: ("", "", "inf", "1", "1", "", "", ""), 2: ("", "", "nan", "1", "1", "", "", ""),
        3: ("", "", "-5", "1", "1", "", "", ""), 4: ("", "", "5", "95", "1", "", "", ""),
        5: ("", "", "5", "nan", "1", "", "", ""), 6: ("", "", "5", "1", "1e12", "", "", ""),
        7: ("dob", "1951-99", "", "", "", "", "", ""), 8: ("city", "york", "", "", "", "", "", "true"),
        9: ("city", "york", "", "", "", "2147483647", "10", ""), 10: ("city", "york", "", "", "", "3", "", ""),
        11: ("city", "york", "", "", "", "5", "1000000", ""), 12: ("", "", "1e12", "10", "10", "7", "", ""),
        13: ("", "", "3000", "90", "180", "", "", ""),
    }
    table = spark.createDataFrame(
        [(q, *r) for q, r in odd.items()], "query_id int, " + ", ".join(f"{c} string" for c in columns))
    pages, refused = stored.answer_many(table)
    assert {r["query_id"]: r["reason"] for r in refused.collect()} == {
        1: "bad_distance", 2: "bad_distance", 3: "bad_distance", 4: "bad_lat", 5: "bad_lat", 6: "bad_lon",
        7: "not_a_date", 8: "clauses_not_supported"}
    got = {}
    for r in pages.collect():
        got.setdefault(r["query_id"], []).append(r["rank"])
    york = sum(p[7] != "Gdansk" for p in PEOPLE)
    assert sorted(got[9]) == list(range(11, york + 1)) and sorted(got[10]) == [1, 2, 3] and sorted(got[12]) == list(range(1, 8))
    assert 11 not in got
    for q in range(1, 8):
        field, query, distance, lat, lon, *_ = odd[q]
        with pytest.raises(ValueError):
            stored.users(field=field, query=query, distance=distance, lat=lat, lon=lon)


def test_refused_requests(stored):
    for request in ({}, {"distance": "5", "lat": "x", "lon": "1"}, {"field": "gender", "query": "male"},
                    {"field": "shoe", "query": "x"}, {"query": "x", "size": -1}):
        with pytest.raises(ValueError):
            stored.users(**request)
    with pytest.raises(ValueError):
        stored.aggregations("")


def test_suggestions_and_facets(stored):
    assert stored.nicks("ni 12").orderBy("rank").first()["name"] == "Nick 12"
    top = stored.aggregations("city").collect()
    assert {r["key"] for r in top} == {"Gdansk", "New York", "York"} and top[0]["count"] == 40
    assert stored.aggregations("city", by_token=True).first()["key"] == "york"
    assert isinstance(stored.aggregations("dob").first()["key"], int)


def test_a_page_reads_only_the_buckets_it_needs(stored):
    rows, _ = stored.users(field="city", query="york", size=3)
    plan = plan_of(rows)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_a_stored_search_prunes_buckets_and_pushes_words_down(stored):
    plan = plan_of(page(match(stored.index, "city", "new york"), 10))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("bucket" in s.split("PartitionFilters")[1] for s in scans)
    assert all("In(term" in s for s in scans) and all("positions" not in s for s in scans)
    assert plan.count("Exchange hashpartitioning") == 1 and "TakeOrderedAndProject" in plan


def scans_of(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


def partition_filters(scan):
    return scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_stored_prefix_reads_a_range_of_terms_and_their_buckets(stored):
    plan = plan_of(search(stored.index, "city", Prefix("yo")))
    terms = [s for s in scans_of(plan) if "StringStartsWith(term" in s]
    postings = [s for s in scans_of(plan) if "tf" in s.split("ReadSchema")[1] or "doc_id" in s.split("ReadSchema")[1]]
    assert terms and all("bucket" in partition_filters(s) for s in terms)
    assert postings and all("dynamicpruning" in partition_filters(s) for s in postings)


def test_an_upsert_deals_the_rows_of_a_file_before_it_sorts_them(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(PartTable, "append", lambda self, rows, *args, **kw: plans.append(plan_of(rows)))
    one = spark.createDataFrame(PEOPLE, PROFILE).coalesce(1).select("*", F.lit(None).cast("timestamp").alias("_ts"),
                                                                    F.lit(0).alias("_partition"), F.lit(0).cast("bigint").alias("_offset"))
    ProfileTable(spark, str(tmp_path / "p"), buckets=2).upsert(one)
    lines = plans[0].splitlines()
    moves = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    sorts = [i for i, line in enumerate(lines) if "Sort " in line or "SortAggregate" in line]
    # The plan's last lines come first: rows are dealt by id and version, reduced and sorted then, and moved by id alone.
    assert len(moves) == 2 and "REPARTITION_BY_COL" in lines[moves[1]] and sorts and max(sorts) < moves[1]


def test_similar_words_are_joined_by_deletions_and_not_scanned(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE)
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", {"city": F.col("city")}, buckets=8, similar=True)
    index.build(people)
    found = search(index.open(), "city", Fuzzy("yrok", 2))
    scans = scans_of(plan_of(found))
    # Variants by the buckets of the word's deletions, terms and postings by those of the words found.
    assert scans and all("bucket" in partition_filters(s) for s in scans)
    assert sorted(r["doc_id"] for r in found.collect()) == [p[0] for p in PEOPLE if "York" in p[7]]
    index.refresh(people.where("id = 3").withColumn("city", F.lit("Yorrk")))
    assert 3 in {r["doc_id"] for r in search(index.open(), "city", Fuzzy("yorrkk", 1)).collect()}
    index.refresh(people.where("id = 3").withColumn("city", F.lit("Rome")))
    assert search(index.open(), "city", Fuzzy("yorrkk", 1)).count() == 0




def test_searches_stay_in_the_engine_without_cross_joins(spark, stored):
    table = spark.createDataFrame([(1, "york")], "query_id int, query string")
    many = page_per_query(match_many(stored.index, "city", table), 10)
    plan = plan_of(many)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    for df in (many, decode_messages(spark.createDataFrame([("{}",)], "value string"))[0]):
        plan = plan_of(df)
        assert not any(s in plan for s in ("Python", "NestedLoop", "Cartesian"))


def test_an_index_build_moves_documents_not_postings(spark):
    docs = spark.range(10).select("id", F.lit("a b").alias("text")).repartition(F.col("id"))
    plan = plan_of(TextIndex.over(docs, "id", {"text": F.col("text")}).postings)
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan


def test_words_are_filtered_before_they_are_counted(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "id bigint, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    index = TextIndex.over(docs, "id", {"text": F.col("text")})
    lines = plan_of(match(index, "text", "a")).splitlines()
    below = [i for i, line in enumerate(lines) if "Filter" in line and "term" in line]
    exchange = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(field" in line]
    assert below and exchange and max(below) > max(exchange)


def test_aggregations_combine_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.current_timestamp().alias("ts"))
    for result in (facet_values(df, "k"), tumbling_counts(df, "ts", "k"), latest_by_key(df, ["k"], ["v"])):
        assert "partial_" in plan_of(result)
    assert "TakeOrderedAndProject" in plan_of(facet_values(df, "k"))


def test_field_and_geo_filters_reach_the_scan(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE).withColumn("dob", F.to_date("dob"))
    people.select("id", "dob", "location").write.parquet(str(tmp_path / "p"))
    read = spark.read.parquet(str(tmp_path / "p"))
    assert "GreaterThanOrEqual(dob" in plan_of(match_date(read, "dob", "1960"))
    plan = plan_of(within_radius(read, 10, 10, 50).select("id"))
    assert "GreaterThanOrEqual(location.lat" in plan and "Python" not in plan


def test_a_feed_reads_once_and_counts(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE).withColumn(
        "reason", F.when(F.col("id") % 10 == 0, F.lit("bad")))
    summary = run_feed(people, lambda m: messages.publish_to_folder(m, str(tmp_path / "topic")), "csv", "users",
                       metrics_path=str(tmp_path / "metrics"))
    values = {r["metric"]: r["value"] for r in summary.collect()}
    assert (values["read_total"], values["read_total_err"], values["sent_total"], values["sent_total_err"]) == (
        108, 12, 108, 0)
    assert values["feed_duration_seconds"] > 0
    assert spark.read.text(str(tmp_path / "topic")).count() == 108
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 6


def test_a_failed_feed_is_recorded(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE).withColumn("reason", F.lit(None).cast("string"))

    def broken(_):
        raise OSError("no broker")

    with pytest.raises(OSError):
        run_feed(people, broken, "csv", "users", metrics_path=str(tmp_path / "metrics"))
    values = {r["metric"]: r["value"] for r in spark.read.parquet(str(tmp_path / "metrics")).collect()}
    assert values["sent_total"] == 0 and values["sent_total_err"] == 120


def test_the_shared_folder_is_the_one_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_a_table_of_requests_reads_only_the_buckets_of_its_words(spark, stored):
    asked = spark.createDataFrame([(1, "york"), (2, "york york")], "query_id int, query string")
    found = match_many(stored.index, "city", asked)
    scans = [line for line in plan_of(found).splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("bucket" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)
    assert found.where("query_id = 2").count() == sum(p[7] != "Gdansk" for p in PEOPLE)
    assert match_many(stored.index, "city", asked.limit(0)).count() == 0


def files_of(root):
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_a_refresh_rewrites_nothing(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE)
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", {"city": F.col("city")}, buckets=8, merge_after=3)
    index.build(people)
    before = files_of(tmp_path)
    index.refresh(people.where("id = 3").withColumn("city", F.lit("Rome York")))
    after = files_of(tmp_path)
    assert before.items() <= after.items()
    rows = spark.read.parquet(*[p for p in after if p not in before and "/postings/" in p]).collect()
    assert {(r["term"], r["tf"]) for r in rows} == {("rome", 1), ("york", 1), ("gdansk", 0)}
    assert {r["doc_id"] for r in match(index.open(), "city", "rome").collect()} == {3}
    for n, city in enumerate(("Oslo", "Gdansk", "Bergen York", "York")):
        index.refresh(people.where(f"id in (3, {40 + n})").withColumn("city", F.lit(city)))
    cities = {p[0]: p[7] for p in PEOPLE} | {40: "Oslo", 41: "Gdansk", 42: "Bergen York", 43: "York", 3: "York"}
    assert any(not t.state(s)["base"].startswith("part=base.all") for t in index.tables.values() for s in range(t.shares))
    rebuilt = StoredIndex(spark, str(tmp_path / "again"), "id", {"city": F.col("city")}, buckets=4)
    rebuilt.build(spark.createDataFrame(list(cities.items()), "id bigint, city string"))
    for words in ("york new", "oslo gdansk bergen rome"):
        got, want = (sorted(tuple(r) for r in match(i.open(), "city", words).collect()) for i in (index, rebuilt))
        assert got == want
    statistics = [sorted(tuple(r) for r in i.open().term_stats.select("term", "df").collect()) for i in (index, rebuilt)]
    assert statistics[0] == statistics[1] and index.open().known == rebuilt.open().known


def test_a_refresh_deals_its_documents_and_matches_no_single_words(spark, tmp_path):
    people = spark.createDataFrame([(i, f"old{i} both york") for i in range(9)] + [(None, "nobody")], "id bigint, city string")
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", {"city": F.col("city")}, buckets=2, merge_after=2)
    index.build(people)
    asked, plans, documents, write = [], [], index._documents, index._write
    index._documents = lambda docs: asked.append(plan_of(docs)) or documents(docs)
    index._write = lambda name, rows, n: plans.append(plan_of(rows)) or write(name, rows, n)
    # An id with two rows keeps the words of both.
    again = [(1, "new york"), (1, "new both"), (2, "both york"), (None, "somebody")]
    index.refresh(spark.createDataFrame(again, "id bigint, city string").coalesce(1), people.where("id = 3"))
    assert not any("term" in line for line in plans[0].splitlines() if "Join" in line)
    assert all("InMemoryTableScan" in p for p in plans)
    rows = spark.read.parquet(str(tmp_path / "ix" / "postings" / "part=change.refresh.000000000001")).where("tf = 0")
    assert sorted((r["doc_id"], r["term"]) for r in rows.collect()) == [(1, "old1"), (2, "old2"), (3, "both"), (3, "old3"), (3, "york")]
    for _ in range(2):
        index.refresh(spark.createDataFrame([(4, "bergen york")], "id bigint, city string"))
    assert "hashpartitioning(id" in asked[1]
    assert sorted(r["doc_id"] for r in match(index.open(), "city", "york").collect()) == [0, 1, 2, 4, 5, 6, 7, 8]
    assert sorted(r["doc_id"] for r in match(index.open(), "city", "old4 old5").collect()) == [5]


def test_a_refresh_that_was_broken_off_does_not_count(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE[:9], PROFILE)
    index = StoredIndex(spark, str(tmp_path / "ix"), "id", {"city": F.col("city")}, buckets=2)
    index.build(people)
    write = index._write
    index._write = lambda name, *rest: write(name, *rest) if name != "stats" else 1 / 0
    with pytest.raises(ZeroDivisionError):
        index.refresh(people.where("id = 1").withColumn("city", F.lit("Oslo")))
    assert match(index.open(), "city", "oslo").count() == 0 and index.open().known["city"][0] == 9
    index._write = write
    index.refresh(people.where("id = 2").withColumn("city", F.lit("Bergen")))
    assert match(index.open(), "city", "oslo").count() == 0 and match(index.open(), "city", "bergen").count() == 1


def test_stored_suggestions_read_the_buckets_of_what_was_typed(spark, tmp_path):
    people = spark.createDataFrame(PEOPLE, PROFILE)
    stored = StoredIndex.of_prefixes(spark, str(tmp_path / "px"), "id", {"nickname": F.col("nickname")}, buckets=8)
    stored.build(people)
    index, computed = stored.open(), TextIndex.over_prefixes(people, "id", {"nickname": F.col("nickname")})
    assert index.known["nickname"][1] == pytest.approx(computed.field_stats.first()["avg_dl"])
    searching = [ProfileSearch(people, None, i) for i in (index, computed)]
    for typed in ("ni 12", "NICK", "1", "zz", "--"):
        got, want = (sorted(tuple(r) for r in s.nicks(typed).collect()) for s in searching)
        assert got == want, typed
    plan = plan_of(match(index, "nickname", "ni 12"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("bucket" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)
    stored.refresh(people.where("id = 12").withColumn("nickname", F.lit("Zara")))
    assert [r["name"] for r in searching[0].nicks("zar").collect()] == []  # opened before the refresh
    after = ProfileSearch(people.withColumn("nickname", F.when(F.col("id") == 12, "Zara").otherwise(F.col("nickname"))), None, stored.open())
    assert [r["name"] for r in after.nicks("zar").collect()] == ["Zara"] and after.nicks("12").count() == 1
    scans = [line for line in plan_of(match(stored.open(), "nickname", "zar")).splitlines() if "FileScan" in line]
    assert scans and all("bucket" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)


def test_wildcard_requests_bring_their_clauses(spark, stored):
    trees = {1: all_of(Word("york"), none_of(Word("new"))), 2: Prefix("gda"), 3: phrase("new york"), 4: none_of(Word("york"))}
    rows = [(n, "city", "york", "50", "true", as_nodes(t)) for n, t in trees.items()]
    rows += [(5, "city", "york", "50", "", None), (6, "city", "york", "50", "true", None), (7, "nickname", "x", "3", "true", as_nodes(Prefix("ni")))]
    requests = spark.createDataFrame(rows, f"query_id int, field string, query string, l string, w string, clause {NODES}")
    requests = requests.selectExpr("*", "'' distance", "'' lat", "'' lon", "'' s")
    pages, refused = stored.answer_many(requests)
    assert {r["query_id"]: r["reason"] for r in refused.collect()} == {4: "clause_without_words", 6: "no_clause"}
    got = {}
    for r in pages.orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    for n, tree in {**trees, 5: None}.items():
        if n != 4:
            page_, _ = stored.users(field="city", query="york", size=50, clause=tree)
            assert got[n] == [(r["id"], r["score"]) for r in page_.collect()], n
    assert len(got[7]) == 3


def test_pages_after_a_known_row_and_deep_pages(stored, monkeypatch):
    whole = [(r["id"], r["score"]) for r in stored.users(field="city", query="york", size=200)[0].collect()]
    monkeypatch.setattr("rosterlake.plans.service.DEEP", 5)
    rows, total = stored.users(field="city", query="york", size=7, skip=20)
    assert [(r["id"], r["score"]) for r in rows.collect()] == whole[20:27] and total.first()["total"] == len(whole)
    rows, _ = stored.users(field="city", query="york", size=7, after=(whole[19][1], whole[19][0]))
    assert [(r["id"], r["score"]) for r in rows.collect()] == whole[20:27]
    rows, _ = stored.users(field="gender", query="2", size=4, skip=30)
    assert [r["id"] for r in rows.collect()] == [p[0] for p in PEOPLE if p[10] == 2][30:34]


def test_postings_for_a_table_of_requests_move_by_document_not_the_pairs(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"a b{i % 3}") for i in range(30)], "id bigint, text string")
    stored = StoredIndex(spark, str(tmp_path / "ix"), "id", {"text": F.col("text")}, buckets=4)
    stored.build(docs)
    requests = spark.createDataFrame([(q, f"a b{q}") for q in range(3)], "query_id int, query string")
    hits = match_many(stored.open(), "text", requests)
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", re.sub(r"#\d+L?", "", plan_of(hits)))
    assert any(m.startswith("doc_id,") for m in moved) and not any("query_id, doc_id" in m for m in moved)
    assert hits.count() == 90


def test_dealt_documents_write_their_postings_where_they_are(spark, tmp_path, monkeypatch):
    words = ["york", "new", "gdansk", "oslo", "rome", "lima"]
    rows = [(i, " ".join(words[(i * k) % 6] for k in range(1, 30))) for i in range(200)]
    people = spark.createDataFrame(rows, "id bigint, city string")
    monkeypatch.setattr(indexing, "LEAST_CHARS", 1 << 10)
    moved, hint = [], type(people).hint
    monkeypatch.setattr(type(people), "hint", lambda df, name, *by: moved.append(df.columns) or hint(df, name, *by))
    few = StoredIndex(spark, str(tmp_path / "few"), "id", {"city": F.col("city")}, buckets=2)
    few.build(people)
    few.refresh(people.where("id < 20").withColumn("city", F.concat("city", F.lit(" bergen"))), people.where("id = 30"))
    # Neither postings nor the words of documents are moved to buckets; every task writes its own file of a bucket.
    assert not any({"positions", "terms"} & set(columns) for columns in moved)
    files = [p for p in files_of(tmp_path) if "/postings/part=base" in p and "bucket=0" in p and p.endswith(".parquet")]
    assert len(files) > 2
    many = StoredIndex(spark, str(tmp_path / "many"), "id", {"city": F.col("city")}, buckets=indexing.TASK_BUCKETS + 1)
    many.build(spark.createDataFrame([(i, t + " bergen" * (i < 20)) for i, t in rows if i != 30], "id bigint, city string"))
    assert any("positions" in columns for columns in moved)
    for asked in ("york new", "bergen lima", "rome"):
        got, want = (sorted(tuple(r) for r in match(i.open(), "city", asked).collect()) for i in (few, many))
        assert got == want and got
