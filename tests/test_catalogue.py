"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from rosterlake.queries import oracles, runners
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(runners()))
def test_query(spark, tables, name):
    df = runners()[name](spark, FOLDER)
    verdict, _ = compare(name, df, tables, oracles()[name])
    assert verdict.startswith("ok"), verdict


def test_the_entry_offers_every_query():
    assert set(runners()) <= set(__spark_entry__.queries())
    assert set(oracles()) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["doc_id", "score"]
