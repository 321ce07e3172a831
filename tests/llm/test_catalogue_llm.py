"""The registered queries: against SQL where they have it, else their columns and row counts."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from rosterlake.llm.graphs import stored
from rosterlake.llm.queries import oracles, runners
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
ROWS = {"op10_html_blocks": 50, "op3_voronoi_knn": 500}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(runners()))
def test_query(spark, tables, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    if name in oracles():
        verdict, _ = compare(name, df, tables, oracles()[name])
        assert verdict.startswith("ok"), verdict
    else:
        assert df.count() == ROWS.get(name, 200)


def test_the_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, FOLDER), "test-stage")
        assert after.dtypes == docs.dtypes, name
        assert 0 < after.count() <= 3 * docs.count()
        docs = after
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id, library.encode(r.text)) for r in docs.collect())
    got = __spark_entry__.queries()["pipeline"](spark, FOLDER)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == want
