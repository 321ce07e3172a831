"""From documents to training tokens: quality rules, near duplicates, personal data, source mixture, pieces.

Every stage takes the documents its predecessor kept and returns a table with the columns of documents; the last
returns the encoded mixture. ``run`` writes each stage to the shared folder and reads it again for the next, so a
lost executor costs one stage's work and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.llm import jaccard_join, mixing, pieces, pii_context, quality_rules
from rosterlake.llm.graphs import stored
from rosterlake.llm.queries import piece_model, table


def keep_sound(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return jaccard_join.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii_context.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.emit(mixing.mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and a digest of the text that the ids decode to."""
    encoded = pieces.encode(docs, piece_model()).select("doc_id", "ids")
    return pieces.decode(encoded, piece_model()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", keep_sound),
    ("n-gram jaccard join", keep_one_of_each),
    ("personal data", mask_personal_data),
    ("source mixture", mix_sources),
    ("piece encoding", encode_pieces),
]

#: The encoding of the last stage is not expressible in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{at}")
    return docs
