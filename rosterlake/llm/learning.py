"""Bounded samples of labelled documents that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import column


PARTS = 256  # groups of tasks whose rows are cut together before a label is cut as a whole


def chosen_rows(rows: DataFrame, per_label: int, most: int) -> DataFrame:
    """``rows`` (doc_id, label) with up to ``per_label`` ids of every label and ``most`` in all, by a hash of the id.

    A window keeps only its first rows per task before anything is moved. Tasks are cut in groups first, so that
    neither cut brings the rows of all tasks together; which group a row is in does not change what is chosen.
    """
    hashed = rows.select("doc_id", "label", F.xxhash64("doc_id").alias("h"),
                         F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"))
    of_part = Window.partitionBy("label", "part").orderBy("h", "doc_id")
    first = hashed.withColumn("at", F.row_number().over(of_part)).where(F.col("at") <= per_label)
    of_label = Window.partitionBy("label").orderBy("h", "doc_id")
    ranked = first.withColumn("at", F.row_number().over(of_label)).where(F.col("at") <= per_label)
    return ranked.orderBy("at", "h", "label").limit(most).select("doc_id", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_label: int,
                    longest: int, id_column: str = "doc_id", text_column: str = "text") -> list[tuple[str, int]]:
    """Texts and labels (0 or 1) of at most ``per_label`` labelled documents of each label, for fitting on the driver.

    ``learn`` selects the ids to learn from. Texts of more than ``longest`` characters are left out of the fit
    (never of scoring), which bounds the sample by 2 * per_label * longest characters. Rows with a null id, text or
    label are not learned from.
    """
    known = labels.select(column("doc_id").alias("doc_id"), column(label).cast("int").alias("label")).where(
        "doc_id is not null and label in (0, 1)").where(learn)
    ids = chosen_rows(known, 2 * per_label, 4 * per_label)
    texts = docs.select(column(id_column).alias("doc_id"), column(text_column).alias("text")).where(
        F.length("text").between(1, longest))
    at = Window.partitionBy("label").orderBy("h", "doc_id", "text")
    joined = texts.join(F.broadcast(ids), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    ranked = joined.withColumn("at", F.row_number().over(at)).where(F.col("at") <= per_label)
    return [(r.text, r.label) for r in ranked.select("text", "label").orderBy("at", "label").collect()]


def label_counts(labels: DataFrame, label: str, learn: Column) -> tuple[int, int]:
    """How many labelled ids to learn from there are of label 0 and of label 1."""
    found = dict(labels.where(learn & column(label).isin(0, 1)).groupBy(column(label).cast("int").alias("label"))
                 .count().collect())
    return found.get(0, 0), found.get(1, 0)
