"""Connected components of links, by repeated minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.session import scratch


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read again, which also ends their lineage."""
    path = scratch(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links`` (a, b): the smallest node that it reaches.

    Every round takes the smallest label among neighbours, combined per task before it is moved, and then the label
    of that label, so paths halve from round to round.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        told = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("told")))
        lower = labels.join(told, F.col("node") == F.col("a"), "left").select(
            "node", "component", F.least("component", "told").alias("lower"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        step = stored(lower.join(jump, F.col("lower") == F.col("at"), "left").select(
            "node", F.least("lower", "beyond").alias("component"),
            (F.least("lower", "beyond") < F.col("component")).alias("changed")), "labels")
        labels = step.select("node", "component")
        if step.where("changed").isEmpty():
            return labels
