"""Request bodies that hold a JSON array of profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.barrier import computed
from ..functions.wire import checked, one_value, outer_trim, parse


def split_bodies(bodies: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """One row per profile of every acceptable body, and the refused bodies with a reason.

    A body is refused as a whole when it is not one JSON array (white space may surround it) or when one
    element is malformed. A null
    element counts as an empty profile. Other columns of ``bodies`` are kept on both sides.
    """
    text = F.col(body)
    kept = [c for c in bodies.columns if c != body]
    parts = computed(
        bodies, F.when(outer_trim(text).startswith("[") & one_value(text), F.from_json(text, "array<string>")).alias("_parts"))
    raw = computed(parts, F.transform("_parts", lambda x: F.struct(
        F.coalesce(x, F.lit("{}")).alias("text"), parse(F.coalesce(x, F.lit("{}")), "ignore").alias("raw"))
    ).alias("_raw"))
    opened = computed(
        raw, F.transform("_raw", lambda r: checked(r["raw"], r["text"])).alias("_records"),
        keep=[*bodies.columns, "_parts"],
    ).withColumn(
        "reason",
        F.when(F.col("_parts").isNull(), F.lit("not_an_array"))
        .when(F.exists("_records", lambda r: r.isNull()), F.lit("malformed_element")),
    )
    good = (
        opened.where(F.col("reason").isNull())
        .select(*kept, F.explode("_records").alias("_record"))
        .select(*kept, "_record.*")
    )
    bad = opened.where(F.col("reason").isNotNull()).select(*kept, body, "reason")
    return good, bad


def received_by_client(profiles: DataFrame, refused: DataFrame, client: str = "client") -> DataFrame:
    """Profiles received and bodies refused, per client label."""
    counted = (
        profiles.select(F.col(client).alias("client"), F.lit(1).alias("ok"), F.lit(0).alias("err"))
        .unionByName(refused.select(F.col(client).alias("client"), F.lit(0).alias("ok"),
                                    F.lit(1).alias("err")))
    )
    return counted.groupBy("client").agg(
        F.sum("ok").alias("received"), F.sum("err").alias("received_err")
    )
