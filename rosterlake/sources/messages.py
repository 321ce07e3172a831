"""Message topics: publishing profiles and reading them back, from Kafka or from a folder.

The Kafka connector jar is not bundled; add ``spark-sql-kafka`` to the session to use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.wire import decode_messages, encode
from ..schema import PROFILE

PRODUCER_RETRIES = 10  # Fixed value.


def to_messages(profiles: DataFrame) -> DataFrame:
    """One ``value`` column of JSON text; no key, so records spread over all partitions."""
    return profiles.select(encode([c for c in PROFILE.fieldNames() if c in profiles.columns]).alias("value"))


def publish_to_folder(messages: DataFrame, path: str) -> None:
    """Append messages as text lines; a file stream over the folder reads them as a topic."""
    messages.select("value").write.mode("append").text(path)


def kafka_options(brokers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.retries": str(PRODUCER_RETRIES),
    }


def publish_to_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    messages.select("value").write.format("kafka").options(**kafka_options(brokers, topic)).save()


def _starting(from_start: bool) -> str:
    return "earliest" if from_start else "latest"


def subscribe(spark: SparkSession, brokers: str, topic: str, from_start: bool = True,
              max_per_trigger: int | None = None) -> DataFrame:
    """Streaming topic; progress is resumed from the query's checkpoint, not from a consumer group."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic).option("startingOffsets", _starting(from_start))
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def follow_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming lines of text files; ``timestamp`` is the arrival time of the file."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("timestamp")
    )


def read_json_profiles(spark: SparkSession, path: str,
                       unknown_fields: str = "ignore") -> tuple[DataFrame, DataFrame]:
    return decode_messages(spark.read.text(path), unknown_fields=unknown_fields)


def read_kafka_profiles(spark: SparkSession, brokers: str, topic: str,
                        unknown_fields: str = "ignore") -> tuple[DataFrame, DataFrame]:
    raw = (
        spark.read.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic).load()
        .select("value", "topic", "partition", "offset", "timestamp")
    )
    return decode_messages(raw, unknown_fields=unknown_fields)
