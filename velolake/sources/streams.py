"""Unbounded sources of event messages, as a column `value` of text or bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """One message per line of the files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def to_topic(messages: DataFrame) -> DataFrame:
    """Messages (key, value) in the columns that the Kafka sink takes: the key keeps a station's messages in order."""
    return messages.where(F.col("value").isNotNull()).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def message_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic; `value` holds bytes. Needs Spark's Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load().select("key", "value")
