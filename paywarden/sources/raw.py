"""Where raw messages come from: a broker, files of messages, or dead letters to replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.operators.parse import decode_payload
from paywarden.schemas import DEAD_LETTER, RAW_STREAM


def stream_from_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of messages from a topic; needs Spark's Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return from_records(records)


def from_records(records: DataFrame) -> DataFrame:
    """Broker records ``(value binary, timestamp)`` to raw messages."""
    return decode_payload(records.select("value", F.col("timestamp").alias("publish_ts")))


def stream_from_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream of Parquet files with ``raw_message`` and ``publish_ts``."""
    return spark.readStream.schema(RAW_STREAM).options(**options).parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same files as a batch, to process a closed period again."""
    return spark.read.schema(RAW_STREAM).parquet(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead-letter records as written by the dead-letter sink."""
    return spark.read.schema(DEAD_LETTER).json(path).select(*DEAD_LETTER.fieldNames())


def replay_messages(dead_letters: DataFrame) -> DataFrame:
    """Dead letters back to raw messages; the receive time stands for the publish time."""
    return dead_letters.select("raw_message", F.col("received_ts").alias("publish_ts"))
