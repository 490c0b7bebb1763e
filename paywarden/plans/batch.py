"""Batch form of the message flow, for a closed period of raw messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.operators.dedup import earliest_per_minute
from paywarden.operators.validate import process_messages, valid_payments
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake
from paywarden.streaming.jobs import (
    INVALID,
    STAGED,
    VALID,
    dead_letter_records,
    replace_minutes,
    staged_messages,
)


def deduplicated_payments(messages: DataFrame, as_of: Column | str) -> DataFrame:
    """Valid payments, once per id and publish minute, with their ``window``; nothing is written."""
    return earliest_per_minute(valid_payments(process_messages(messages, as_of)))


def process_period(
    spark: SparkSession, messages: DataFrame, lake: Lake, period: str, as_of: Column | str, run_ts: Column
) -> None:
    """Write bronze, alerts, metrics and dead letters of one period of messages.

    The parsed messages are written once, split by route, and each output reads
    its own route. Running the same period again replaces
    all of it, also with fewer rows or none.
    """
    staged_path = f"{lake.staging_path}-period={period}"
    staged_messages(messages, as_of).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route").parquet(staged_path)
    staged = spark.read.schema(STAGED).parquet(staged_path)

    rejected = staged.filter(F.col("route") == INVALID)
    valid = staged.filter(F.col("route") == VALID)
    letters = {tables.DEAD_LETTERS: dead_letter_records(rejected)}
    replace_minutes(spark, lake, valid, f"period-{period}", run_ts, letters)
