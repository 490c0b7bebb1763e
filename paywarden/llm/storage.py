"""Tables that cut lineage, and joins that broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.session import shared_dir

# Rows of a few numbers each: some tens of megabytes at most.
BROADCAST_ROWS = 1_000_000


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What is built on the result starts from the files, so a lost executor
    repeats only its own tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written narrow table, marked for broadcast if its counted rows are within ``limit``.

    Beyond the limit the join shuffles; the rows of the result are the same.
    """
    return F.broadcast(df) if df.count() <= limit else df


def hex_number(text: Column, digits: int) -> Column:
    """The first ``digits`` (15 at most) hexadecimal digits of the MD5 of ``text`` as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")
