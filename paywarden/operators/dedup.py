"""The two de-duplications: earliest per minute in the stream, latest per id in silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = "60 seconds"
ALLOWED_LATENESS = "300 seconds"


def earliest_per_minute(rows: DataFrame) -> DataFrame:
    """Per publish minute and ``transaction_id`` the row with the earliest ``transaction_ts``.

    Runs on a batch or, with a watermark on ``publish_ts``, on a stream. The
    minimum over a struct is combined before the shuffle, so a repeated id
    sends one row per task. Ties go to the first published row, then to the
    smallest remaining columns.
    """
    ordering = ["transaction_ts", "publish_ts"]
    rest = [name for name in rows.columns if name not in ordering and name != "transaction_id"]
    return (
        rows.groupBy(F.window("publish_ts", WINDOW).alias("window"), "transaction_id")
        .agg(F.min(F.struct(*ordering, *rest)).alias("first"))
        .select("window", "transaction_id", "first.*")
    )


def latest_per_id(rows: DataFrame) -> DataFrame:
    """Per ``transaction_id`` the row with the latest ``transaction_ts``.

    Spark limits each id to its first row before the shuffle as well as after
    it. Ties go to the latest ``processing_ts``, then to the largest remaining
    columns; these are listed one by one, as a struct of them would be shuffled
    next to the row.
    """
    ordering = ["transaction_ts", "processing_ts"]
    rest = [name for name in rows.columns if name not in ordering and name != "transaction_id"]
    newest_first = Window.partitionBy("transaction_id").orderBy(
        *[F.col(name).desc() for name in ordering + rest]
    )
    return (
        rows.withColumn("_position", F.row_number().over(newest_first))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )
