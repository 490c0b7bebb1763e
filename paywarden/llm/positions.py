"""Positions of rows in a total order, counted by ranges of it and never in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.storage import saved, small

# A generated id holds the partition above this bit and the row's place in it below.
PLACE_BITS = 33


def numbered(rows: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """Add ``position`` from 0 in ``order`` (inside each value of ``group``) and ``total``, the rows counted.

    ``rows`` is a written table with ``group`` not null and no column whose name
    starts with an underscore. Its rows are dealt out by ranges, so a large
    group spreads over many tasks; rows that are equal in the order are told
    apart by their place in the table, so many of them spread, too. Only one
    row per range and group is summed up for the offsets.
    """
    keys = [group] if group else []
    marked = rows.withColumn("_copy", F.monotonically_increasing_id())
    ordering = [*map(F.col, keys), *order, F.col("_copy")]
    dealt = marked.repartitionByRange(*ordering).sortWithinPartitions(*ordering).drop("_copy")
    placed = saved(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", PLACE_BITS))
    ranges = placed.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *keys,
        "_range",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("total"),
    )
    return (
        placed.join(small(saved(offsets, "offsets")), [*keys, "_range"])
        .withColumn("position", F.col("_at") + F.col("_shift"))
        .drop("_at", "_range", "_shift")
    )
