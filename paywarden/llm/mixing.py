"""Mixing sources to target weights.

Words are counted per source, the targets divided by the words give each
source's repetition rate, and a document is emitted ``floor(rate)`` times plus
once more if a number hashed from seed and id falls below the fraction.

Sources are ordered by code point with null last and weigh 5, 2, 1, repeating.
Together they get as many words as there are; a target stops at three times
its source's words and the excess goes to the others by weight.

Nulls: a null text has no words, a null source is a source of its own, a row
with a null id is drawn by its text. Repeated rows are decided alike, as the
number depends on the id, or else the text, alone. A source without words has the target 0 and
its documents are not taken. An empty table gives an empty result. Other columns are kept;
input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.storage import hex_number, saved, small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
UNIFORM_DIGITS = 13
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) decided by seed and key, or the text where the key is null."""
    unnamed = F.concat(F.lit("\\N:"), F.md5(F.coalesce(text, F.lit(""))))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), unnamed))
    return hex_number(text, UNIFORM_DIGITS) / F.lit(float(16**UNIFORM_DIGITS))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    The windows run over one row per source. With the sources sorted by cap
    over weight and the first ``i`` at their caps, the others share the rest at
    a common level; the true level is the largest of these, and a target is
    the level times the weight unless the cap is lower.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    capped = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST_REPEATS)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def left(total: str, used: str) -> Column:
        return F.sum(total).over(everything) - F.coalesce(F.sum(used).over(before), F.lit(0))

    levels = capped.withColumn("level", left("source_size", "cap") / left("weight", "weight"))
    level = F.max("level").over(everything)
    return levels.select(
        "source",
        "source_size",
        F.least(level * F.col("weight"), F.col("cap").cast("double")).alias("target"),
    )


def plan_mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to each document.

    Only the table of sources is joined, so a source with a third of all
    documents is never gathered.
    """
    sized = docs.withColumn("size", word_count(F.col("text")))
    targets = saved(source_targets(sized.select("source", "size")), "mix-targets")
    targets = small(targets.withColumnRenamed("source", "_source"))
    clear = sized.drop("source_size", "target", "copies", "_source")
    joined = clear.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    more = (uniform(F.col("doc_id"), F.col("text"), seed) < rate - F.floor(rate)).cast("bigint")
    return joined.withColumn("copies", F.when(F.col("size") > 0, F.floor(rate) + more).otherwise(F.lit(0).cast("bigint")))


def emit_mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))
    planned = plan_mix(rows, seed).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return planned.select("_row", copies.alias("_copy")).select("_row.*")
