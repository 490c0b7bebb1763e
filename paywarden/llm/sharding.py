"""Stable shards by jump consistent hashing, with gapless numbers inside each shard.

The hash walks a chain of shard numbers that only the key decides; the last
number below the shard count is the shard. With one more shard, a row stays
or moves into the new shard. There is no table of the ring, so nothing is
joined or sent around to place a row.

Nulls: a null key is placed like the text ``\\N``. A null text has 0 bytes and
the checksum of the empty text. Rows with equal keys share a shard. An empty
table gives an empty result. Other columns are kept; input columns named
like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.positions import numbered
from paywarden.llm.storage import hex_number

KEY_DIGITS = 15
NULL_KEY = "\\N"

# Fixed value: the multiplier of the published generator,
# 2862933555777941757, in 16-bit parts from the lowest.
MULTIPLIER = (0xB0FD, 0x87B0, 0x2EE6, 0x27BB)


def key_number(key: Column) -> Column:
    """A 60-bit number of a key's text."""
    return hex_number(F.coalesce(key.cast("string"), F.lit(NULL_KEY)), KEY_DIGITS)


def _low(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def _advance(high: Column, low: Column) -> tuple[Column, Column]:
    """``state * MULTIPLIER + 1`` modulo 2^64 on 32-bit halves; no product leaves 48 bits."""
    m0, m1, m2, m3 = (F.lit(m).cast("bigint") for m in MULTIPLIER)
    bottom = low * m0 + F.shiftleft(_low(low * m1, 16), 16) + F.lit(1)
    top = (
        F.shiftright(bottom, 32)
        + F.shiftright(low * m1, 16)
        + low * m2
        + F.shiftleft(_low(low * m3, 16), 16)
        + high * m0
        + F.shiftleft(_low(high * m1, 16), 16)
    )
    return _low(top, 32), _low(bottom, 32)


def jump_shards(number: Column, shards: int) -> Column:
    """Struct of the shard among ``shards`` and the shard among ``shards + 1``.

    Each step of the chain moves up by one shard at least, so ``shards + 1``
    steps always reach its end; most keys stop after a few.
    """
    limit = shards + 1

    def step(state: Column, _: Column) -> Column:
        high, low = _advance(state["high"], state["low"])
        ahead = (state["jump"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))
        moved = F.struct(
            high.alias("high"),
            low.alias("low"),
            F.least(F.floor(ahead), F.lit(limit).cast("bigint")).alias("jump"),
            state["jump"].alias("at"),
            state["at"].alias("before"),
        )
        return F.when(state["jump"] < limit, moved).otherwise(state)

    start = F.struct(
        F.shiftright(number, 32).alias("high"),
        _low(number, 32).alias("low"),
        F.lit(0).cast("bigint").alias("jump"),
        F.lit(-1).cast("bigint").alias("at"),
        F.lit(-1).cast("bigint").alias("before"),
    )

    def read(state: Column) -> Column:
        last, before = state["at"], state["before"]
        return F.struct(
            F.when(last == shards, before).otherwise(last).cast("int").alias("shard"),
            last.cast("int").alias("grown_shard"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(limit)), start, step, read)


def assign_shards(docs: DataFrame, key: str = "doc_id", shards: int = 24) -> DataFrame:
    """Add ``key_number``, ``shard`` and ``grown_shard`` (with one more shard) to each row."""
    placed = docs.withColumn("key_number", key_number(F.col(key)))
    placed = placed.withColumn("_jump", jump_shards(F.col("key_number"), shards))
    return (
        placed.withColumn("shard", F.col("_jump.shard"))
        .withColumn("grown_shard", F.col("_jump.grown_shard"))
        .drop("_jump")
    )


def number_slots(placed: DataFrame, ties: list[str]) -> DataFrame:
    """Add ``slot``, the row's rank in its shard by key number and ``ties``, from 0 without gaps.

    Rows are dealt out by ranges of that order, not by key, so a key that holds
    a third of all rows spreads over many tasks; rows equal in all of it are
    told apart by their place in the table. Only one row per range and shard is
    summed up. The ranges are cut by a sample of the order's columns, so
    ``ties`` are short columns. ``placed`` reads a written table and has no
    columns ``position`` and ``total`` and none that begins with an underscore.
    """
    ranked = numbered(placed, [F.col(name) for name in ("key_number", *ties)], "shard")
    return ranked.withColumn("slot", F.col("position")).drop("position", "total")
