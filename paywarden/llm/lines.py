"""Lines of a text as columns, and marking the lines that stand in a table of removals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import small

BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lines_of(text: Column) -> Column:
    """The lines between line feeds; a null text has none."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def normalised(line: Column) -> Column:
    """A-Z in lower case, runs of blanks as one space, none at the ends."""
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(lower, BLANK, " "), F.lit(" "))


def with_line_hashes(rows: DataFrame, text: str) -> DataFrame:
    """Add ``lines``, ``hashes`` with a 64-bit hash per line, null for a blank line, and ``text_hash``."""

    def hashed(line: Column) -> Column:
        return let(normalised(line), lambda n: F.when(n != "", F.xxhash64(n)))

    listed = rows.withColumn("lines", lines_of(F.col(text)))
    return listed.withColumn("hashes", F.transform("lines", hashed)).withColumn("text_hash", F.xxhash64(text))


def different_lines(hashes: str) -> Column:
    """The hashes of the lines that are not blank, each once."""
    return F.array_distinct(F.filter(hashes, lambda h: h.isNotNull()))


def rows_per_line(rows: DataFrame, group: str) -> DataFrame:
    """``group``, ``hash`` and ``n``: the rows of the group that hold the line.

    A row counts once for each different line. The counts are combined before
    the shuffle, so a line that most rows share costs one row per task.
    """
    return (
        rows.select(group, F.explode(different_lines("hashes")).alias("hash"))
        .groupBy(group, "hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def with_removed_lines(rows: DataFrame, results: DataFrame, group: str, key: str, removals: DataFrame) -> DataFrame:
    """Add ``removed`` to ``results``: the positions (from 0) of each row's lines that ``removals`` lists.

    ``rows`` has group, key, ``text_hash`` and ``hashes``; ``results`` has key,
    ``text_hash`` and whatever else is to be kept, so the caller decides what
    the join shuffles. ``removals`` is a written table of ``group`` and
    ``hash``. Rows are told apart by key and text hash; repeated rows agree on
    their lines. Of ``rows``, only matched positions are shuffled.
    """
    listed = removals.select(F.col(group).alias("_group"), F.col("hash").alias("_hash"))
    row = [F.col(key).alias("_key"), F.col("text_hash").alias("_text")]
    placed = rows.select(*row, group, F.posexplode("hashes").alias("_pos", "_line")).where("_line is not null")
    same = (F.col("_line") == F.col("_hash")) & F.col(group).eqNullSafe(F.col("_group"))
    found = (
        placed.join(small(listed), same)
        .groupBy("_key", "_text")
        .agg(F.collect_set("_pos").alias("removed"))
    )
    here = F.col(key).eqNullSafe(F.col("_key")) & (F.col("text_hash") == F.col("_text"))
    none = F.array().cast("array<int>")
    return results.join(found, here, "left").withColumn("removed", F.coalesce("removed", none)).drop("_key", "_text")
