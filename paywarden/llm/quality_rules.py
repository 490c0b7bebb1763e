"""Quality rules for documents: word counts, repetition, and lines frequent across a host's documents.

A line, normalised and hashed, that stands in more than ``MAX_DOCUMENTS``
documents of one host is removed. A document that keeps less than
``MIN_KEPT_SHARE`` of its words is depleted and rejected, and so is one that
fails the base rules. The host of a document is its ``source``.

A document is an id, so a row that is repeated counts once, however often it
stands in the table. The texts are read once: measures and line hashes go to a
written table without texts, which counting and marking read.

Nulls: a null text has no words and fails; a null source is a host of its own;
rows with a null id are told apart by their texts. Repeated rows are decided
alike. An empty table gives an empty result. Other columns of the input are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.lines import different_lines, let, rows_per_line, with_line_hashes, with_removed_lines
from paywarden.llm.mixing import WORD
from paywarden.llm.storage import saved, small

MAX_DOCUMENTS = 100
MIN_KEPT_SHARE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words covered by a window of three words that occurs twice or more in ``words``.

    Most texts have no such window, which their different hashes tell. Else the
    windows are sorted by hash with their positions, so equal ones become
    neighbours: ``n log n`` steps for a text of any length.
    """

    def covered(windows: Column) -> Column:
        def start(window: Column, i: Column) -> Column:
            before = F.get(windows, i - 1)["hash"] == window["hash"]
            after = F.get(windows, i + 1)["hash"] == window["hash"]
            return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), window["at"])

        starts = F.filter(F.transform(windows, start), lambda at: at.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda at: F.array(at, at + 1, at + 2)))))

    def hashes(list_: Column) -> Column:
        firsts = F.slice(list_, 1, F.greatest(F.size(list_) - 2, F.lit(0)))
        return F.transform(firsts, lambda word, i: F.xxhash64(word, F.get(list_, i + 1), F.get(list_, i + 2)))

    def counted(hashed: Column) -> Column:
        placed = F.transform(hashed, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        unrepeated = F.size(F.array_distinct(hashed)) == F.size(hashed)
        return F.when(unrepeated, F.lit(0)).otherwise(let(F.sort_array(placed), covered))

    return let(words, lambda w: let(hashes(w), counted)).cast("bigint")


def document_measures(docs: DataFrame) -> DataFrame:
    """Add the base measures to each row that has ``text`` and ``lines``."""
    text = F.coalesce("text", F.lit(""))
    worded = F.filter("lines", lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    return (
        docs.withColumn("_words", words_of(F.col("text")))
        .withColumn("n_words", F.size("_words").cast("bigint"))
        .withColumn("word_chars", F.length(F.translate(text, BLANKS, "")).cast("bigint"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"))
        .withColumn("n_dup_lines", let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
        .withColumn("n_repeat_words", repeated_words(F.col("_words")))
        .drop("_words")
    )


def frequent_lines(measured: DataFrame, max_documents: int) -> DataFrame:
    """``source`` and ``hash`` of the lines in more documents than the limit, as a written table.

    No line stands in more documents than rows, so only lines in as many rows
    are counted by document.
    """
    in_rows = rows_per_line(measured, "source").where(F.col("n") > max_documents).select("source", "hash")
    often = saved(in_rows, "repeated-lines").select(F.col("source").alias("_source"), F.col("hash").alias("_hash"))
    without_id = F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("anonymous")
    placed = measured.select("source", "doc_id", without_id, F.explode(different_lines("hashes")).alias("hash"))
    same = (F.col("hash") == F.col("_hash")) & F.col("source").eqNullSafe(F.col("_source"))
    documents = placed.join(small(often), same).select("source", "hash", "doc_id", "anonymous").distinct()
    counted = documents.groupBy("source", "hash").agg(F.count(F.lit(1)).alias("n"))
    return saved(counted.where(F.col("n") > max_documents).select("source", "hash"), "frequent-lines")


def judge_documents(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_kept_share: float = MIN_KEPT_SHARE
) -> DataFrame:
    """``doc_id``, the measures, ``n_removed_lines``, ``kept_words``, ``base_failed`` and ``kept`` of each document."""
    lined = with_line_hashes(docs.select("doc_id", "source", "text"), "text")
    line_words = F.transform("lines", lambda line: F.size(words_of(line)))
    measures = document_measures(lined).withColumn("line_words", line_words).drop("text", "lines")
    measured = saved(measures, "line-measures")
    removals = frequent_lines(measured, max_documents)
    judged = with_removed_lines(measured, measured.drop("hashes", "source"), "source", "doc_id", removals)
    gone = F.aggregate(
        "removed", F.lit(0).cast("bigint"), lambda total, at: total + F.get(F.col("line_words"), at)
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    kept_words = F.col("n_words") - F.col("gone")
    return judged.withColumn("gone", gone).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.size("removed").cast("bigint").alias("n_removed_lines"),
        kept_words.alias("kept_words"),
        failed.alias("base_failed"),
        (~failed & (kept_words >= F.col("n_words") * min_kept_share)).alias("kept"),
    )
