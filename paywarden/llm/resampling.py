"""Importance resampling towards a target: hashed n-gram features, with lines counted once.

The features of a text are its runs of 1 to ``MAX_RUN`` words, hashed into
``BUCKETS`` buckets. A line feed separates words, so texts are cut at line
feeds into lines. Equal lines of all texts are brought together, each different
line's features are counted once and multiplied by its number of occurrences;
runs that cross a line end are counted by text and added. Both counts leave
a task as one number per bucket at most.

A document's weight is the sum of its features' gains, the logarithms of the
target's share over the corpus's share of their buckets. Its score adds noise
of a Gumbel distribution that only the id decides, so the highest scores are a
sample without replacement by weight.

Nulls: a null text has no words, no features and weight 0; a null id is hashed
as the text ``\\N``. Documents with too few words are scored but not drawn.
Ties go to the smaller id, null first, then to fewer features; equal rows take
one rank each. An empty target or corpus has equal shares in all buckets. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm.positions import numbered
from paywarden.llm.storage import saved
from paywarden.llm.text_arrays import FOLDED, NOT_ALNUM, slices, words_in

BUCKETS = 10_000
MAX_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1000
NULL_ID = "\\N"

# Longer words are rare and summed up one by one.
VECTOR_BYTES = 64


def _crc_steps() -> np.ndarray:
    """Checksum of each byte value alone, without conditioning."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, np.uint32(0xEDB88320) ^ (values >> 1), values >> 1)
    return values


STEPS = _crc_steps()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _shifts() -> np.ndarray:
    """Per number of zero bytes, byte of the checksum and its value: what it becomes after these bytes."""
    tables = np.empty((VECTOR_BYTES + 2, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, len(tables)):
        tables[n] = STEPS[tables[n - 1] & 255] ^ (tables[n - 1] >> 8)
    return tables


SHIFTS = _shifts()


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums moved on by as many bytes as ``by`` says; they are linear, so this joins texts."""
    crc, left = crc.copy(), by.copy()
    rest = np.arange(len(crc))
    while len(rest):
        step, now = np.minimum(left[rest], VECTOR_BYTES), crc[rest]
        crc[rest] = (
            SHIFTS[step, 0, now & 255]
            ^ SHIFTS[step, 1, (now >> 8) & 255]
            ^ SHIFTS[step, 2, (now >> 16) & 255]
            ^ SHIFTS[step, 3, now >> 24]
        )
        left[rest] -= step
        rest = rest[left[rest] > 0]
    return crc


def word_checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, byte by byte for all words at once."""
    order = np.argsort(-lengths, kind="stable")
    at, size = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    short = int(np.searchsorted(-size, -VECTOR_BYTES))  # the first word of that length or less
    counts = np.searchsorted(-size, -np.arange(1, VECTOR_BYTES + 1), "right")
    for k, end in enumerate(counts):
        if end <= short:
            break
        now = crc[short:end]
        crc[short:end] = STEPS[(now ^ data[at[short:end] + k]) & 255] ^ (now >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(short):
        crc[i] = zlib.crc32(data[at[i] : at[i] + size[i]].tobytes())
    out = np.empty(len(order), np.uint32)
    out[order] = crc
    return out


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Starts and texts of all words, and per run length the runs' first words and buckets."""
    words = words_in(data, offsets, NOT_ALNUM, FOLDED)
    owner, lengths = words.owner, words.ends - words.starts
    crc = word_checksums(LOWER[data], words.starts, lengths)
    after_blank = shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), lengths) ^ crc
    runs = [(np.arange(len(crc)), crc % BUCKETS)]
    first, run = np.arange(len(crc)), crc
    for size in range(2, MAX_RUN + 1):
        kept = np.flatnonzero(first + size - 1 < len(crc))
        kept = kept[owner[first[kept]] == owner[first[kept] + size - 1]]
        first, run = first[kept], run[kept]
        last = first + size - 1
        run = shifted(run, lengths[last] + 1) ^ after_blank[last]
        runs.append((first, run % BUCKETS))
    return words.starts, owner, runs


COUNTS = "bucket int, n long"


def _counted(totals: np.ndarray) -> pa.RecordBatch:
    found = np.flatnonzero(totals)
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(totals[found])], ["bucket", "n"])


def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of different lines, times their occurrences."""
    totals = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        times = batch.column("n").to_numpy(zero_copy_only=False)
        for first, _, data, offsets in slices(batch.column("line")):
            _, owner, runs = word_runs(data, offsets)
            for at, buckets in runs:
                np.add.at(totals, buckets, times[first + owner[at]])
    yield _counted(totals)


def count_crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features whose words stand in more than one line."""
    totals = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(batch.column("text")):
            starts, _, runs = word_runs(data, offsets)
            line = np.searchsorted(np.flatnonzero(data == 10), starts)
            for size, (at, buckets) in enumerate(runs[1:], 2):
                totals += np.bincount(buckets[line[at] != line[at + size - 1]], minlength=BUCKETS)
    yield _counted(totals)


def feature_counts(texts: DataFrame) -> DataFrame:
    """``bucket`` and ``n``: how often features of the column ``text`` fall into each bucket."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    different = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    inside = different.mapInArrow(count_lines, COUNTS)
    crossing = texts.select("text").mapInArrow(count_crossings, COUNTS)
    return inside.unionAll(crossing).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(spark: SparkSession, corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket, as many numbers as there are buckets."""
    found = saved(
        feature_counts(corpus).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionAll(
            feature_counts(target).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
        ),
        "features",
    )
    sums = found.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("corpus"), F.coalesce(F.sum("t"), F.lit(0)).alias("target")).first()
    zero = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    counts = found.unionAll(zero).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    share = ((F.col("t") + 1) * F.lit(float(sums["corpus"] + BUCKETS))) / ((F.col("s") + 1) * F.lit(float(sums["target"] + BUCKETS)))
    gains = np.zeros(BUCKETS, np.int64)
    for row in counts.select("bucket", F.floor(F.lit(SCALE) * F.ln(share)).alias("gain")).collect():
        gains[row["bucket"]] = row["gain"]
    return gains


def weigher(gains: np.ndarray):
    """A function for ``mapInArrow``: words, features and weight of each text."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column("text")):
                n = end - first
                _, owner, runs = word_runs(data, offsets)
                features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for at, buckets in runs:
                    features += np.bincount(owner[at], minlength=n)
                    np.add.at(weight, owner[at], gains[buckets])
                words = np.bincount(owner, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), *map(pa.array, (words, features, weight))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    return weigh


def gumbel(doc_id: Column) -> Column:
    """Noise in thousandths that only the id and the seed decide."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(NULL_ID)))
    number = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    share = (number + F.lit(0.5)) / F.lit(float(1 << 32))
    return F.floor(F.lit(-SCALE) * F.ln(-F.ln(share)))


def score_documents(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of each row, written."""
    spark = docs.sparkSession
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    gains = bucket_gains(spark, given, target.select(F.col("text").cast("string").alias("text")))
    id_type = given.schema["doc_id"].dataType.simpleString()
    weighed = given.mapInArrow(weigher(gains), f"doc_id {id_type}, n_words long, n_features long, weight long")
    return saved(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"))), "scores")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The scored rows with ``rank`` from 1 for the drawn ones: ``percent`` of those with ``min_words`` words."""
    scored = score_documents(docs, target)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features")]
    fit = numbered(scored.where(F.col("n_words") >= min_words), order)
    drawn = F.col("position") < F.floor(F.col("total") * percent / 100)
    ranked = fit.withColumn("rank", F.when(drawn, F.col("position") + 1)).drop("position", "total")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
