"""Quality scores learnt from preferences: a Bradley-Terry model over text measures.

A text is described by ``MEASURES`` numbers: shares of byte classes, of
neighbouring classes, and of word forms. A labelled good text is preferred to
a bad one; the model's weights minimise the logistic loss of the differences of
the pairs' standardised measures. It reads a bounded sample, ``MAX_PER_CLASS``
texts of each label and ``RIVALS`` pairs per text. The raw score of every text
is then compared with ``QUANTILES`` quantiles of the raw scores of all texts,
and the quantile that agrees best with all labels is the threshold; the
reported score maps it to ``THRESHOLD``.

Nulls: a null or empty text has the measures 0 and a score like others; a null
label or a null id is no preference; an id labelled twice counts as good if
either label is 1. Without labels of both kinds every score is the share of
good labels (0.5 without labels). Repeated rows are scored alike. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import saved
from paywarden.llm.text_arrays import BLANK_BYTES, FOLDED, slices, words_in
from paywarden.llm.toxicity import class_share, training_rows

MAX_PER_CLASS = 3000
RIVALS = 6
RIDGE = 1e-3
NEWTON_STEPS = 12
QUANTILES = 400
THRESHOLD = 0.7

# Byte classes: lower, upper, digit, blank, line feed, sentence mark, other mark, non-ASCII.
CLASSES = 8
_CLASS = np.full(256, 6, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], _CLASS[0x0A] = 3, 4
_CLASS[[*b".,;:!?'\"()-"]] = 5
_FORMS = 8
MEASURES = CLASSES + CLASSES * CLASSES + _FORMS


def measures(texts: pa.Array) -> np.ndarray:
    """One row of ``MEASURES`` numbers for each text."""
    rows = np.zeros((len(texts), MEASURES))
    for first, end, data, offsets in slices(texts):
        n = end - first
        owner = np.repeat(np.arange(n), np.diff(offsets))
        kind = _CLASS[data]
        single = np.bincount(owner * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
        inner = owner[1:] == owner[:-1]
        pair = (owner[1:] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
        double = np.bincount(pair[inner], minlength=n * CLASSES * CLASSES).reshape(n, -1)
        length = np.maximum(np.diff(offsets), 1)[:, None]
        words = words_in(data, offsets, BLANK_BYTES, FOLDED)
        count = np.maximum(words.counts, 1)
        size = words.ends - words.starts
        starts, ends = kind[words.starts], kind[words.ends - 1]
        order = np.lexsort((words.hashes, words.owner))
        again = (words.hashes[order][1:] == words.hashes[order][:-1]) & (
            words.owner[order][1:] == words.owner[order][:-1]
        )

        def share(mask: np.ndarray, who: np.ndarray = words.owner, n: int = n, count: np.ndarray = count) -> np.ndarray:
            return np.bincount(who, mask, n) / count

        forms = [
            share(size),
            share(size * size) ** 0.5,
            share(starts == 1),
            share(ends == 6),
            share(ends == 5),
            share(size == 1),
            share(again, words.owner[order][1:]),
            np.log1p(words.counts) / 10,
        ]
        rows[first:end] = np.hstack([single / length, double / length, np.array(forms).T])
    return rows


@dataclass
class Ranking:
    """Weights of the measures after standardising; raw score is their sum."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.center) / self.scale, -8, 8) @ self.weights


def fit_pairs(differences: np.ndarray) -> np.ndarray:
    """Weights that make ``differences`` positive, by Newton steps on the logistic loss."""
    weights = np.zeros(differences.shape[1])
    ridge = RIDGE * len(differences)
    for _ in range(NEWTON_STEPS):
        lost = 1.0 / (1.0 + np.exp(np.clip(differences @ weights, -35, 35)))
        gradient = ridge * weights - differences.T @ lost
        curve = (differences * (lost * (1 - lost))[:, None]).T @ differences
        weights -= np.linalg.solve(curve + ridge * np.eye(len(weights)), gradient)
    return weights


def fit_ranking(rows: np.ndarray, good: np.ndarray) -> Ranking:
    """A ranking from measures and labels, each text of the rarer label against ``RIVALS`` others."""
    center, scale = rows.mean(0), np.maximum(rows.std(0), 1e-9)
    ranking = Ranking(center, scale, np.zeros(rows.shape[1]))
    standard = np.clip((rows - center) / scale, -8, 8)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    pairs = RIVALS * max(len(better), len(worse))
    random = np.random.default_rng(3)
    chosen = standard[better[random.integers(len(better), size=pairs)]] - standard[worse[random.integers(len(worse), size=pairs)]]
    ranking.weights = fit_pairs(chosen)
    return ranking


def train(examples: DataFrame) -> Ranking | None:
    """A ranking from rows of ``label`` and ``text``; None unless both labels occur."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.array(measures(batch.column("text")).ravel())
            bounds = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(bounds, flat)], ["label", "measures"]
            )

    # Bounded by the sample: 2 * MAX_PER_CLASS rows of MEASURES numbers.
    table = examples.select("label", "text").mapInArrow(measured, "label double, measures array<double>").toArrow()
    good = table.column("label").to_numpy() == 1.0
    if not table.num_rows or good.all() or not good.any():
        return None
    rows = table.column("measures").combine_chunks().values.to_numpy().reshape(-1, MEASURES)
    # Rows come in no fixed order; a sorted matrix makes the fit repeatable.
    order = np.lexsort((rows[:, 0], rows[:, 3], rows[:, -1], good))
    return fit_ranking(rows[order], good[order])


def raw_scores(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``doc_id`` and ``raw`` of every row."""
    given = docs.select("doc_id", "text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = pa.array(ranking.raw(measures(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), raw], ["doc_id", "raw"])

    return given.mapInArrow(scored, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, raw double")


def best_threshold(raw: DataFrame, labels: DataFrame) -> float:
    """The quantile of all raw scores that best separates the labels, both labels weighing the same.

    Labels are counted per quantile bin, so two numbers per bin reach the
    driver. If several quantiles are equally good, the middle one is taken.
    """
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    cuts = sorted(set(raw.select(F.percentile_approx("raw", shares, 10 * QUANTILES)).first()[0]))
    named = labels.select("doc_id", F.col("quality").alias("label")).dropna()
    single = named.groupBy("doc_id").agg(F.max("label").alias("label"))
    bin_of = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col("raw")))
    counts = raw.join(single, "doc_id").groupBy(bin_of.alias("bin"), "label").count().collect()
    table = np.zeros((2, len(cuts) + 1))
    for row in counts:
        table[int(row["label"] == 1), row["bin"]] += row["count"]
    if not table.sum(1).all():
        return cuts[len(cuts) // 2]
    # With cut i as the threshold, bins up to i are rejected.
    right = np.cumsum(table[0])[:-1] / table[0].sum() + 1 - np.cumsum(table[1])[:-1] / table[1].sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return cuts[int(best[len(best) // 2])]


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``score`` of each row of ``docs``, trained on ``labels`` (``doc_id``, ``quality``)."""
    ranking = train(training_rows(docs, labels, "quality", MAX_PER_CLASS))
    if ranking is None:
        return docs.select("doc_id").withColumn("score", F.lit(class_share(labels, "quality")))
    raw = saved(raw_scores(docs, ranking), "quality-raw")
    if raw.isEmpty():
        return raw.withColumnRenamed("raw", "score")
    cut = best_threshold(raw, labels)
    level = F.lit(float(np.log(THRESHOLD / (1 - THRESHOLD))))
    score = 1 / (1 + F.exp(-(F.col("raw") - F.lit(cut) + level)))
    # At the cut itself rounding must not move the score below the threshold.
    above = F.greatest(score, F.lit(THRESHOLD))
    below = F.least(score, F.lit(float(np.nextafter(THRESHOLD, 0))))
    return raw.select("doc_id", F.when(F.col("raw") >= cut, above).otherwise(below).alias("score"))
