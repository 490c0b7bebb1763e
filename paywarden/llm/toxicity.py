"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its different words (letters and digits), word pairs, and pairs with one or
two words between them, A-Z in lower case, hashed to ``FEATURE_BITS`` bits.
Training keeps per-coordinate rates, and L1 leaves few weights. It reads a
bounded sample of labelled rows, ``MAX_PER_CLASS`` of each class at most,
picked by a hash of the id; one task makes ``ROUNDS`` passes over its features.
Scoring reads every text whole and sends only the non-zero weights around.

Nulls: a null or empty text has no features and gets the score of the bias; a
null label or a null id trains nothing; an id labelled twice counts as 1 if
either label is 1. Repeated rows are scored alike. With no labelled row of
some class all scores are the share of the other (0.5 with no labels at all).
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from paywarden.llm.storage import saved
from paywarden.llm.text_arrays import NOT_ALNUM, FOLDED, Words, mixed, slices, words_in

FEATURE_BITS = 26
MAX_PER_CLASS = 4000
MIN_TEXTS = 4
ROUNDS = 6
ALPHA, BETA, L1, L2 = 0.6, 1.0, 16.0, 1.0
# The rarer class weighs more, up to this factor.
MAX_CLASS_WEIGHT = 8.0
THRESHOLD = 0.7
# Kinds of features: offset of the second word, 0 for a single word.
GAPS = (0, 1, 2, 3)


@dataclass
class Weights:
    """Sorted feature numbers, their weights, and the bias."""

    features: np.ndarray
    values: np.ndarray
    bias: float


def features_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a slice and the text of each, repeats included."""
    owner = words.owner
    numbers, owners = [], []
    for gap in GAPS:
        n = max(len(words.hashes) - gap, 0)
        pair = words.hashes[:n] * np.uint64(2 * gap + 3)
        if gap:
            pair = mixed(pair + words.hashes[gap:])
        same = owner[:n] == owner[gap:]
        numbers.append((pair[same] >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        owners.append(owner[:n][same])
    return np.concatenate(numbers), np.concatenate(owners)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id``, ``label`` and the different features of each text."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column("text")):
            words = words_in(data, offsets, NOT_ALNUM, FOLDED)
            numbers, owners = features_of(words)
            keys = np.unique(owners << FEATURE_BITS | numbers)
            counts = np.bincount(keys >> FEATURE_BITS, minlength=end - first)
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(bounds), pa.array((keys & ((1 << FEATURE_BITS) - 1)).astype(np.int32)))
            given = [batch.column(c).slice(first, end - first) for c in ("doc_id", "label")]
            yield pa.RecordBatch.from_arrays([*given, listed], ["doc_id", "label", "features"])


@dataclass
class State:
    """FTRL state of the known features; the bias is the last coordinate."""

    z: np.ndarray
    n: np.ndarray

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Weights of some coordinates: zero while the state stays within L1."""
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, label: float, at: np.ndarray, importance: float) -> None:
        """Learn from one text with the coordinates ``at``; each has a rate of its own."""
        weight, n = self.weights(at), self.n[at]
        gradient = (1.0 / (1.0 + np.exp(-np.clip(weight.sum(), -35, 35))) - label) * importance
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weight
        self.n[at] = grown


def coordinates(known: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Positions of the known ones among ``features``, and the bias."""
    at = np.searchsorted(known, features)
    at = at[known[np.minimum(at, len(known) - 1)] == features] if len(known) else at[:0]
    return np.append(at, len(known))


def fit(known: int, rows: list[tuple[float, np.ndarray]]) -> State:
    """``ROUNDS`` passes over the rows, each in another order."""
    state = State(np.zeros(known + 1), np.zeros(known + 1))
    random = np.random.default_rng(5)
    ones = sum(label for label, _ in rows)
    odds = (len(rows) - ones) / max(ones, 1)
    importance = {1.0: min(max(odds, 1.0), MAX_CLASS_WEIGHT), 0.0: min(max(1 / max(odds, 1e-9), 1.0), MAX_CLASS_WEIGHT)}
    for _ in range(ROUNDS):
        for i in random.permutation(len(rows)):
            label, at = rows[i]
            state.update(label, at, importance[label])
    return state


def known_coordinates(known: Broadcast):
    """A function for ``mapInArrow`` that replaces the features of each text by coordinates of the known ones."""

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                features = batch.column("features")[row].values.to_numpy()
                listed = pa.array([coordinates(known.value, features).astype(np.int32)], pa.list_(pa.int32()))
                given = [batch.column(c).slice(row, 1) for c in ("doc_id", "label")]
                yield pa.RecordBatch.from_arrays([*given, listed], ["doc_id", "label", "features"])

    return replaced


def fit_group(known: int):
    """A function for ``applyInArrow`` that fits on the sample: the non-zero weights by coordinate."""

    def fitted(table):
        listed = table.column("features").combine_chunks()
        bounds, values = listed.offsets.to_numpy(), listed.values.to_numpy()
        labels, ids = table.column("label").to_numpy(), table.column("doc_id").to_numpy(zero_copy_only=False)
        # Tasks may bring the rows in any order; sorted by id the fit is repeatable.
        rows = [(labels[i], values[bounds[i] : bounds[i + 1]]) for i in np.argsort(ids, kind="stable")]
        weights = fit(known, rows).weights()
        at = np.flatnonzero(weights)
        return pa.table({"at": at, "weight": weights[at]})

    return fitted


def train(examples: DataFrame) -> Weights | None:
    """Weights from a bounded sample of ``doc_id``, ``label`` and ``text``; None unless both classes occur."""
    spark = examples.sparkSession
    schema = StructType(
        [examples.schema["doc_id"], StructField("label", DoubleType()), StructField("features", ArrayType(IntegerType()))]
    )
    prepared = saved(examples.select("doc_id", "label", "text").mapInArrow(feature_rows, schema), "toxicity-features")
    if prepared.select("label").distinct().count() < 2:
        return None
    frequent = (
        prepared.select(F.explode("features").alias("f")).groupBy("f").count().where(F.col("count") >= MIN_TEXTS)
    )
    # Bounded by the sample: a feature needs MIN_TEXTS of at most 2 * MAX_PER_CLASS texts.
    known = np.sort(frequent.select("f").toArrow().column("f").to_numpy())
    shared = spark.sparkContext.broadcast(known)
    # One group, because FTRL is sequential; its size is bounded by the sample.
    placed = prepared.mapInArrow(known_coordinates(shared), schema)
    grouped = placed.withColumn("sample", F.lit(0)).groupBy("sample")
    fitted = grouped.applyInArrow(fit_group(len(known)), "at long, weight double").toArrow()
    at, values = fitted.column("at").to_numpy(), fitted.column("weight").to_numpy()
    words = at < len(known)
    return Weights(known[at[words]], values[words], float(values[~words].sum()))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int = MAX_PER_CLASS) -> DataFrame:
    """``doc_id``, ``label`` and ``text`` of a bounded sample of ``labels``, picked by a hash of the id."""
    named = labels.select("doc_id", F.col(label).cast("double").alias("label")).dropna()
    single = named.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    picked = [single.where(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0.0, 1.0)]
    bounded = picked[0].unionByName(picked[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(bounded), "doc_id")
    # Rows that repeat an id beyond the sample's bound would train several times.
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def text_scores(texts: pa.Array, weights: Weights) -> np.ndarray:
    """The probability of each text; only features with a weight are told apart."""
    scores = np.empty(len(texts))
    size = max(len(weights.features), 1)
    for first, end, data, offsets in slices(texts):
        numbers, owners = features_of(words_in(data, offsets, NOT_ALNUM, FOLDED))
        at = np.minimum(np.searchsorted(weights.features, numbers), size - 1)
        hit = np.flatnonzero(weights.features[at] == numbers) if len(weights.features) else at[:0]
        owner, feature = np.divmod(np.unique(owners[hit] * size + at[hit]), size)
        sums = np.bincount(owner, weights.values[feature], end - first) + weights.bias
        scores[first:end] = 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))
    return scores


def class_share(labels: DataFrame, label: str) -> float:
    """The mean label, 0.5 without labels."""
    mean = labels.select(F.avg(F.col(label).cast("double"))).first()[0]
    return 0.5 if mean is None else float(mean)


def with_toxicity(docs: DataFrame, labels: DataFrame, column: str = "score") -> DataFrame:
    """``docs`` with the score in ``column``, trained on ``labels`` (``doc_id``, ``toxic``)."""
    weights = train(training_rows(docs, labels, "toxic"))
    given = docs.drop(column)
    if weights is None:
        return given.withColumn(column, F.lit(class_share(labels, "toxic")))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(text_scores(batch.column("text"), weights))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, column])

    return given.mapInArrow(scored, StructType([*given.schema.fields, StructField(column, DoubleType())]))
