"""The stages of the pipeline, each against the rows that its operator and plain code give."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paywarden.llm import decontamination, jaccard_join, mixing, toxicity
from paywarden.llm.queries import toxicity_labels
from tests.llm.test_operators import SMALL

CLASHING = ("_toxicity", "key_number", "grown_shard", "_items", "_lane", "a.b", "text_hash", "other_columns", "_rank")


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with repeated and null ids, and columns of names that operators use."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    doc_id = F.when(F.col("doc_id") % 9 == 0, 7).when(F.col("doc_id") % 11 != 0, F.col("doc_id"))
    return given.withColumns({name: F.concat(F.lit(name), F.md5("text")) for name in CLASHING}).withColumn("doc_id", doc_id)


def rows_of(frame, columns):
    return Counter(tuple(r[c] for c in columns) for r in frame.collect())


def test_stages_keep_rows_and_columns(spark, docs):
    columns, plain = docs.columns, docs.select(*corpus_pipeline.COLUMNS)
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    given = rows_of(docs, columns)

    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    scores = toxicity.with_toxicity(plain, toxicity_labels(spark, SMALL), "score")
    low = rows_of(scores.where(F.col("score") < toxicity.THRESHOLD), corpus_pipeline.COLUMNS)
    assert clean.columns == columns and rows_of(clean, corpus_pipeline.COLUMNS) == low

    single = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert single.columns == columns and not rows_of(single, columns) - given
    assert rows_of(single, corpus_pipeline.COLUMNS) == rows_of(jaccard_join.deduplicate(plain), corpus_pipeline.COLUMNS)

    unseen = corpus_pipeline.decontaminate(spark, docs, SMALL)
    found = decontamination.find_overlaps(plain, benchmark)
    assert rows_of(unseen, corpus_pipeline.COLUMNS) == rows_of(found.where(F.size("items") == 0), corpus_pipeline.COLUMNS)
    assert unseen.columns == columns and not rows_of(unseen, columns) - given

    mixed = corpus_pipeline.mix_sources(spark, docs, SMALL)
    assert mixed.columns == columns
    assert rows_of(mixed, corpus_pipeline.COLUMNS) == rows_of(mixing.emit_mix(plain), corpus_pipeline.COLUMNS)
    assert set(rows_of(mixed, columns)) <= set(given)

    placed = corpus_pipeline.shard(spark, docs, SMALL)
    assert placed.columns == [*columns, "shard", "slot"] and rows_of(placed, columns) == given


def test_slots_are_the_same_however_rows_are_dealt_out(spark, docs):
    def slots(frame):
        placed = corpus_pipeline.shard(spark, frame, SMALL)
        return rows_of(placed, [*docs.columns, "shard", "slot"])

    first = slots(docs)
    assert slots(docs.repartition(7)) == first and slots(docs.repartition(3, "text")) == first
    by_shard = {}
    for row in first.elements():
        by_shard.setdefault(row[-2], []).append(row[-1])
    assert all(sorted(numbers) == list(range(len(numbers))) for numbers in by_shard.values())


def test_given_shards_are_replaced(spark, docs):
    given = docs.withColumns({"shard": F.lit("x"), "slot": F.lit("y")})
    placed = corpus_pipeline.shard(spark, given, SMALL)
    assert sorted(placed.columns) == sorted(given.columns)
    assert dict(placed.dtypes)["shard"] == "int" and dict(placed.dtypes)["slot"] == "bigint"
