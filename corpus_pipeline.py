"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm.decontamination import remove_contaminated
from paywarden.llm.jaccard_join import deduplicate
from paywarden.llm.mixing import emit_mix
from paywarden.llm.queries import toxicity_labels
from paywarden.llm.sharding import assign_shards, number_slots
from paywarden.llm.storage import saved
from paywarden.llm.toxicity import THRESHOLD, with_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHARDS = 24
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = "other_columns"


def keeping(docs: DataFrame, body: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``body`` makes of ``docs``, with any further columns as they were.

    They pass the operators as one struct with names of its own, so no name of
    theirs, dotted or like one that an operator uses, meets another.
    """
    others = [name for name in docs.columns if name not in COLUMNS]
    if not others:
        return body(docs)
    kept = [name for name in docs.columns if name in COLUMNS]
    held = F.struct(*(F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(others)))
    done = body(docs.select(*kept, held.alias(OTHERS)))
    added = [F.col(name) for name in done.columns if name not in (*kept, OTHERS)]
    replaced = set(done.columns) - {OTHERS}
    given = [
        F.col(name) if name in COLUMNS else F.col(f"{OTHERS}.c{others.index(name)}").alias(name)
        for name in docs.columns
        if name in COLUMNS or name not in replaced
    ]
    return done.select(*given, *added)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""

    def kept(given: DataFrame) -> DataFrame:
        scored = with_toxicity(given, toxicity_labels(spark, sf_dir), "_toxicity")
        return scored.where(F.col("_toxicity") < THRESHOLD).select(*given.columns)

    return keeping(docs, kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents that link by their shingles."""
    return keeping(docs, deduplicate)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return keeping(docs, lambda given: remove_contaminated(given, benchmark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return keeping(docs, emit_mix)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add ``shard`` and the row's ``slot`` in it; copies of a document share a shard.

    Rows with equal ids are ordered by the digest of their text and then of all
    other columns, so only rows that are equal in all of them can change places.
    Given columns of these two names are replaced.
    """

    def placed(given: DataFrame) -> DataFrame:
        others = F.struct(*(name for name in given.columns if name != "text"))
        digested = assign_shards(given, "doc_id", SHARDS).withColumns(
            {"text_hash": F.md5("text"), "row_hash": F.md5(F.to_json(others, {"ignoreNullFields": "false"}))}
        )
        numbered = number_slots(digested, ["doc_id", "text_hash", "row_hash"])
        return numbered.select(*given.columns, "shard", "slot")

    return keeping(docs, placed)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
