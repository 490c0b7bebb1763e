"""The queries of the operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm.byte_bpe import decode_ids, encode_texts, read_ranks
from paywarden.llm.decontamination import find_overlaps
from paywarden.llm.jaccard_join import similar_components
from paywarden.llm.license_scan import scan_licenses
from paywarden.llm.line_dedup import drop_boilerplate, host_of, page_text
from paywarden.llm.merkle import LEAF_COLUMNS, build_manifest, fold, leaf_digest, proof_digest
from paywarden.llm.mixing import plan_mix
from paywarden.llm import quality_ranking, toxicity
from paywarden.llm.quality_rules import judge_documents
from paywarden.llm.resampling import resample
from paywarden.llm.secret_scan import scan_secrets
from paywarden.llm.sharding import assign_shards, number_slots
from paywarden.llm.storage import saved

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def in_fold(doc_id: Column, folds: int, held: int) -> Column:
    """Whether the checksum of the id's text leaves ``held``; a null id is in no held-out fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(False))


def with_folds(scored: DataFrame, folds: int, held: int, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id"), folds, held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that toxicity may learn from."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(~in_fold(F.col("doc_id"), 3, 1))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = toxicity_labels(spark, sf_dir)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_folds(toxicity.with_toxicity(docs, labels), 3, 1, toxicity.THRESHOLD)


def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~in_fold(F.col("doc_id"), 4, 2))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_folds(quality_ranking.score_quality(docs, labels), 4, 2, quality_ranking.THRESHOLD)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return drop_boilerplate(pages.select("page_id", host_of(F.col("url")).alias("host"), page_text(F.col("html")).alias("text")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = saved(assign_shards(docs), "placed")
    return number_slots(placed, ["doc_id", "text_crc32"]).drop("key_number")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_overlaps(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "starts", "lengths")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    others = [F.col(name) for name in LEAF_COLUMNS if name != "text"]
    tampered = F.when(in_fold(F.col("doc_id"), 5, 0), leaf_digest(*others, lowered))
    manifest = build_manifest(docs, {"tampered": tampered})
    folded = manifest.withColumn("folded_root", fold(F.col("path"), F.coalesce("tampered", "leaf")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The vocabulary files are no part of the library; only this query names one.
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode_texts(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    decoded = decode_ids(encoded.select("doc_id", "ids"), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(documents(spark, sf_dir), benchmark).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_secret_scan,
        op2_toxicity,
        op3_quality_ranking,
        op4_quality_rules,
        op5_line_dedup,
        op6_license_scan,
        op7_sharding,
        op8_mixing,
        op9_jaccard_join,
        op10_decontamination,
        op11_merkle_manifest,
        op12_byte_bpe,
        op13_importance_resampling,
    )
}
