"""Six additive, explainable risk rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.texts import present

# Points, thresholds and categories of the rules.
HIGH_AMOUNT_FROM = 1500
ELEVATED_AMOUNT_FROM = 800
RISKY_CATEGORIES = ("ELECTRONICS", "LUXURY", "GIFT_CARDS", "TRAVEL")
POINTS = {
    "HIGH_AMOUNT": 40,
    "ELEVATED_AMOUNT": 20,
    "CROSS_BORDER": 25,
    "CARD_NOT_PRESENT": 10,
    "NEW_DEVICE": 15,
    "RISKY_MERCHANT_CATEGORY": 10,
    "DECLINED_TRANSACTION": 5,
}
HIGH_FROM = 60
MEDIUM_FROM = 30
MANUAL_REVIEW_FROM = 80


def _conditions() -> dict[str, Column]:
    amount = F.col("amount")
    return {
        "HIGH_AMOUNT": amount >= HIGH_AMOUNT_FROM,
        "ELEVATED_AMOUNT": (amount >= ELEVATED_AMOUNT_FROM) & (amount < HIGH_AMOUNT_FROM),
        "CROSS_BORDER": F.col("txn_country") != F.col("home_country"),
        "CARD_NOT_PRESENT": ~F.col("is_card_present"),
        "NEW_DEVICE": F.col("is_new_device"),
        "RISKY_MERCHANT_CATEGORY": F.upper("merchant_category").isin(*RISKY_CATEGORIES),
        "DECLINED_TRANSACTION": F.upper("txn_status") == "DECLINED",
    }


def score_payments(payments: DataFrame) -> DataFrame:
    """Add ``risk_score``, ``risk_level`` and ``risk_reasons`` to typed payments.

    The rules look at the values as the producer sent them: countries are
    compared before case folding and the amount before rounding.
    """
    conditions = _conditions()
    score = reduce(
        lambda total, points: total + points,
        [F.when(conditions[rule], F.lit(points)).otherwise(F.lit(0)) for rule, points in POINTS.items()],
    )
    reasons = present(F.when(conditions[rule], F.lit(rule)) for rule in POINTS)
    level = (
        F.when(F.col("risk_score") >= HIGH_FROM, "HIGH")
        .when(F.col("risk_score") >= MEDIUM_FROM, "MEDIUM")
        .otherwise("LOW")
    )
    return payments.select(
        "*", score.cast("int").alias("risk_score"), reasons.alias("risk_reasons")
    ).withColumn("risk_level", level)
