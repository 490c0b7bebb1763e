"""One-minute operational metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.money import exact_sum, round_half_even
from paywarden.operators.dedup import WINDOW
from paywarden.schemas import METRICS

KEYS = ("txn_country", "merchant_category")


def minute_metrics(payments: DataFrame, minute: Column, run_ts: Column, extras: bool = False) -> DataFrame:
    """Counts, approved amount and average score per minute, country and category.

    ``minute`` is a time inside the row's window: ``F.window_time("window")``
    or ``window.start`` after the de-duplication. ``extras`` adds
    ``suspicious_amount_share``, the HIGH part of the amount.
    """
    amount = F.col("amount")
    is_high = F.col("risk_level") == "HIGH"
    measures = [
        F.count("*").alias("total_transactions"),
        # Zero for declined rows, so that a group without approvals sums to zero.
        exact_sum(F.when(F.col("txn_status") == "APPROVED", amount).otherwise(F.lit(0.0))).alias(
            "approved_amount"
        ),
        F.count_if(F.col("txn_status") == "DECLINED").alias("declined_transactions"),
        F.count_if(is_high).alias("high_risk_transactions"),
        F.count_if("simulated_fraud_label").alias("simulated_fraud_transactions"),
        F.sum("risk_score").alias("_score"),
    ]
    names = METRICS.fieldNames()
    if extras:
        suspicious = exact_sum(F.when(is_high, amount).otherwise(F.lit(0.0)))
        measures.append(F.try_divide(suspicious, exact_sum(amount)).alias("suspicious_amount_share"))
        names = names + ["suspicious_amount_share"]
    average = round_half_even(F.col("_score") / F.col("total_transactions"))
    return (
        payments.groupBy(F.window(minute, WINDOW).alias("window"), *KEYS)
        .agg(*measures)
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .withColumn("avg_risk_score", average)
        .withColumn("pipeline_run_ts", run_ts)
        .select(*names)
    )
