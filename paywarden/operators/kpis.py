"""Silver to the two gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.money import exact_sum, percentage, round_half_up
from paywarden.schemas import COUNTRY_HOTSPOTS, MERCHANT_KPIS


def _measures(amount_name: str) -> list[Column]:
    return [
        F.count("*").alias("total_transactions"),
        exact_sum(F.col("amount")).alias(amount_name),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk_transactions"),
        F.count_if(F.col("txn_status") == "DECLINED").alias("declined_transactions"),
        F.count_if("simulated_fraud_label").alias("simulated_fraud_transactions"),
        F.avg("risk_score").alias("_average"),
    ]


def _with_rates(grouped: DataFrame) -> DataFrame:
    total = F.col("total_transactions")
    return (
        grouped.withColumn("avg_risk_score", round_half_up(F.col("_average")))
        .withColumn("high_risk_pct", percentage(F.col("high_risk_transactions"), total))
        .withColumn("decline_pct", percentage(F.col("declined_transactions"), total))
    )


def merchant_hourly_kpis(silver: DataFrame) -> DataFrame:
    """Risk KPIs per hour, merchant and category."""
    hour = F.date_trunc("hour", "transaction_ts").alias("window_hour")
    grouped = silver.groupBy(hour, "merchant_id", "merchant_category").agg(*_measures("gross_amount"))
    return _with_rates(grouped).select(*MERCHANT_KPIS.fieldNames())


def country_fraud_hotspots(silver: DataFrame) -> DataFrame:
    """Risk KPIs per day and transaction country."""
    grouped = silver.groupBy("transaction_date", "txn_country").agg(*_measures("total_amount"))
    return _with_rates(grouped).select(*COUNTRY_HOTSPOTS.fieldNames())
