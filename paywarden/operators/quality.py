"""Data-quality audit of silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.coerce import is_blank
from paywarden.schemas import AUDIT

# Check name, status of a failed check, detail text.
CHECKS = (
    (
        "null_transaction_id_in_silver",
        "FAIL",
        "transactions_curated should not contain null transaction_id values.",
    ),
    (
        "duplicate_transaction_id_in_silver",
        "FAIL",
        "Each transaction_id should be unique in the curated transaction table.",
    ),
    ("negative_transaction_amount", "FAIL", "Transaction amounts must remain positive."),
    ("risk_score_above_100", "WARN", "Risk score should stay within the expected rule-based range."),
)
MISSING_ATTRIBUTES = (
    "missing_country_or_merchant",
    "FAIL",
    "Country and merchant attributes must be present.",
)
SCORE_LIMIT = 100


def _is_missing(name: str) -> Column:
    return is_blank(F.coalesce(F.col(name), F.lit("")))


def _checks(extras: bool) -> tuple[tuple[str, str, str], ...]:
    return CHECKS + ((MISSING_ATTRIBUTES,) if extras else ())


def _row_checks(extras: bool) -> dict[str, Column]:
    conditions = {
        "negative_transaction_amount": F.col("amount") <= 0,
        "risk_score_above_100": F.col("risk_score") > SCORE_LIMIT,
    }
    if extras:
        conditions[MISSING_ATTRIBUTES[0]] = _is_missing("txn_country") | _is_missing("merchant_id")
    return conditions


def audit_transactions(
    silver: DataFrame, run_date: Column, created_ts: Column, extras: bool = False
) -> DataFrame:
    """One audit row per check; ``extras`` adds the check for missing attributes.

    Counting repeated ids needs one group per id anyway, so the row checks ride
    on the same grouping: one scan of the columns concerned and one shuffle,
    combined before it.
    """
    row_checks = _row_checks(extras)
    per_id = silver.groupBy("transaction_id").agg(
        F.count("*").alias("_rows"),
        *[F.count_if(condition).alias(name) for name, condition in row_checks.items()],
    )
    rows = F.col("_rows")
    totals = per_id.agg(
        F.sum(F.when(F.col("transaction_id").isNull(), rows)).alias("null_transaction_id_in_silver"),
        F.count_if(rows > 1).alias("duplicate_transaction_id_in_silver"),
        *[F.sum(name).alias(name) for name in row_checks],
    )
    return _audit_rows(totals, run_date, created_ts, extras)


def observed_checks(extras: bool = False) -> dict[str, Column]:
    """The checks of single rows as aggregates, to be taken while silver is written."""
    conditions = {"null_transaction_id_in_silver": F.col("transaction_id").isNull(), **_row_checks(extras)}
    return {name: F.count_if(condition) for name, condition in conditions.items()}


def audit_observed(
    silver: DataFrame, observed: dict[str, int], run_date: Column, created_ts: Column, extras: bool = False
) -> DataFrame:
    """The same audit from what was observed; only repeated ids are looked for, in the one column they need."""
    per_id = silver.groupBy("transaction_id").agg(F.count("*").alias("_rows"))
    totals = per_id.agg(F.count_if(F.col("_rows") > 1).alias("duplicate_transaction_id_in_silver"))
    counted = totals.withColumns({name: F.lit(n).cast("bigint") for name, n in observed.items()})
    return _audit_rows(counted, run_date, created_ts, extras)


def _audit_rows(totals: DataFrame, run_date: Column, created_ts: Column, extras: bool) -> DataFrame:
    """One row per check from one row with a failure count per check."""
    failed = F.coalesce(F.col("_check.failed_rows"), F.lit(0).cast("bigint"))
    unpivoted = totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.lit(bad_status).alias("bad_status"),
                        F.col(name).alias("failed_rows"),
                        F.lit(details).alias("details"),
                    )
                    for name, bad_status, details in _checks(extras)
                ]
            )
        ).alias("_check")
    )
    return unpivoted.select(
        run_date.alias("run_date"),
        F.col("_check.check_name").alias("check_name"),
        F.when(failed == 0, "PASS").otherwise(F.col("_check.bad_status")).alias("status"),
        failed.alias("failed_rows"),
        F.col("_check.details").alias("details"),
        created_ts.alias("created_ts"),
    ).select(*AUDIT.fieldNames())
