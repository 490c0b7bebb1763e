"""Parsed events to typed payments, and typed payments to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.coerce import instant, is_number, number
from paywarden.functions.money import round_half_even
from paywarden.operators.scoring import score_payments
from paywarden.schemas import BRONZE, REQUIRED_FIELDS

INVALID_TIMESTAMP = "Invalid transaction_ts"
AMOUNT_NOT_NUMERIC = "amount must be numeric"

LATE_AFTER_SECONDS = 300

# The order in which a missing or unusable key is noticed.
_FAILURE_ORDER = (
    "transaction_ts",
    "amount",
    "txn_country",
    "home_country",
    "is_card_present",
    "is_new_device",
    "merchant_category",
    "txn_status",
    "transaction_id",
    "customer_id",
    "card_id",
    "merchant_id",
    "currency",
    "city",
    "device_id",
    "payment_method",
    "simulated_fraud_label",
    "ingest_source",
)


def type_payments(parsed: DataFrame) -> DataFrame:
    """Coerce parsed keys to types and keep the first failure in ``coercion_error``.

    ``transaction_ts`` becomes an instant and ``amount`` a double; texts stay as sent.
    """
    carried = [name for name in parsed.columns if name not in REQUIRED_FIELDS + ("parse_error",)]
    # Typed columns carry a prefix until the failure check has seen both forms.
    typed = parsed.select(
        *carried,
        "parse_error",
        *REQUIRED_FIELDS,
        instant(F.col("transaction_ts")).alias("_transaction_ts"),
        number(F.col("amount")).alias("_amount"),
    )
    checks = [F.col("parse_error")]
    for name in _FAILURE_ORDER:
        checks.append(F.when(F.col(name).isNull(), F.lit(f"'{name}'")))
        if name == "transaction_ts":
            checks.append(F.when(F.col("_transaction_ts").isNull(), F.lit(INVALID_TIMESTAMP)))
        if name == "amount":
            checks.append(F.when(~is_number(F.col("_amount")), F.lit(AMOUNT_NOT_NUMERIC)))
    replaced = ("transaction_ts", "amount")
    return typed.select(
        *carried,
        *[F.col(f"_{name}" if name in replaced else name).alias(name) for name in REQUIRED_FIELDS],
        F.coalesce(*checks).alias("coercion_error"),
    )


def normalize_payments(payments: DataFrame, as_of: Column | str) -> DataFrame:
    """Score typed payments and project them to the 24 bronze columns.

    ``as_of`` is the processing time: a column of the input or the current
    time. Other columns of the input are kept in front.
    """
    carried = [name for name in payments.columns if name not in REQUIRED_FIELDS]
    event_time = F.col("transaction_ts")
    delay = F.unix_micros(as_of) - F.unix_micros(event_time)
    columns = {name: F.col(name) for name in BRONZE.fieldNames() if name in REQUIRED_FIELDS}
    columns["merchant_category"] = F.lower("merchant_category")
    for name in ("currency", "home_country", "txn_country", "payment_method", "txn_status"):
        columns[name] = F.upper(name)
    columns["amount"] = round_half_even(F.col("amount"))
    columns["transaction_ts"] = F.date_trunc("second", event_time)
    columns["transaction_date"] = F.to_date(event_time)
    columns["processing_ts"] = F.date_trunc("second", as_of)
    columns["is_late_arrival"] = delay > LATE_AFTER_SECONDS * 1_000_000
    for name in ("risk_score", "risk_level", "risk_reasons"):
        columns[name] = F.col(name)
    return score_payments(payments).select(
        *carried, *[columns[name].alias(name) for name in BRONZE.fieldNames()]
    )
