"""Validation messages, routing and dead-letter records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.coerce import instant, is_blank, is_number, number
from paywarden.functions.texts import present
from paywarden.operators.normalize import (
    AMOUNT_NOT_NUMERIC,
    INVALID_TIMESTAMP,
    normalize_payments,
    type_payments,
)
from paywarden.operators.parse import parse_messages
from paywarden.schemas import BRONZE, REQUIRED_FIELDS

# Accepted statuses, the code length and the message texts.
STATUSES = ("APPROVED", "DECLINED")
CURRENCY_LENGTH = 3
AMOUNT_NOT_POSITIVE = "amount must be greater than zero"
CURRENCY_NOT_A_CODE = "currency must be a 3-letter code"
STATUS_UNKNOWN = "Unsupported txn_status: "
IN_THE_FUTURE = "transaction_ts cannot be in the future"
MERCHANT_EMPTY = "merchant_id cannot be empty"
COUNTRY_EMPTY = "txn_country cannot be empty"
FIELDS_MISSING = "Missing required fields: "


def _rule_errors(amount: Column, event_time: Column, as_of: Column | str) -> list[Column]:
    """The six value checks in reporting order; NULL where a check passes."""
    status = F.col("txn_status")
    return [
        F.when(amount <= 0, F.lit(AMOUNT_NOT_POSITIVE)),
        F.when(F.length("currency") != CURRENCY_LENGTH, F.lit(CURRENCY_NOT_A_CODE)),
        F.when(~F.upper(status).isin(*STATUSES), F.concat(F.lit(STATUS_UNKNOWN), status)),
        F.when(event_time > F.date_trunc("second", as_of), F.lit(IN_THE_FUTURE)),
        F.when(is_blank(F.col("merchant_id")), F.lit(MERCHANT_EMPTY)),
        F.when(is_blank(F.col("txn_country")), F.lit(COUNTRY_EMPTY)),
    ]


def validate_normalized(normalized: DataFrame, as_of: Column | str) -> DataFrame:
    """Turn ``coercion_error`` and the value checks on bronze rows into ``errors``."""
    found = present(_rule_errors(F.col("amount"), F.col("transaction_ts"), as_of))
    errors = F.when(
        F.col("coercion_error").isNotNull(), F.array(F.col("coercion_error"))
    ).otherwise(found)
    kept = [name for name in normalized.columns if name != "coercion_error"]
    return normalized.select(*kept, errors.alias("errors"))


def validate_raw(parsed: DataFrame, as_of: Column | str) -> DataFrame:
    """Check parsed events before normalisation: ``raw_message`` and ``errors``.

    Missing keys are reported together and end the check; otherwise every
    failing check is reported, on the values as sent.
    """
    carried = [
        name for name in parsed.columns if name not in REQUIRED_FIELDS + ("parse_error",)
    ]
    missing = present(F.when(F.col(name).isNull(), F.lit(name)) for name in sorted(REQUIRED_FIELDS))
    typed = parsed.select(
        "*",
        instant(F.col("transaction_ts")).alias("_transaction_ts"),
        number(F.col("amount")).alias("_amount"),
        missing.alias("_missing"),
    )
    timestamp_error = F.when(F.col("_transaction_ts").isNull(), F.lit(INVALID_TIMESTAMP))
    number_error = F.when(~is_number(F.col("_amount")), F.lit(AMOUNT_NOT_NUMERIC))
    checks = _rule_errors(F.col("_amount"), F.col("_transaction_ts"), as_of)
    errors = (
        F.when(F.col("parse_error").isNotNull(), F.array(F.col("parse_error")))
        .when(
            F.size("_missing") > 0,
            F.array(F.concat(F.lit(FIELDS_MISSING), F.array_join("_missing", ", "))),
        )
        .otherwise(present([timestamp_error, number_error, *checks]))
    )
    return typed.select(*carried, errors.alias("errors"))


def process_messages(messages: DataFrame, as_of: Column | str) -> DataFrame:
    """Parse, normalise and validate: one row per message with bronze columns and ``errors``.

    ``as_of`` may refer to a column of ``messages``; the input columns are kept.
    """
    return validate_normalized(
        normalize_payments(type_payments(parse_messages(messages)), as_of), as_of
    )


def _evaluated_once(rows: DataFrame) -> DataFrame:
    """The same rows through a generator, so that a filter on them does not repeat their expressions."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def valid_payments(processed: DataFrame) -> DataFrame:
    """Rows without errors: bronze columns and the message's publish time."""
    columns = ["publish_ts", *BRONZE.fieldNames()]
    routed = _evaluated_once(processed.select(*columns, "errors"))
    return routed.filter(F.size("errors") == 0).select(*columns)


def dead_letters(processed: DataFrame, as_of: Column | str) -> DataFrame:
    """Rows with errors as dead-letter records."""
    records = processed.select(
        F.date_trunc("second", as_of).alias("received_ts"),
        F.size("errors").alias("error_count"),
        "errors",
        "raw_message",
    )
    return _evaluated_once(records).filter(F.col("error_count") > 0)
