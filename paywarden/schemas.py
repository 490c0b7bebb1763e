"""Fixed schemas of the input event and of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# The keys an input event must carry.
REQUIRED_FIELDS = (
    "transaction_id",
    "customer_id",
    "card_id",
    "merchant_id",
    "merchant_category",
    "amount",
    "currency",
    "home_country",
    "txn_country",
    "city",
    "device_id",
    "payment_method",
    "transaction_ts",
    "txn_status",
    "is_card_present",
    "is_new_device",
    "simulated_fraud_label",
    "ingest_source",
)

RAW_STREAM = T.StructType(
    [
        T.StructField("raw_message", T.StringType()),
        T.StructField("publish_ts", T.TimestampType()),
    ]
)


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _table(columns: str, nullable: tuple[str, ...] = ()) -> T.StructType:
    """Schema of ``name type`` pairs, required unless named in ``nullable``; needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n in nullable) for n, t in pairs])


BRONZE = _table(
    """
    transaction_id string, customer_id string, card_id string, merchant_id string,
    merchant_category string, amount double, currency string, home_country string,
    txn_country string, city string, device_id string, payment_method string,
    transaction_ts timestamp, transaction_date date, txn_status string,
    is_card_present boolean, is_new_device boolean, simulated_fraud_label boolean,
    risk_score int, risk_level string, risk_reasons array<string>,
    ingest_source string, processing_ts timestamp, is_late_arrival boolean
    """,
    nullable=("risk_reasons",),
)

ALERTS = _table(
    """
    transaction_id string, transaction_ts timestamp, customer_id string, merchant_id string,
    merchant_category string, amount double, txn_country string, txn_status string,
    risk_score int, risk_level string, risk_reasons array<string>, alert_created_ts timestamp
    """,
    nullable=("risk_reasons",),
)

METRICS = _table(
    """
    window_start timestamp, window_end timestamp, txn_country string, merchant_category string,
    total_transactions bigint, approved_amount double, declined_transactions bigint,
    high_risk_transactions bigint, simulated_fraud_transactions bigint,
    avg_risk_score double, pipeline_run_ts timestamp
    """
)

METRIC_PANES = T.StructType([*METRICS, T.StructField("pane", T.LongType(), False)])

AUDIT = _table(
    """
    run_date date, check_name string, status string, failed_rows bigint,
    details string, created_ts timestamp
    """,
    nullable=("details",),
)

SILVER = _table(
    """
    transaction_id string, customer_id string, card_id string, merchant_id string,
    merchant_category string, amount double, currency string, home_country string,
    txn_country string, city string, device_id string, payment_method string,
    transaction_ts timestamp, transaction_date date, txn_status string,
    is_card_present boolean, is_new_device boolean, simulated_fraud_label boolean,
    risk_score int, risk_level string, risk_reasons array<string>,
    is_cross_border boolean, is_declined boolean, requires_manual_review boolean,
    processing_ts timestamp
    """,
    nullable=("risk_reasons",),
)

MERCHANT_KPIS = _table(
    """
    window_hour timestamp, merchant_id string, merchant_category string,
    total_transactions bigint, gross_amount double, high_risk_transactions bigint,
    declined_transactions bigint, simulated_fraud_transactions bigint,
    avg_risk_score double, high_risk_pct double
    """
)

COUNTRY_HOTSPOTS = _table(
    """
    transaction_date date, txn_country string, total_transactions bigint, total_amount double,
    high_risk_transactions bigint, declined_transactions bigint,
    simulated_fraud_transactions bigint, avg_risk_score double,
    high_risk_pct double, decline_pct double
    """
)

DEAD_LETTER = _table(
    "received_ts timestamp, error_count int, errors array<string>, raw_message string"
)
