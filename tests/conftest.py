import json
import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paywarden.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "paywarden-tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


EVENT = {
    "transaction_id": "P-7f3a",
    "customer_id": "C-58",
    "card_id": "K-58-2",
    "merchant_id": "M-204",
    "merchant_category": "luxury",
    "amount": 1725.5,
    "currency": "nok",
    "home_country": "no",
    "txn_country": "pt",
    "city": "Braga",
    "device_id": "D-9",
    "payment_method": "amex",
    "transaction_ts": "2024-05-01T10:00:00Z",
    "txn_status": "approved",
    "is_card_present": False,
    "is_new_device": True,
    "simulated_fraud_label": True,
    "ingest_source": "sample",
}


def event(without=(), **changes):
    merged = {**EVENT, **changes}
    return {key: value for key, value in merged.items() if key not in without}


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def messages(spark, payloads, publish="2024-05-01T10:02:00"):
    """Raw messages from dicts or texts, with one publish time or one per message."""
    times = [publish] * len(payloads) if isinstance(publish, str) else publish
    rows = [
        (i, p if p is None or isinstance(p, str) else json.dumps(p), t)
        for i, (p, t) in enumerate(zip(payloads, times))
    ]
    return spark.createDataFrame(rows, "n int, raw_message string, publish_text string").select(
        "n", "raw_message", F.to_timestamp("publish_text").alias("publish_ts")
    )
