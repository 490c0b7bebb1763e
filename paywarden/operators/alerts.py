"""High-risk alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.schemas import ALERTS


def high_risk_alerts(payments: DataFrame, as_of: Column | str) -> DataFrame:
    """HIGH payments as alert rows created at ``as_of``."""
    kept = [name for name in ALERTS.fieldNames() if name != "alert_created_ts"]
    return payments.filter(F.col("risk_level") == "HIGH").select(
        *kept, F.date_trunc("second", as_of).alias("alert_created_ts")
    )
