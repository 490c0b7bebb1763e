"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.operators.dedup import latest_per_id
from paywarden.operators.scoring import MANUAL_REVIEW_FROM
from paywarden.schemas import SILVER


def curate_transactions(bronze: DataFrame) -> DataFrame:
    """The latest row of each transaction with its three review flags."""
    false = F.lit(False)
    flags = {
        "is_cross_border": F.coalesce(F.col("txn_country") != F.col("home_country"), false),
        "is_declined": F.coalesce(F.col("txn_status") == "DECLINED", false),
        "requires_manual_review": F.coalesce(F.col("risk_score") >= MANUAL_REVIEW_FROM, false),
    }
    # Only the columns silver needs go through the shuffle.
    stored = [name for name in SILVER.fieldNames() if name not in flags]
    latest = latest_per_id(bronze.select(*stored))
    return latest.select(
        *[flags[name].alias(name) if name in flags else F.col(name) for name in SILVER.fieldNames()]
    )
