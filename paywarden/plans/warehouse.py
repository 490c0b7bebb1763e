"""The warehouse rebuild: silver, then gold, then the audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.operators.curate import curate_transactions
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis
from paywarden.operators.quality import audit_observed, audit_transactions, observed_checks
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake


def refresh_silver(spark: SparkSession, lake: Lake, extras: bool = False) -> dict[str, int]:
    """Rebuild silver from bronze; returns what the checks of its rows found while it was written."""
    silver = curate_transactions(lake.read(spark, tables.BRONZE))
    return lake.replace(silver, tables.SILVER, observed_checks(extras))


def refresh_gold(spark: SparkSession, lake: Lake) -> None:
    """Rebuild both gold tables from the written silver table, each reading only its columns."""
    silver = lake.read(spark, tables.SILVER)
    lake.replace(merchant_hourly_kpis(silver), tables.MERCHANT_KPIS)
    lake.replace(country_fraud_hotspots(silver), tables.COUNTRY_HOTSPOTS)


def append_audit(
    spark: SparkSession,
    lake: Lake,
    run_date: Column,
    created_ts: Column,
    extras: bool = False,
    observed: dict[str, int] | None = None,
) -> None:
    """Check the written silver table and append the result to the audit log.

    With what was ``observed`` when silver was written, only its ids are read again.
    """
    silver = lake.read(spark, tables.SILVER)
    if observed is None:
        audit = audit_transactions(silver, run_date, created_ts, extras)
    else:
        audit = audit_observed(silver, observed, run_date, created_ts, extras)
    lake.append(audit, tables.AUDIT)


def rebuild_warehouse(
    spark: SparkSession,
    lake: Lake,
    run_date: Column | None = None,
    created_ts: Column | None = None,
    extras: bool = False,
    catalog: bool = False,
) -> DataFrame:
    """Run the three stages in order and return the audit log.

    ``catalog`` also defines the tables in the session's catalog as they stand then.
    """
    observed = refresh_silver(spark, lake, extras)
    refresh_gold(spark, lake)
    append_audit(
        spark,
        lake,
        F.current_date() if run_date is None else run_date,
        F.current_timestamp() if created_ts is None else created_ts,
        extras,
        observed,
    )
    if catalog:
        lake.publish_tables(spark)
    return lake.read(spark, tables.AUDIT)
