"""Refresh of silver and gold for the dates that changed since the last one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.operators.curate import curate_transactions
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis
from paywarden.plans.warehouse import refresh_gold, refresh_silver
from paywarden.schemas import SILVER
from paywarden.sources import lake as tables
from paywarden.sources.lake import BATCH, RUN, Lake

Runs = set[tuple[str, str]]


def refresh_changed(spark: SparkSession, lake: Lake) -> list[date] | None:
    """Bring silver and gold up to date with bronze and return the dates that were replaced.

    Runs of bronze that silver was not built from, and runs that no longer
    count, name the ids that may have changed. Only these are de-duplicated
    again, over all of bronze, as the latest row of an id may lie in another
    date. Dates that such an id is in, or was in, are replaced in silver and
    computed again in gold; all others keep their files. Without a note of what
    silver was built from, after a refresh that failed, or if a run that was
    read then has been deleted, all is rebuilt and None is returned.
    """
    current = _runs(lake.stored(spark, tables.BRONZE))
    noted = lake.noted_inputs(spark)
    added, gone = current - noted, noted - current
    stored = lake.all_runs(spark, tables.BRONZE)
    if not noted or not lake.written(spark, tables.SILVER) or (gone and not gone <= _runs(stored)):
        lake.note_inputs(spark, [])
        refresh_silver(spark, lake)
        refresh_gold(spark, lake)
        lake.note_inputs(spark, current)
        return None
    if not added and not gone:
        return []
    with lake.scratch(spark, "silver") as folder:
        days, rows = _changed_silver(spark, lake, _of_runs(stored, added | gone), folder)
        lake.note_inputs(spark, [])
        # Kept rows come from the files that are replaced, which stay until the new ones are complete.
        lake.replace_partitions(rows, tables.SILVER, days)
    silver = lake.read(spark, tables.SILVER).where(F.col(tables.SILVER.partition).isin(days))
    lake.replace_partitions(merchant_hourly_kpis(silver), tables.MERCHANT_KPIS, days)
    lake.replace_partitions(country_fraud_hotspots(silver), tables.COUNTRY_HOTSPOTS, days)
    lake.note_inputs(spark, current)
    return days


def _changed_silver(
    spark: SparkSession, lake: Lake, touched: DataFrame, folder: str
) -> tuple[list[date], DataFrame]:
    """The dates that the ids of ``touched`` are or were in, and all their rows; the new ones are written to ``folder``."""
    day = tables.SILVER.partition
    ids = touched.select("transaction_id").distinct()
    old = lake.read(spark, tables.SILVER)
    bronze = lake.read(spark, tables.BRONZE)
    latest = _written(curate_transactions(bronze.join(ids, "transaction_id", "left_semi")), f"{folder}/latest")
    were = old.join(ids, "transaction_id", "left_semi").select(day)
    days = sorted(row[0] for row in were.unionAll(latest.select(day)).distinct().collect())
    kept = old.where(F.col(day).isin(days)).join(ids, "transaction_id", "left_anti")
    return days, kept.unionByName(latest).select(*SILVER.fieldNames())


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _runs(bronze: DataFrame) -> Runs:
    """Partition values alone: a run for each micro-batch of an open date, one for a closed one."""
    return {tuple(row) for row in bronze.select(BATCH, RUN).distinct().collect()}


def _of_runs(stored: DataFrame, runs: Runs) -> DataFrame:
    return stored.where(F.concat(F.col(BATCH), F.lit("/"), F.col(RUN)).isin(*(f"{b}/{r}" for b, r in runs)))
