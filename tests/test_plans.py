"""Shapes of the plans that matter at scale."""

from pyspark.sql import functions as F

from fixtures.cases import message_stream, scored_payments
from fixtures.payments import raw_messages
from paywarden.operators.curate import curate_transactions
from paywarden.operators.dedup import earliest_per_minute
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis
from paywarden.operators.parse import parse_messages
from paywarden.operators.quality import audit_transactions
from paywarden.operators.validate import process_messages, valid_payments
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake
from tests.conftest import SMALL, event, messages


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def written_silver(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lake.replace(curate_transactions(scored_payments(spark, SMALL)), tables.SILVER)
    return lake.read(spark, tables.SILVER)


def test_messages_are_parsed_once_although_rows_are_filtered(spark):
    raw = raw_messages(spark, SMALL)
    plan = physical(valid_payments(process_messages(raw, F.col("publish_ts"))))
    assert plan.count("from_json(") == 1
    assert "Exchange hashpartitioning" not in plan and "PythonUDF" not in plan


def test_deduplication_combines_before_its_shuffle(spark):
    silver = physical(curate_transactions(scored_payments(spark, SMALL)))
    assert silver.count("WindowGroupLimit") == 2 and silver.count("Exchange hashpartitioning") == 1
    minute = physical(earliest_per_minute(scored_payments(spark, SMALL)))
    assert "partial_min" in minute and minute.count("Exchange hashpartitioning") == 1


def test_gold_reads_only_its_columns_and_partitions(spark, tmp_path):
    silver = written_silver(spark, tmp_path)
    plan = physical(country_fraud_hotspots(silver.filter("transaction_date = date'2024-01-02'")))
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    scan = plan[plan.index("ReadSchema") :]
    assert "device_id" not in scan and "risk_reasons" not in scan
    assert physical(merchant_hourly_kpis(silver)).count("Exchange hashpartitioning") == 1


def test_cluster_columns_are_pushed_to_the_scan(spark, tmp_path):
    silver = written_silver(spark, tmp_path)
    assert "EqualTo(risk_level,HIGH)" in physical(silver.filter("risk_level = 'HIGH'"))


def test_the_audit_scans_and_shuffles_once(spark, tmp_path):
    silver = written_silver(spark, tmp_path)
    plan = physical(audit_transactions(silver, F.current_date(), F.current_timestamp()))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<transaction_id:string,amount:double,risk_score:int>" in plan


def test_the_fixture_stream_is_a_stream(spark, tmp_path):
    assert message_stream(spark, SMALL, str(tmp_path / "heartbeat")).isStreaming


def test_only_texts_with_a_closing_bracket_are_searched_by_pattern(spark):
    given = messages(spark, [event()]).drop("n")
    assert "Contains(raw_message" in physical(parse_messages(given))
