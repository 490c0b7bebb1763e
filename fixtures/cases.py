"""The registered queries: engine operators over payments derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.payments import START, heartbeat, raw_messages, typed_payments
from paywarden.operators.alerts import high_risk_alerts
from paywarden.operators.curate import curate_transactions
from paywarden.operators.dedup import earliest_per_minute
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis
from paywarden.operators.metrics import minute_metrics
from paywarden.operators.normalize import normalize_payments
from paywarden.operators.parse import parse_messages
from paywarden.operators.quality import audit_observed, audit_transactions, observed_checks
from paywarden.operators.validate import (
    dead_letters,
    process_messages,
    valid_payments,
    validate_raw,
)
from paywarden.plans.batch import deduplicated_payments, process_period
from paywarden.plans.incremental import refresh_changed
from paywarden.plans.warehouse import rebuild_warehouse
from paywarden.schemas import BRONZE, SILVER
from paywarden.session import configure, shared_dir
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake
from paywarden.sources.raw import read_dead_letters, replay_messages, stream_from_files
from paywarden.streaming.jobs import (
    chained_metrics,
    drain,
    live_metrics,
    read_staged,
    replay_dead_letters,
    start_live_metrics,
    start_processing,
    start_publishing,
)

RUN_TS = "2024-02-01 00:00:00"
MESSAGE_FILES = 3
ONCE = {"availableNow": True}
# Messages reach the stream up to this many seconds after their publish time, in an order of their own.
LATEST_ARRIVAL = 240
# Ends of the micro-batches, in seconds since the start: inside the bursts of messages and between them.
ARRIVALS = (0, 300, 450, 3_600, 4_000, 86_400 + 350, 86_400 + 4_100, 172_800 + 200, 172_800 + 7_200)
CORRECTED_DATE = "2024-01-02"


def _as_of() -> Column:
    """Processing time of the fixture: the publish time."""
    return F.col("publish_ts")


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def _run_date() -> Column:
    return F.lit("2024-02-01").cast("date")


def comparable(rows: DataFrame) -> DataFrame:
    """Times, dates and arrays as text, so that two engines can be compared by value."""
    columns = []
    for f in rows.schema:
        column = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column, "; " if f.name == "errors" else ",")
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def scored_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed payments, fault-free, as bronze rows that still hold repeated ids."""
    typed = typed_payments(spark, sf_dir).drop("event_id", "copy")
    return normalize_payments(typed, _as_of())


def _identified(rows: DataFrame) -> DataFrame:
    """Replace the message text by the id it starts with."""
    return rows.withColumn(
        "transaction_id", F.regexp_extract("raw_message", r"TXN-[0-9]{12}", 0)
    ).drop("raw_message")


def risk_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_payments(spark, sf_dir).select(
        "transaction_id", "transaction_ts", "risk_score", "risk_level", "risk_reasons"
    )


def normalized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = process_messages(raw_messages(spark, sf_dir), _as_of())
    return valid_payments(processed).select(*BRONZE.fieldNames())


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = process_messages(raw_messages(spark, sf_dir), _as_of())
    return _identified(dead_letters(processed, _as_of()))


def dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters written as JSON lines, read back and processed again."""
    processed = process_messages(raw_messages(spark, sf_dir), _as_of())
    path = shared_dir(spark, "dead-letters")
    dead_letters(processed, _as_of()).write.json(path)
    again = process_messages(replay_messages(read_dead_letters(spark, path)), _as_of())
    return _identified(dead_letters(again, _as_of()))


def raw_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(validate_raw(parse_messages(raw_messages(spark, sf_dir)), _as_of()))


def _minute_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earliest_per_minute(scored_payments(spark, sf_dir))


def windowed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minute_payments(spark, sf_dir).select(
        *BRONZE.fieldNames(), F.col("window.start").alias("window_start")
    )


def flagged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_risk_alerts(_minute_payments(spark, sf_dir), _run_ts())


def realtime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_metrics(_minute_payments(spark, sf_dir), F.col("window.start"), _run_ts())


def suspicious_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = _minute_payments(spark, sf_dir)
    return minute_metrics(payments, F.col("window.start"), _run_ts(), extras=True)


def silver_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_transactions(scored_payments(spark, sf_dir))


def merchant_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchant_hourly_kpis(silver_curated(spark, sf_dir))


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_fraud_hotspots(silver_curated(spark, sf_dir))


def dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_transactions(silver_curated(spark, sf_dir), _run_date(), _run_ts())


def dq_audit_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit over rows with repeated ids, where a check fails."""
    return audit_transactions(scored_payments(spark, sf_dir), _run_date(), _run_ts())


def dq_missing_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_transactions(silver_curated(spark, sf_dir), _run_date(), _run_ts(), extras=True)


def messages_to_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From message text to gold in one plan."""
    payments = deduplicated_payments(raw_messages(spark, sf_dir), _as_of())
    return country_fraud_hotspots(curate_transactions(payments))


def period_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over a closed period, read back from its bronze table."""
    lake = Lake(shared_dir(spark, "period"))
    process_period(spark, raw_messages(spark, sf_dir), lake, "all", _as_of(), _run_ts())
    return lake.read(spark, tables.BRONZE)


def period_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period run over all messages twice as often and then over the given ones: the last run stands."""
    lake = Lake(shared_dir(spark, "period"))
    messages = raw_messages(spark, sf_dir)
    more = messages.withColumn("publish_ts", F.col("publish_ts") + F.expr("interval 30 days"))
    process_period(spark, messages.unionByName(more), lake, "all", _as_of(), _run_ts())
    process_period(spark, messages, lake, "all", _as_of(), _run_ts())
    return lake.read(spark, tables.BRONZE)


def period_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(shared_dir(spark, "period"))
    process_period(spark, raw_messages(spark, sf_dir), lake, "all", _as_of(), _run_ts())
    return lake.read(spark, tables.ALERTS)


def _rebuilt(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(shared_dir(spark, "warehouse"))
    lake.write_batch(scored_payments(spark, sf_dir), tables.BRONZE, "fixture")
    rebuild_warehouse(spark, lake, _run_date(), _run_ts())
    return lake


def warehouse_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebuilt(spark, sf_dir).read(spark, tables.MERCHANT_KPIS)


def warehouse_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebuilt(spark, sf_dir).read(spark, tables.SILVER)


def warehouse_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebuilt(spark, sf_dir).read(spark, tables.COUNTRY_HOTSPOTS)


def warehouse_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebuilt(spark, sf_dir).read(spark, tables.AUDIT)


def corrected(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake where one publish date was wrong at first: other amounts, ids that do not exist, rows of another date.

    Silver and gold are built from that, and then refreshed after the date was replaced.
    """
    lake = Lake(shared_dir(spark, "incremental"))
    rows = scored_payments(spark, sf_dir)
    date = F.col("transaction_date").cast("string")
    id_number = F.substring("transaction_id", 5, 12).cast("bigint")
    other = rows.withColumns(
        {
            "amount": F.when(date == CORRECTED_DATE, F.col("amount") * 2).otherwise(F.col("amount")),
            "transaction_id": F.when(
                (date == CORRECTED_DATE) & (id_number % 4 == 0), F.concat("transaction_id", F.lit("-X"))
            ).otherwise(F.col("transaction_id")),
        }
    )
    # Newer rows of ids of the day before, which silver must give up again.
    moved = rows.where((date < CORRECTED_DATE) & (id_number % 7 == 0)).withColumns(
        {
            "transaction_ts": F.col("transaction_ts") + F.expr("interval 1 day"),
            "transaction_date": F.lit(CORRECTED_DATE).cast("date"),
        }
    )
    lake.write_batch(other.unionByName(moved), tables.BRONZE, date, "first")
    refresh_changed(spark, lake)
    lake.replace_batch(spark, {tables.BRONZE: rows.where(date == CORRECTED_DATE)}, CORRECTED_DATE)
    refresh_changed(spark, lake)
    return lake


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected(spark, sf_dir).read(spark, tables.SILVER)


def incremental_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected(spark, sf_dir).read(spark, tables.MERCHANT_KPIS)


def incremental_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected(spark, sf_dir).read(spark, tables.COUNTRY_HOTSPOTS)


def streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """What the stream itself publishes: several micro-batches, rows late by less than is allowed, no close.

    The queries are stopped and started again between the micro-batches.
    """
    lake = Lake(shared_dir(spark, "streamed"))
    folder = f"{lake.root}/messages"
    arrival = F.unix_seconds("publish_ts") - START + F.crc32(F.col("raw_message").cast("binary")) % LATEST_ARRIVAL
    given = raw_messages(spark, sf_dir).withColumn("arrival", arrival)
    given.write.parquet(f"{lake.root}/given")
    given = spark.read.parquet(f"{lake.root}/given")
    for first, last in zip(ARRIVALS, ARRIVALS[1:]):
        arrived = given.where((F.col("arrival") >= first) & (F.col("arrival") < last)).drop("arrival")
        arrived.write.mode("append").parquet(folder)
        start_processing(stream_from_files(spark, folder), lake, _as_of(), ONCE).awaitTermination()
        start_publishing(spark, lake, _run_ts(), ONCE).awaitTermination()
    return lake


def streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).read(spark, tables.BRONZE)


def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).read(spark, tables.ALERTS)


def streamed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).read(spark, tables.METRICS)


def stream_update_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live metrics over files that each hold rows of all times, so that all but the first change written minutes."""
    lake = Lake(shared_dir(spark, "live"))
    messages = message_stream(spark, sf_dir, f"{lake.root}/messages")
    start_processing(messages, lake, _as_of(), ONCE).awaitTermination()
    start_live_metrics(spark, lake, _run_ts(), ONCE, maxFilesPerTrigger="3").awaitTermination()
    return live_metrics(spark, lake)


def message_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The raw messages in files that each hold rows of all times, as many micro-batches as ``MESSAGE_FILES``.

    Most rows are late by over 300 s after the first micro-batch. Each of them
    has a file for every core, as a file of one row group is read by one task.
    """
    each = spark.sparkContext.defaultParallelism
    raw_messages(spark, sf_dir).repartition(MESSAGE_FILES * each).write.parquet(folder)
    return stream_from_files(spark, folder, maxFilesPerTrigger=str(each))


def drained(spark: SparkSession, sf_dir: str) -> Lake:
    """Run the streaming jobs until everything given is published."""
    lake = Lake(shared_dir(spark, "stream"))
    messages = message_stream(spark, sf_dir, f"{lake.root}/messages")
    drain(spark, messages, lake, _as_of(), _run_ts(), maxFilesPerTrigger="3")
    return lake


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(spark, sf_dir).read(spark, tables.BRONZE)


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(spark, sf_dir).read(spark, tables.ALERTS)


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(drained(spark, sf_dir).read(spark, tables.DEAD_LETTERS))


def period_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of a period that was run twice, beside those of another one without any."""
    lake = Lake(shared_dir(spark, "period"))
    messages = raw_messages(spark, sf_dir)
    for period, given in (("all", messages), ("none", messages.limit(0)), ("all", messages)):
        process_period(spark, given, lake, period, _as_of(), _run_ts())
    return _identified(lake.read(spark, tables.DEAD_LETTERS))


def replayed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after the dead letters of the stream were replayed, twice, with their currency mended."""
    lake = drained(spark, sf_dir)
    for _ in range(2):
        replay_dead_letters(
            spark,
            lake,
            lambda text: F.regexp_replace(text, '"currency":"us"', '"currency":"usd"'),
            _as_of(),
            _run_ts(),
        )
    return lake.read(spark, tables.BRONZE)


def warehouse_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hotspots as a table of the catalog, in its namespace."""
    lake = Lake(shared_dir(spark, "named"))
    lake.write_batch(scored_payments(spark, sf_dir), tables.BRONZE, "fixture")
    rebuild_warehouse(spark, lake, _run_date(), _run_ts())
    lake.define(spark, tables.COUNTRY_HOTSPOTS)
    return spark.table(tables.COUNTRY_HOTSPOTS.full_name).select(*tables.COUNTRY_HOTSPOTS.schema.fieldNames())


def observed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of rows with repeated ids, from checks that were taken while they were written as silver."""
    lake = Lake(shared_dir(spark, "observed"))
    rows = _as_silver(scored_payments(spark, sf_dir))
    observed = lake.replace(rows, tables.SILVER, observed_checks())
    return audit_observed(lake.read(spark, tables.SILVER), observed, _run_date(), _run_ts())


def _as_silver(rows: DataFrame) -> DataFrame:
    flags = {name: F.lit(False) for name in ("is_cross_border", "is_declined", "requires_manual_review")}
    return rows.withColumns(flags).select(*SILVER.fieldNames())


def dq_missing_attrs_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit over silver with merchants of blanks alone and countries that are empty or absent."""
    silver = silver_curated(spark, sf_dir)
    number = F.substring("transaction_id", 5, 12).cast("bigint")
    spoiled = silver.withColumns(
        {
            "merchant_id": F.when(number % 9 == 0, F.lit("\t ")).otherwise(F.col("merchant_id")),
            "txn_country": F.when(number % 13 == 0, "").when(number % 17 != 0, F.col("txn_country")),
        }
    )
    return audit_transactions(spoiled, _run_date(), _run_ts(), extras=True)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(spark, sf_dir).read(spark, tables.METRICS)


def stream_chained_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics from two chained stateful steps with a file sink of their own."""
    lake = Lake(shared_dir(spark, "stream"))
    folder = f"{lake.root}/messages"
    # Without a later pass over the date, all has to come in one micro-batch and be followed by a later row.
    raw_messages(spark, sf_dir).unionByName(heartbeat(spark)).write.parquet(folder)
    messages = stream_from_files(spark, folder)
    start_processing(messages, lake, _as_of(), {"availableNow": True}).awaitTermination()
    staged = read_staged(spark, lake, "valid")
    path = f"{lake.root}/metrics"
    (
        chained_metrics(staged, _run_ts())
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", lake.checkpoint_path("metrics"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(tables.METRICS.schema).parquet(path)


CASES = {
    "risk_scoring": risk_scoring,
    "normalized_events": normalized_events,
    "dead_letter": dead_letter,
    "dead_letter_replay": dead_letter_replay,
    "raw_validation": raw_validation,
    "windowed_dedup": windowed_dedup,
    "flagged_transactions": flagged_transactions,
    "realtime_metrics": realtime_metrics,
    "suspicious_share": suspicious_share,
    "silver_curated": silver_curated,
    "merchant_hourly_kpis": merchant_kpis,
    "country_fraud_hotspots": hotspots,
    "dq_audit": dq_audit,
    "dq_audit_bronze": dq_audit_bronze,
    "dq_missing_attrs": dq_missing_attrs,
    "messages_to_hotspots": messages_to_hotspots,
    "period_bronze": period_bronze,
    "period_alerts": period_alerts,
    "period_rerun": period_rerun,
    "warehouse_silver": warehouse_silver,
    "warehouse_hotspots": warehouse_hotspots,
    "warehouse_merchants": warehouse_merchants,
    "warehouse_audit": warehouse_audit,
    "incremental_silver": incremental_silver,
    "incremental_merchants": incremental_merchants,
    "incremental_hotspots": incremental_hotspots,
    "streamed_bronze": streamed_bronze,
    "streamed_alerts": streamed_alerts,
    "streamed_metrics": streamed_metrics,
    "stream_update_metrics": stream_update_metrics,
    "stream_bronze": stream_bronze,
    "stream_alerts": stream_alerts,
    "stream_metrics": stream_metrics,
    "stream_chained_metrics": stream_chained_metrics,
    "stream_dead_letters": stream_dead_letters,
    "period_dead_letters": period_dead_letters,
    "replayed_bronze": replayed_bronze,
    "warehouse_by_name": warehouse_by_name,
    "dq_missing_attrs_failing": dq_missing_attrs_failing,
    "observed_audit": observed_audit,
}


def registered(name: str):
    """The query ``name`` with the required settings put on the caller's session."""
    case = CASES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(case(configure(spark), sf_dir))

    run.__name__ = name
    return run
