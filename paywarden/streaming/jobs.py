"""The streaming form of the message flow, as three queries over one lake.

1. ``start_processing`` parses and checks each message once and appends the
   result to a staging folder, split by route. Spark's file sink makes this
   exactly-once.
2. ``start_dead_letters`` copies the rejected route to JSON lines, and
   ``replay_dead_letters`` sends them through again.
3. ``start_publishing`` de-duplicates the valid route in state and writes
   bronze, alerts and metrics.
4. ``start_live_metrics`` writes the metrics of each minute again whenever a
   row for it comes in, however late.

A valid message that comes after the watermark has passed its minute is not
published by the stream, but it is staged. ``close_date`` publishes a date again
from all its staged rows, once it is over, and so takes in such rows however the
stream was cut into micro-batches. Until then they are counted as
``numRowsDroppedByWatermark`` in the progress of the publishing query.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paywarden import schemas
from paywarden.operators.alerts import high_risk_alerts
from paywarden.operators.dedup import ALLOWED_LATENESS, earliest_per_minute
from paywarden.operators.metrics import minute_metrics
from paywarden.operators.validate import process_messages
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake, Table, make_folder
from paywarden.sources.raw import replay_messages

VALID = "valid"
INVALID = "invalid"
DEAD_LETTER_WINDOW = "5 minutes"
# Shuffled bytes of one staged file. Later queries may take a number of files at a time, so few large
# ones keep the number of their micro-batches low, however many tasks read the messages.
STAGED_FILE = "128m"
STAGING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": STAGED_FILE,
}
# Dead letters are not part of what closing a date replaces.
LETTERS = "letters-"

STAGED = T.StructType(
    [
        T.StructField("publish_ts", T.TimestampType()),
        *[T.StructField(f.name, f.dataType) for f in schemas.BRONZE],
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("raw_message", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("publish_date", T.DateType()),
    ]
)


def staged_messages(messages: DataFrame, as_of: Column | str) -> DataFrame:
    """Processed messages with their route; the message text is kept for rejected rows only."""
    processed = process_messages(messages, as_of)
    rejected = F.size("errors") > 0
    return processed.withColumns(
        {
            "route": F.when(rejected, INVALID).otherwise(VALID),
            "raw_message": F.when(rejected, F.col("raw_message")),
            "publish_date": F.to_date("publish_ts"),
        }
    ).select(*STAGED.fieldNames())


def start_processing(
    messages: DataFrame, lake: Lake, as_of: Column | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Raw messages to the staging folder, a few files for each route and date of a micro-batch.

    Rows of one route and date come together first, as otherwise each task would write a file into every folder.
    """
    now = F.current_timestamp() if as_of is None else as_of
    staged = staged_messages(messages, now).hint("rebalance", "route", "publish_date")
    # The query keeps the settings that it starts with; without state it is planned with AQE.
    with _settings(messages.sparkSession, STAGING):
        return (
            staged.writeStream.format("parquet")
            .partitionBy("route", "publish_date")
            .option("path", lake.staging_path)
            .option("checkpointLocation", lake.checkpoint_path("processing"))
            .trigger(**_trigger(trigger))
            .start()
        )


def read_staged(spark: SparkSession, lake: Lake, route: str, **options: str) -> DataFrame:
    """Stream of one route of the staging folder; files of the other are skipped."""
    make_folder(spark, lake.staging_path)
    staged = spark.readStream.schema(STAGED).options(**options).parquet(lake.staging_path)
    return staged.filter(F.col("route") == route)


def all_staged(spark: SparkSession, lake: Lake) -> DataFrame:
    """All rows staged by now, from the stream and from replayed dead letters."""
    for path in (lake.staging_path, lake.replayed_path):
        make_folder(spark, path)
    staged = spark.read.schema(STAGED).parquet(lake.staging_path)
    replayed = spark.read.schema(STAGED).parquet(lake.replayed_path).select(*staged.columns)
    return staged.unionAll(replayed)


def dead_letter_records(rejected: DataFrame, *more: Column) -> DataFrame:
    """Dead-letter records with the folder of their five publish minutes."""
    window_start = F.window("publish_ts", DEAD_LETTER_WINDOW)["start"]
    return rejected.select(
        F.col("processing_ts").alias("received_ts"),
        F.size("errors").alias("error_count"),
        "errors",
        "raw_message",
        F.date_format(window_start, "yyyyMMdd-HHmm").alias("window"),
        *more,
    )


def start_dead_letters(
    spark: SparkSession, lake: Lake, trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Rejected messages to JSON lines.

    There is no state, hence no row is too late for this output. A micro-batch
    that is run again replaces its files.
    """

    def write(batch: DataFrame, number: int) -> None:
        with _batch_planning(batch.sparkSession) as query_id:
            day = F.coalesce(F.to_date("publish_ts").cast("string"), F.lit("unknown"))
            letters = dead_letter_records(batch, F.concat(F.lit(LETTERS), day).alias(tables.BATCH))
            lake.write_batch(letters, tables.DEAD_LETTERS, F.col(tables.BATCH), f"{query_id}-{number}")

    return (
        read_staged(spark, lake, INVALID, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint_path("dead-letters"))
        .trigger(**_trigger(trigger))
        .start()
    )


def replay_dead_letters(
    spark: SparkSession,
    lake: Lake,
    repair: Callable[[Column], Column] | None = None,
    as_of: Column | None = None,
    run_ts: Column | None = None,
    **options: str,
) -> list[date]:
    """Process the dead letters that were not replayed yet, and publish those that are valid now.

    The letters are read as a stream with a checkpoint of its own, so each is
    replayed once, however often this runs; ``repair`` changes the text of the
    messages first. Messages that fail again stay the dead letters they are.
    The others are staged for the minute of their first receipt, and their
    dates, which are returned, are closed again with them. Replay letters of
    dates that are over; ``options`` are those of the file source, such as
    ``cleanSource``.
    """
    make_folder(spark, lake.dead_letter_path)
    letters = spark.readStream.schema(tables.DEAD_LETTERS.stored_schema).options(**options).json(lake.dead_letter_path)
    now = F.current_timestamp() if as_of is None else as_of
    closed: list[date] = []

    def publish(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        messages = replay_messages(batch.where(lake.counting(session)))
        if repair is not None:
            messages = messages.withColumn("raw_message", repair(F.col("raw_message")))
        valid = staged_messages(messages, now).where(F.col("route") == VALID)
        with _batch_planning(session) as query_id:
            path = f"{lake.replayed_path}/replay={query_id}-{number}"
            valid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("publish_date").parquet(path)
            written = session.read.schema(STAGED).parquet(path).select("publish_date").distinct().dropna()
            # A micro-batch is done when its dates are closed; if that fails, it is replayed and closed again.
            for day in sorted(row[0] for row in written.collect()):
                close_date(session, lake, day, run_ts)
                closed.append(day)

    (
        letters.writeStream.foreachBatch(publish)
        .option("checkpointLocation", lake.checkpoint_path("replay"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return sorted(set(closed))


def windowed_payments(valid: DataFrame) -> DataFrame:
    """The stateful de-duplication: rows of a minute appear once the watermark has passed it."""
    return earliest_per_minute(payment_columns(valid).withWatermark("publish_ts", ALLOWED_LATENESS))


def payment_columns(staged: DataFrame) -> DataFrame:
    """What bronze and its de-duplication need of staged rows."""
    return staged.select("publish_ts", *schemas.BRONZE.fieldNames())


def chained_metrics(valid: DataFrame, run_ts: Column) -> DataFrame:
    """Metrics alone as one streaming plan with two stateful steps, for a sink of its own."""
    return minute_metrics(windowed_payments(valid), F.window_time("window"), run_ts)


def publish_minutes(lake: Lake, payments: DataFrame, run_id: str, run_ts: Column) -> None:
    """Write bronze, alerts and metrics of whole minutes as one run of each of their publish dates.

    A date that was closed meanwhile is left alone: its staged rows are published already.
    """
    minutes = payments.select(F.col("window.start").alias("minute"), *schemas.BRONZE.fieldNames())
    publish_date = F.to_date("minute")
    # Several writes read the rows of the micro-batch; without this the de-duplication would run for each.
    minutes.persist()
    try:
        # One date as a rule, a few after an outage.
        found = {str(row[0]) for row in minutes.select(publish_date).distinct().collect()}
        # A date that is closed after this look is no harm: its note shuts this run out.
        for batch_id in sorted(found - set(lake.current_runs(minutes.sparkSession))):
            day = F.lit(batch_id).cast("date")
            outputs = minute_outputs(minutes.filter(publish_date == day), run_ts)
            for table, rows in outputs.items():
                lake.write_batch(rows, table, batch_id, run_id)
    finally:
        minutes.unpersist()


def minute_outputs(minutes: DataFrame, run_ts: Column) -> dict[Table, DataFrame]:
    """Bronze, alerts and metrics of de-duplicated payments with their ``minute``."""
    return {
        tables.BRONZE: minutes.drop("minute"),
        tables.ALERTS: high_risk_alerts(minutes, run_ts),
        tables.METRICS: minute_metrics(minutes, F.col("minute"), run_ts),
    }


def replace_minutes(
    spark: SparkSession,
    lake: Lake,
    staged: DataFrame,
    batch_id: str,
    run_ts: Column,
    more: Mapping[Table, DataFrame] | None = None,
) -> None:
    """Make the staged valid rows all that the batch holds of bronze, alerts and metrics, and ``more`` beside them.

    The de-duplicated rows are written once and read back by each output with
    only its columns, so nothing of a long period is held by the executors.
    """
    payments = earliest_per_minute(payment_columns(staged))
    minutes = payments.select(F.col("window.start").alias("minute"), *schemas.BRONZE.fieldNames())
    with lake.scratch(spark, "minutes") as path:
        minutes.write.parquet(path)
        written = spark.read.schema(minutes.schema).parquet(path)
        lake.replace_batch(spark, minute_outputs(written, run_ts) | dict(more or {}), batch_id)


def close_date(spark: SparkSession, lake: Lake, day: date, run_ts: Column | None = None) -> None:
    """Publish a date that is over again, from all valid rows staged for it.

    Rows that the stream dropped as late come in, and one run stands for the
    date's micro-batches, from one moment on and in all tables at once. What a
    micro-batch writes for the date after that, or wrote meanwhile, does not
    count. Rows staged later than this come in when the date is closed again.
    A close that fails changes nothing; of two at a time one fails.
    """
    staged = all_staged(spark, lake)
    rows = staged.filter((F.col("route") == VALID) & (F.col("publish_date") == F.lit(day)))
    now = F.current_timestamp() if run_ts is None else run_ts
    replace_minutes(spark, lake, rows, str(day), now)


def staged_dates(spark: SparkSession, lake: Lake) -> list[date]:
    """Publish dates that have valid rows."""
    staged = all_staged(spark, lake)
    found = staged.filter(F.col("route") == VALID).select("publish_date").distinct().dropna()
    return sorted(row[0] for row in found.collect())


def start_publishing(
    spark: SparkSession,
    lake: Lake,
    run_ts: Column | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Valid messages to bronze, alerts and metrics.

    In append mode a minute leaves the state whole and in one micro-batch. The
    metrics of that minute are therefore complete when computed inside the
    batch, without state or a watermark of their own. Each output goes to the
    partitions of its run, so a batch that is run again changes nothing.
    """
    now = F.current_timestamp() if run_ts is None else run_ts

    def publish(batch: DataFrame, number: int) -> None:
        with _batch_planning(batch.sparkSession) as query_id:
            publish_minutes(lake, batch, f"{query_id}-{number}", now)

    return (
        windowed_payments(read_staged(spark, lake, VALID, **options))
        .writeStream.outputMode("append")
        .foreachBatch(publish)
        .option("checkpointLocation", lake.checkpoint_path("publishing"))
        .trigger(**_trigger(trigger))
        .start()
    )


def refresh_panes(
    spark: SparkSession, lake: Lake, minutes: DataFrame, run_id: str, run_ts: Column, pane: int
) -> None:
    """Compute the given minutes' metrics from all their staged rows and add them as panes.

    A later copy of an id may take the place of an earlier one, so a pane is
    not summed up from arrivals: the minutes that changed are read again, and
    the bounds of their times let the scan skip the other files.
    """
    first, last = minutes.agg(F.min("minute"), F.max("minute")).first()
    if first is None:
        return
    end = F.lit(last) + F.expr("interval 1 minute")
    staged = all_staged(spark, lake).where(
        (F.col("route") == VALID)
        & F.col("publish_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
        & (F.col("publish_ts") >= F.lit(first))
        & (F.col("publish_ts") < end)
    )
    changed = staged.withColumn("minute", F.date_trunc("minute", "publish_ts")).join(minutes, "minute", "left_semi")
    payments = earliest_per_minute(payment_columns(changed))
    metrics = minute_metrics(payments, F.col("window.start"), run_ts).withColumn("pane", F.lit(pane).cast("bigint"))
    lake.write_batch(metrics, tables.PANES, F.date_format("window_start", "yyyy-MM-dd"), run_id)


def start_live_metrics(
    spark: SparkSession,
    lake: Lake,
    run_ts: Column | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Valid messages to metrics that change as rows come in.

    The query has no state and no watermark: a micro-batch only tells which
    minutes changed. ``live_metrics`` reads the newest pane of each.
    """
    now = F.current_timestamp() if run_ts is None else run_ts
    last = 0

    def publish(batch: DataFrame, number: int) -> None:
        nonlocal last
        last = max(last + 1, time.time_ns() // 1_000_000)
        minutes = batch.select(F.date_trunc("minute", "publish_ts").alias("minute")).dropna().distinct()
        with _batch_planning(batch.sparkSession) as query_id:
            refresh_panes(batch.sparkSession, lake, minutes, f"{query_id}-{number}", now, last)

    return (
        read_staged(spark, lake, VALID, **options)
        .select("publish_ts")
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", lake.checkpoint_path("live-metrics"))
        .trigger(**_trigger(trigger))
        .start()
    )


def live_metrics(spark: SparkSession, lake: Lake) -> DataFrame:
    """The newest pane of each minute; closed dates come from the metrics table."""
    names = schemas.METRICS.fieldNames()
    newest = F.max("pane").over(Window.partitionBy("window_start"))
    panes = lake.read(spark, tables.PANES).withColumn("newest", newest).where("pane = newest").select(*names)
    closed = list(lake.current_runs(spark))
    if not closed or not lake.written(spark, tables.METRICS):
        return panes
    final = lake.stored(spark, tables.METRICS).where(F.col(tables.BATCH).isin(*closed))
    return panes.unionByName(final.select(*names))


def drain(
    spark: SparkSession,
    messages: DataFrame,
    lake: Lake,
    as_of: Column | None = None,
    run_ts: Column | None = None,
    **staged_options: str,
) -> None:
    """Run the three queries over everything that is available, close its dates, and stop."""
    once = {"availableNow": True}
    start_processing(messages, lake, as_of, once).awaitTermination()
    start_dead_letters(spark, lake, once, **staged_options).awaitTermination()
    start_publishing(spark, lake, run_ts, once, **staged_options).awaitTermination()
    for day in staged_dates(spark, lake):
        close_date(spark, lake, day, run_ts)


@contextmanager
def _batch_planning(session: SparkSession) -> Iterator[str]:
    """Plan the writes of a micro-batch as batch jobs, with AQE; gives the id of the query.

    A stream plans its state without AQE, and without it the rebalance before a
    write would be left out. The id stays with the checkpoint: a query on a new
    one counts its batches from zero again and must not replace those of the old one.
    """
    with _settings(session, {"spark.sql.adaptive.enabled": "true"}):
        yield session.sparkContext.getLocalProperty("sql.streaming.queryId")


@contextmanager
def _settings(session: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {key: session.conf.get(key) for key in values}
    for key, value in values.items():
        session.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            session.conf.set(key, value)


def _trigger(trigger: dict | None) -> dict:
    # A minute is the window; shorter triggers would only write smaller files.
    return {"processingTime": "1 minute"} if trigger is None else trigger
