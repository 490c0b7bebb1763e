"""The streaming jobs against the batch form, with late rows and restarts."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import cases
from fixtures.payments import heartbeat, raw_messages
from paywarden.plans.batch import deduplicated_payments, process_period
from paywarden.schemas import BRONZE, RAW_STREAM
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake, Superseded
from paywarden.sources.raw import read_dead_letters, stream_from_files
from paywarden.streaming.jobs import (
    chained_metrics,
    close_date,
    drain,
    live_metrics,
    read_staged,
    replay_dead_letters,
    start_dead_letters,
    start_live_metrics,
    start_processing,
    start_publishing,
)
from tests.conftest import SMALL, event, messages

AS_OF = "publish_ts"
RUN_TS = "2024-06-01 00:00:00"
ONCE = {"availableNow": True}


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def put(spark, folder, payloads, publish):
    """One more file for the stream, as one micro-batch."""
    rows = messages(spark, payloads, publish).drop("n")
    rows.coalesce(1).write.mode("append").parquet(str(folder))


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_the_stream_gives_what_the_batch_gives(spark, tmp_path):
    source = tmp_path / "in"
    raw = raw_messages(spark, SMALL)
    raw.repartition(2).write.parquet(str(source))
    stream, batch = Lake(str(tmp_path / "stream")), Lake(str(tmp_path / "batch"))
    drain(spark, stream_from_files(spark, str(source)), stream, AS_OF, run_ts())
    process_period(spark, raw, batch, "0", AS_OF, run_ts())

    for table in (tables.BRONZE, tables.ALERTS, tables.METRICS):
        found = rows_of(stream.read(spark, table))
        assert found and found == rows_of(batch.read(spark, table))
    letters = rows_of(stream.read(spark, tables.DEAD_LETTERS))
    assert letters == rows_of(batch.read(spark, tables.DEAD_LETTERS))
    assert letters == rows_of(read_dead_letters(spark, stream.dead_letter_path))
    assert len(letters) == 240

    line = next(Path(stream.dead_letter_path).rglob("*.json")).read_text().splitlines()[0]
    record = json.loads(line)
    assert set(record) == {"received_ts", "error_count", "errors", "raw_message"}
    assert record["received_ts"].endswith("Z")

    # The runs of the stream no longer count and go once nobody reads them.
    assert stream.remove_superseded(spark, hours=1) == 0
    assert stream.remove_superseded(spark, hours=0) >= 0
    # The rows of a date and batch end up in one file, whatever the number of state partitions.
    files = Path(stream.path(tables.BRONZE)).rglob("*.parquet")
    folders = [f.parent for f in files]
    assert folders and len(folders) == len(set(folders))
    # Closing a date leaves one run of it.
    assert all("run_id=closed" in str(f) for f in folders)
    for table in (tables.BRONZE, tables.ALERTS, tables.METRICS):
        assert rows_of(stream.read(spark, table)) == rows_of(batch.read(spark, table))

    # The chained form of the metrics has a state of its own and the same result.
    path = str(tmp_path / "metrics")
    whole = Lake(str(tmp_path / "whole"))
    raw.unionByName(heartbeat(spark)).write.parquet(str(tmp_path / "closed"))
    closed = stream_from_files(spark, str(tmp_path / "closed"))
    start_processing(closed, whole, AS_OF, ONCE).awaitTermination()
    query = (
        chained_metrics(read_staged(spark, whole, "valid"), run_ts())
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", whole.checkpoint_path("metrics"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    chained = spark.read.schema(tables.METRICS.schema).parquet(path)
    assert rows_of(chained) == rows_of(stream.read(spark, tables.METRICS))


def test_late_rows_duplicates_and_restarts(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))

    def run():
        start_processing(stream_from_files(spark, str(source)), lake, AS_OF, ONCE).awaitTermination()
        start_publishing(spark, lake, run_ts(), ONCE).awaitTermination()

    # The earlier event of a repeated id arrives second, in another micro-batch.
    put(spark, source, [event(city="second", transaction_ts="2024-05-01T10:00:30Z")], "2024-05-01T10:02:00")
    run()
    put(spark, source, [event(city="first"), event(amount=-1)], "2024-05-01T10:02:30")
    run()
    # The same id in another minute stays, and a row late by under 300 s is accepted.
    put(spark, source, [event(city="other minute")], "2024-05-01T10:06:00")
    run()
    put(spark, source, [event(transaction_id="late", city="late")], "2024-05-01T10:02:10")
    run()
    assert not Path(lake.path(tables.BRONZE)).exists() or lake.read(spark, tables.BRONZE).count() == 0
    # The watermark passes the first minutes; later rows for them are dropped.
    put(spark, source, [event(transaction_id="far", city="far")], "2024-05-01T12:00:00")
    run()
    put(spark, source, [event(transaction_id="far 2", city="far 2")], "2024-05-01T12:00:10")
    run()
    put(spark, source, [event(transaction_id="too late", city="too late")], "2024-05-01T10:02:20")
    run()
    heartbeat(spark).write.mode("append").parquet(str(source))
    run()

    bronze = lake.read(spark, tables.BRONZE)
    assert bronze.columns == BRONZE.fieldNames()
    assert sorted(r.city for r in bronze.collect()) == ["far", "far 2", "first", "late", "other minute"]
    metrics = lake.read(spark, tables.METRICS).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.total_transactions) for r in metrics] == [(2, 2), (6, 1), (0, 2)]
    assert lake.read(spark, tables.ALERTS).count() == 5

    # What came too late is published when its date is closed, and nothing twice, however often.
    for _ in range(2):
        close_date(spark, lake, date(2024, 5, 1), run_ts())
    everything = ["far", "far 2", "first", "late", "other minute", "too late"]
    assert sorted(r.city for r in lake.read(spark, tables.BRONZE).collect()) == everything
    metrics = lake.read(spark, tables.METRICS).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.total_transactions) for r in metrics] == [(2, 3), (6, 1), (0, 2)]
    assert lake.read(spark, tables.ALERTS).count() == 6


def test_the_stream_leaves_a_closed_date_alone(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    put(spark, source, [event()], "2024-05-01T10:02:00")
    drain(spark, stream_from_files(spark, str(source)), lake, AS_OF, run_ts())
    assert lake.read(spark, tables.BRONZE).count() == 1
    # The minute of the first drain is still in the state and leaves it now.
    put(spark, source, [event(transaction_id="next day")], "2024-05-02T10:00:00")
    once = stream_from_files(spark, str(source))
    start_processing(once, lake, AS_OF, ONCE).awaitTermination()
    start_publishing(spark, lake, run_ts(), ONCE).awaitTermination()
    assert lake.read(spark, tables.BRONZE).count() == 1
    close_date(spark, lake, date(2024, 5, 2), run_ts())
    assert lake.read(spark, tables.BRONZE).count() == 2


def published(spark, source, lake):
    start_processing(stream_from_files(spark, str(source)), lake, AS_OF, ONCE).awaitTermination()
    start_publishing(spark, lake, run_ts(), ONCE).awaitTermination()


def open_date(spark, tmp_path):
    """A lake with three minutes of a date, the first of them published by the stream."""
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    put(spark, source, [event(), event(transaction_id="b")], "2024-05-01T10:02:00")
    published(spark, source, lake)
    put(spark, source, [event(transaction_id="c")], "2024-05-01T10:20:00")
    published(spark, source, lake)
    assert lake.read(spark, tables.BRONZE).count() == 2
    return source, lake


OUTPUTS = (tables.BRONZE, tables.ALERTS, tables.METRICS)
DAY = date(2024, 5, 1)


def test_a_micro_batch_during_a_close_leaves_each_minute_once(spark, tmp_path, monkeypatch):
    source, lake = open_date(spark, tmp_path)
    put(spark, source, [event(transaction_id="d")], "2024-05-01T10:40:00")
    write = Lake.write_batch

    def meanwhile(self, rows, table, batch_id, run_id="all"):
        write(self, rows, table, batch_id, run_id)
        if table is tables.BRONZE and run_id.startswith("closed"):
            # The minute of "c" leaves the state and is written while the close is under way.
            monkeypatch.setattr(Lake, "write_batch", write)
            published(spark, source, lake)
            assert sorted(r.transaction_id for r in lake.read(spark, tables.BRONZE).collect()) == ["P-7f3a", "b", "c"]

    monkeypatch.setattr(Lake, "write_batch", meanwhile)
    close_date(spark, lake, DAY, run_ts())
    assert sorted(r.transaction_id for r in lake.read(spark, tables.BRONZE).collect()) == ["P-7f3a", "b", "c"]
    assert sum(r.total_transactions for r in lake.read(spark, tables.METRICS).collect()) == 3
    close_date(spark, lake, DAY, run_ts())
    assert lake.read(spark, tables.ALERTS).count() == 4


def test_a_failing_close_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    _, lake = open_date(spark, tmp_path)
    before = [rows_of(lake.read(spark, table)) for table in OUTPUTS]
    write = Lake.write_batch

    def failing(self, rows, table, batch_id, run_id="all"):
        if table is tables.METRICS:
            raise OSError("disk full")
        write(self, rows, table, batch_id, run_id)

    monkeypatch.setattr(Lake, "write_batch", failing)
    with pytest.raises(OSError):
        close_date(spark, lake, DAY, run_ts())
    assert [rows_of(lake.read(spark, table)) for table in OUTPUTS] == before
    monkeypatch.setattr(Lake, "write_batch", write)
    close_date(spark, lake, DAY, run_ts())
    assert [lake.read(spark, table).count() for table in OUTPUTS] == [3, 3, 2]


def test_of_two_closes_at_a_time_one_fails(spark, tmp_path, monkeypatch):
    _, lake = open_date(spark, tmp_path)
    write = Lake.write_batch

    def meanwhile(self, rows, table, batch_id, run_id="all"):
        monkeypatch.setattr(Lake, "write_batch", write)
        close_date(spark, lake, DAY, run_ts())
        write(self, rows, table, batch_id, run_id)

    monkeypatch.setattr(Lake, "write_batch", meanwhile)
    with pytest.raises(Superseded):
        close_date(spark, lake, DAY, run_ts())
    assert [lake.read(spark, table).count() for table in OUTPUTS] == [3, 3, 2]
    # A note whose writer failed before its text is passed over.
    (Path(lake.root) / "_versions/batches/batch=2024-05-01.1").touch()
    assert lake.read(spark, tables.BRONZE).count() == 3
    close_date(spark, lake, DAY, run_ts())
    assert list(lake.current_runs(spark).values())[0].startswith("closed-000002")


def test_live_metrics_take_in_rows_of_any_lateness(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))

    def run():
        start_processing(stream_from_files(spark, str(source)), lake, AS_OF, ONCE).awaitTermination()
        start_live_metrics(spark, lake, run_ts(), ONCE).awaitTermination()
        rows = live_metrics(spark, lake).orderBy("window_start", "txn_country").collect()
        return [(r.window_start.hour, r.txn_country, r.total_transactions, r.approved_amount) for r in rows]

    put(spark, source, [event(transaction_ts="2024-05-01T10:00:30Z")], "2024-05-01T10:02:00")
    assert run() == [(10, "PT", 1, 1725.5)]
    put(spark, source, [event(transaction_id="noon", amount=2)], "2024-05-01T12:00:00")
    assert run() == [(10, "PT", 1, 1725.5), (12, "PT", 1, 2.0)]
    # Far behind any watermark: one more payment, and an earlier copy that moves the first one to another country.
    late = [event(transaction_id="late", amount=3), event(transaction_ts="2024-05-01T10:00:00Z", txn_country="fr", amount=4)]
    put(spark, source, late, "2024-05-01T10:02:59")
    assert run() == [(10, "FR", 1, 4.0), (10, "PT", 1, 3.0), (12, "PT", 1, 2.0)]
    assert run() == [(10, "FR", 1, 4.0), (10, "PT", 1, 3.0), (12, "PT", 1, 2.0)]
    assert lake.read(spark, tables.PANES).count() == 4
    # A closed date comes from the metrics table, without its panes.
    close_date(spark, lake, DAY, run_ts())
    assert lake.read(spark, tables.PANES).count() == 0
    assert run() == [(10, "FR", 1, 4.0), (10, "PT", 1, 3.0), (12, "PT", 1, 2.0)]


def test_letters_of_stream_and_periods_are_replayed_once(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    put(spark, source, [event(), event(transaction_id="b", currency="us"), event(transaction_id="c", amount=-1)], "2024-05-01T10:02:00")
    drain(spark, stream_from_files(spark, str(source)), lake, AS_OF, run_ts())
    raw = messages(spark, [event(transaction_id="p", currency="us")], "2024-05-02T09:00:00").drop("n")
    for _ in range(2):
        process_period(spark, raw, lake, "7", AS_OF, run_ts())
    assert lake.read(spark, tables.DEAD_LETTERS).count() == 3

    def mended(text):
        return F.regexp_replace(text, '"currency": "us"', '"currency": "usd"')

    found = [replay_dead_letters(spark, lake, mended, F.col("publish_ts"), run_ts()) for _ in range(2)]
    assert [[str(day) for day in days] for days in found] == [["2024-05-01", "2024-05-02"], []]
    assert sorted(r.transaction_id for r in lake.read(spark, tables.BRONZE).collect()) == ["P-7f3a", "b", "p"]
    assert lake.read(spark, tables.DEAD_LETTERS).count() == 3


def test_all_outputs_start_on_an_empty_lake(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    source.mkdir()
    for _ in range(2):
        queries = [
            start_publishing(spark, lake, run_ts(), ONCE),
            start_dead_letters(spark, lake, ONCE),
            start_live_metrics(spark, lake, run_ts(), ONCE),
            start_processing(stream_from_files(spark, str(source)), lake, AS_OF, ONCE),
        ]
        for query in queries:
            query.awaitTermination()
        put(spark, source, [event(), event(amount=0)], "2024-05-01T10:02:00")
    start_live_metrics(spark, lake, run_ts(), ONCE).awaitTermination()
    start_dead_letters(spark, lake, ONCE).awaitTermination()
    assert live_metrics(spark, lake).count() == 1 and lake.read(spark, tables.DEAD_LETTERS).count() == 1


def test_a_shorter_run_of_a_period_leaves_nothing_of_the_longer_one(spark, tmp_path):
    lake = Lake(str(tmp_path))
    both = messages(
        spark,
        [event(), event(transaction_id="b", transaction_ts="2024-05-02T10:00:00Z")],
        ["2024-05-01T10:02:00", "2024-05-02T10:02:00"],
    ).drop("n")
    other = messages(spark, [event(transaction_id="other")]).drop("n")
    process_period(spark, other, lake, "2024-05-03 10:00", AS_OF, run_ts())
    for count, raw in ((2, both), (1, both.limit(1)), (0, both.limit(0))):
        process_period(spark, raw, lake, "7", AS_OF, run_ts())
        for table in (tables.BRONZE, tables.ALERTS, tables.METRICS):
            assert lake.read(spark, table).count() == count + 1


def test_a_period_run_again_is_there_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw = messages(spark, [event(), event(amount=0)]).drop("n")
    for _ in range(2):
        process_period(spark, raw, lake, "7", AS_OF, run_ts())
    assert lake.read(spark, tables.BRONZE).count() == 1
    assert lake.read(spark, tables.METRICS).count() == 1
    assert lake.read(spark, tables.DEAD_LETTERS).count() == 1


def test_the_lazy_batch_form_equals_the_written_one(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw = raw_messages(spark, SMALL)
    process_period(spark, raw, lake, "0", AS_OF, run_ts())
    lazy = deduplicated_payments(raw, AS_OF).select(*BRONZE.fieldNames())
    assert rows_of(lazy) == rows_of(lake.read(spark, tables.BRONZE))


def test_stream_input_needs_no_inference(spark, tmp_path):
    put(spark, tmp_path / "in", [event()], "2024-05-01T10:02:00")
    stream = stream_from_files(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    assert stream.isStreaming and stream.schema == RAW_STREAM


def test_staged_rows_of_a_route_and_date_share_a_file(spark, tmp_path):
    """However many tasks read the messages of a micro-batch."""
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    given = [event(transaction_id=f"P-{i}", amount=i % 4) for i in range(40)]
    times = [f"2024-05-0{1 + i % 2}T10:02:00" for i in range(40)]
    messages(spark, given, times).drop("n").repartition(4).write.parquet(str(source))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    start_processing(stream_from_files(spark, str(source)), lake, AS_OF, ONCE).awaitTermination()
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before

    folders = [f.parent for f in Path(lake.staging_path).rglob("*.parquet")]
    assert len(folders) == len(set(folders)) == 3
    staged = spark.read.parquet(lake.staging_path)
    assert staged.groupBy("route").count().collect() and staged.count() == 40


def test_every_micro_batch_of_the_fixture_has_a_file_for_each_core(spark, tmp_path, monkeypatch):
    given = messages(spark, [event(transaction_id=f"P-{i}") for i in range(200)]).drop("n")
    monkeypatch.setattr(cases, "raw_messages", lambda *_: given)
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    stream = cases.message_stream(spark, SMALL, str(source))
    start_processing(stream, lake, AS_OF, ONCE).awaitTermination()

    cores = spark.sparkContext.defaultParallelism
    assert len(list(source.rglob("*.parquet"))) == cases.MESSAGE_FILES * cores
    commits = Path(lake.checkpoint_path("processing"), "commits").glob("[0-9]*")
    assert len(list(commits)) == cases.MESSAGE_FILES
