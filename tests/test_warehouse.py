"""De-duplication, silver, gold, audit and tables."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures.cases import scored_payments
from paywarden.functions.curve import interleaved
from paywarden.operators.curate import curate_transactions
from paywarden.operators.dedup import earliest_per_minute, latest_per_id
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis
from paywarden.operators.quality import audit_observed, audit_transactions, observed_checks
from paywarden.operators.validate import process_messages, valid_payments
from paywarden.plans.incremental import refresh_changed
from paywarden.plans.warehouse import rebuild_warehouse
from paywarden.schemas import (
    AUDIT,
    BRONZE,
    COUNTRY_HOTSPOTS,
    MERCHANT_KPIS,
    SILVER,
)
from paywarden.sources import lake as tables
from paywarden.sources.lake import Lake, require_values
from tests.conftest import SMALL, event, messages


def payments(spark, payloads, publish):
    rows = process_messages(messages(spark, payloads, publish), F.col("publish_ts"))
    return valid_payments(rows)


def test_the_stream_keeps_the_earliest_and_silver_the_latest(spark):
    rows = payments(
        spark,
        [
            event(transaction_ts="2024-05-01T10:00:05Z", city="second"),
            event(transaction_ts="2024-05-01T10:00:00Z", city="first"),
            event(transaction_ts="2024-05-01T10:01:30Z", city="next minute"),
        ],
        ["2024-05-01T10:02:00", "2024-05-01T10:02:59", "2024-05-01T10:03:00"],
    )
    kept = earliest_per_minute(rows)
    assert {r.city for r in kept.collect()} == {"first", "next minute"}
    assert [r.city for r in latest_per_id(kept.drop("window")).collect()] == ["next minute"]


def test_ties_go_to_the_first_published_and_the_last_processed(spark):
    rows = payments(
        spark,
        [event(city="b"), event(city="a"), event(city="c")],
        ["2024-05-01T10:02:02", "2024-05-01T10:02:01", "2024-05-01T10:02:30"],
    )
    assert earliest_per_minute(rows).first().city == "a"
    assert latest_per_id(rows).first().city == "c"


def test_a_hot_id_survives_as_one_row(spark):
    rows = payments(spark, [event()], "2024-05-01T10:02:00")
    many = rows.crossJoin(spark.range(20_000).select(F.col("id").alias("n"))).repartition(8)
    hot = many.withColumn(
        "transaction_ts", F.col("transaction_ts") + F.make_dt_interval(secs=F.col("n") % 50)
    ).drop("n")
    assert earliest_per_minute(hot).first().transaction_ts == rows.first().transaction_ts
    assert latest_per_id(hot).count() == 1


def test_silver_flags(spark):
    rows = payments(
        spark,
        [
            event(transaction_id="a", txn_country="NO"),
            event(transaction_id="b", txn_status="declined"),
            event(transaction_id="c", amount=10),
        ],
        "2024-05-01T10:02:00",
    )
    silver = curate_transactions(rows)
    assert silver.columns == SILVER.fieldNames()
    flags = {
        r.transaction_id: (r.is_cross_border, r.is_declined, r.requires_manual_review)
        for r in silver.collect()
    }
    assert flags == {"a": (False, False, True), "b": (True, True, True), "c": (True, False, False)}
    nulls = rows.limit(1).withColumn("txn_country", F.lit(None).cast("string"))
    assert curate_transactions(nulls).first().is_cross_border is False


def test_gold_by_hand(spark):
    rows = payments(
        spark,
        [
            event(transaction_id=str(i), amount=a, txn_status=s, transaction_ts=t)
            for i, (a, s, t) in enumerate(
                [
                    (10.1, "approved", "2024-05-01T09:59:59Z"),
                    (20.2, "declined", "2024-05-01T10:00:00Z"),
                    (1600, "approved", "2024-05-01T10:30:00Z"),
                ]
            )
        ],
        "2024-05-01T11:00:00",
    )
    silver = curate_transactions(rows)
    hours = merchant_hourly_kpis(silver)
    assert hours.columns == MERCHANT_KPIS.fieldNames()
    by_hour = {r.window_hour.hour: r for r in hours.collect()}
    assert (by_hour[9].gross_amount, by_hour[9].high_risk_pct) == (10.1, 100.0)
    assert (by_hour[10].total_transactions, by_hour[10].gross_amount) == (2, 1620.2)
    assert by_hour[10].avg_risk_score == 82.5
    spots = country_fraud_hotspots(silver)
    assert spots.columns == COUNTRY_HOTSPOTS.fieldNames()
    day = spots.first()
    assert (day.total_transactions, day.declined_transactions, day.decline_pct) == (3, 1, 33.33)
    assert day.total_amount == 1630.3


def test_audit_counts(spark):
    base = curate_transactions(payments(spark, [event()], "2024-05-01T10:02:00"))
    cases = [
        (None, 5.0, 10, "US"),
        ("twice", 5.0, 10, "US"),
        ("twice", 5.0, 10, "US"),
        ("twice", 5.0, 105, " "),
        ("zero", 0.0, 10, "US"),
        ("negative", -5.0, 10, "US"),
    ]
    changed = spark.createDataFrame(cases, "transaction_id string, amount double, risk_score int, txn_country string")
    rest = base.drop("transaction_id", "amount", "risk_score", "txn_country")
    silver = changed.crossJoin(rest)
    run = (F.lit("2024-05-02").cast("date"), F.lit("2024-05-02 01:00:00").cast("timestamp"))
    audit = audit_transactions(silver, *run, extras=True)
    assert audit.columns == AUDIT.fieldNames()
    assert {r.check_name: (r.status, r.failed_rows) for r in audit.collect()} == {
        "null_transaction_id_in_silver": ("FAIL", 1),
        "duplicate_transaction_id_in_silver": ("FAIL", 1),
        "negative_transaction_amount": ("FAIL", 2),
        "risk_score_above_100": ("WARN", 1),
        "missing_country_or_merchant": ("FAIL", 1),
    }
    empty = audit_transactions(silver.limit(0), *run).collect()
    assert [(r.status, r.failed_rows) for r in empty] == [("PASS", 0)] * 4


def test_a_batch_written_twice_is_there_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = scored_payments(spark, SMALL).drop("publish_ts")
    for batch_id in ("a", "b", "b"):
        lake.write_batch(rows, tables.BRONZE, batch_id)
    assert lake.read(spark, tables.BRONZE).count() == 2 * rows.count()
    assert lake.read(spark, tables.BRONZE).columns == BRONZE.fieldNames()


def test_the_rebuild_replaces_tables_and_appends_to_the_audit(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write_batch(scored_payments(spark, SMALL), tables.BRONZE, "a")
    for _ in range(2):
        audit = rebuild_warehouse(spark, lake)
    assert audit.count() == 8
    assert lake.read(spark, tables.SILVER).count() == 1000
    assert lake.read(spark, tables.COUNTRY_HOTSPOTS).agg(F.sum("total_transactions")).first()[0] == 1000
    assert lake.read(spark, tables.MERCHANT_KPIS).agg(F.sum("total_transactions")).first()[0] == 1000


def test_a_failed_rebuild_leaves_the_old_table(spark, tmp_path):
    lake = Lake(str(tmp_path))
    good = curate_transactions(scored_payments(spark, SMALL))
    lake.replace(good, tables.SILVER)
    torn = good.withColumn("city", F.when(F.col("amount") > 0, F.raise_error(F.lit("torn"))).otherwise(F.col("city")))
    for _ in range(2):
        with pytest.raises(Exception, match="torn"):
            lake.replace(torn, tables.SILVER)
        assert lake.read(spark, tables.SILVER).count() == 1000
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        for count in (3, 2, 1):
            lake.replace(good.limit(count), tables.SILVER)
            assert lake.read(spark, tables.SILVER).count() == count
    finally:
        spark.conf.set(mode, before)


def test_a_rebuild_fills_the_catalog(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for namespace in tables.NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace} LOCATION '{tmp_path}/db_{namespace}'")
    lake.write_batch(scored_payments(spark, SMALL).drop("publish_ts"), tables.BRONZE, "a")
    try:
        for _ in range(2):
            rebuild_warehouse(spark, lake, catalog=True)
            for table in (tables.BRONZE, tables.SILVER, tables.AUDIT, tables.MERCHANT_KPIS, tables.COUNTRY_HOTSPOTS):
                named = spark.table(table.full_name)
                assert named.count() == lake.read(spark, table).count() > 0
    finally:
        for namespace in tables.NAMESPACES:
            spark.sql(f"DROP DATABASE {namespace} CASCADE")


def test_catalog_tables_see_written_partitions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for namespace in tables.NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace} LOCATION '{tmp_path}/db_{namespace}'")
    lake.create_tables(spark)
    lake.create_tables(spark)
    lake.write_batch(scored_payments(spark, SMALL).drop("publish_ts"), tables.BRONZE, "a")
    lake.recover_partitions(spark, tables.BRONZE)
    assert spark.table("bronze.payment_transactions").count() == 1050
    for table in tables.TABLES:
        stored = {f.name: f.dataType for f in spark.table(table.full_name).schema}
        assert stored == {f.name: f.dataType for f in table.stored_schema}
    for namespace in tables.NAMESPACES:
        spark.sql(f"DROP DATABASE {namespace} CASCADE")


def test_every_writer_names_the_column_that_lacks_a_value(spark, tmp_path):
    lake = Lake(str(tmp_path))
    silver = curate_transactions(scored_payments(spark, SMALL))
    torn = silver.withColumn("merchant_id", F.lit(None).cast("string"))
    for write in (
        lambda: lake.replace(torn, tables.SILVER),
        lambda: lake.append(spark.createDataFrame([], AUDIT).unionAll(spark.sql("SELECT date'2024-05-01', null, 'PASS', 0L, '', timestamp'2024-05-01 00:00:00'")), tables.AUDIT),
    ):
        with pytest.raises(Exception, match="NULL in a required column: (merchant_id|check_name)"):
            write()
    with pytest.raises(Exception, match="NULL in a required column: city"):
        lake.write_batch(scored_payments(spark, SMALL).withColumn("city", F.lit(None).cast("string")), tables.BRONZE, "a")


def test_checks_observed_during_the_write_equal_the_audit(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = curate_transactions(scored_payments(spark, SMALL))
    amount = F.when(F.col("amount") > 900, -1.0).otherwise(F.col("amount"))
    bad = rows.withColumns({"amount": amount, "merchant_id": F.when(F.col("risk_score") > 60, "\t").otherwise(F.col("merchant_id"))})
    run = (F.lit("2024-05-02").cast("date"), F.lit("2024-05-02 01:00:00").cast("timestamp"))
    observed = lake.replace(bad, tables.SILVER, observed_checks(extras=True))
    silver = lake.read(spark, tables.SILVER)
    found = audit_observed(silver, observed, *run, extras=True)
    assert sorted(map(str, found.collect())) == sorted(map(str, audit_transactions(silver, *run, extras=True).collect()))
    assert observed["negative_transaction_amount"] > 0 and observed["missing_country_or_merchant"] > 0
    # Only the ids are read again.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<transaction_id:string>" in plan


def rows_scanned(frame):
    """Rows that the scans of a finished query passed on."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(i) for i in range(leaves.size())]
    stages = [p.plan() if "QueryStage" in p.nodeName() else p for p in plans]
    return sum(p.metrics().apply("numOutputRows").value() for p in stages)


def test_absent_ids_read_no_row_group(spark, tmp_path):
    lake = Lake(str(tmp_path), {"parquet.block.size": "65536", "parquet.enable.dictionary": "false", "parquet.page.size": "8192"})
    many = scored_payments(spark, SMALL).drop("publish_ts").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(19))))
    rows = many.withColumn("transaction_id", F.concat(F.md5(F.concat("transaction_id", "n"))))
    lake.write_batch(rows.drop("n"), tables.BRONZE, "a")
    bronze = lake.read(spark, tables.BRONZE)
    known = bronze.first().transaction_id
    absent = [f"{known[:4]}{n:028d}" for n in range(40)]
    total = bronze.count()
    assert rows_scanned(bronze.where(F.col("transaction_id") == known)) < total
    assert sum(rows_scanned(bronze.where(F.col("transaction_id") == i)) for i in absent) < 2 * total


def test_curve_interleaves_the_bits_of_first_letters(spark):
    texts = ["", None, " ", "7", "a", "B", "azure", "zebra", "Zoo", "{", "é", "gift_cards"]
    rows = [(x, y, z) for x in texts for y in texts[2:9] for z in texts[::3]]

    def code(text, letter):
        found = (text or "").lower()[letter : letter + 1]
        return min(max(ord(found) - 96, 0), 31) if found else 0

    def key(row):
        letters = 12 // len(row)
        bits = [[f"{code(text, n):05b}"[bit] for text in row] for n in range(letters) for bit in range(5)]
        return int("".join("".join(part) for part in bits), 2)

    frame = spark.createDataFrame(rows, "x string, y string, z string")
    for names in (["x", "y", "z"], ["z", "x"]):
        found = frame.select(*names, interleaved([F.col(n) for n in names]).alias("key")).collect()
        assert [r.key for r in found] == [key([r[n] for n in names]) for r in found]


def test_each_cluster_column_skips_row_groups(spark, tmp_path):
    """Filters on any one cluster column leave row groups out; a plain sort reads nearly all for the last."""
    small = {"parquet.block.size": "16384", "parquet.page.size": "4096"}
    many = scored_payments(spark, SMALL).drop("publish_ts").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(9))))
    one_date = F.lit("2024-01-01").cast("date")
    rows = many.withColumns({"transaction_id": F.md5(F.concat("transaction_id", "n")), "transaction_date": one_date})
    columns = tables.BRONZE.cluster
    lake, plain = Lake(str(tmp_path), small), str(tmp_path / "plain")
    lake.write_batch(rows.drop("n"), tables.BRONZE, "a")
    rows.drop("n").coalesce(1).sortWithinPartitions(*columns).write.options(**small, **dict(tables.BRONZE.options)).parquet(plain)
    laid, linear = lake.read(spark, tables.BRONZE), spark.read.parquet(plain)
    total = laid.count()

    def share(frame, column):
        values = [r[0] for r in frame.select(column).distinct().collect()]
        return sum(rows_scanned(frame.where(F.col(column) == value)) for value in values) / (total * len(values))

    assert share(laid, columns[-1]) < 0.8 * share(linear, columns[-1])
    assert all(share(laid, column) < 0.8 for column in columns)


def files_of(lake, table, day):
    return {str(f) for f in Path(lake.path(table)).rglob(f"*={day}/*.parquet")}


def test_a_corrected_date_leaves_the_files_of_others(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = scored_payments(spark, SMALL).drop("publish_ts")
    date = F.col("transaction_date").cast("string")
    lake.write_batch(rows, tables.BRONZE, date, "first")
    assert refresh_changed(spark, lake) is None
    assert refresh_changed(spark, lake) == []
    gold = (tables.SILVER, tables.MERCHANT_KPIS, tables.COUNTRY_HOTSPOTS)
    kept = [files_of(lake, table, day) for table in gold for day in ("2024-01-01", "2024-01-03")]
    assert all(kept)
    old = [files_of(lake, table, "2024-01-02") for table in gold]
    one_day = rows.where(date == "2024-01-02")
    lake.replace_batch(spark, {tables.BRONZE: one_day.limit(5)}, "2024-01-02")
    assert [str(day) for day in refresh_changed(spark, lake)] == ["2024-01-02"]
    assert [files_of(lake, table, day) for table in gold for day in ("2024-01-01", "2024-01-03")] == kept
    assert all(not files_of(lake, table, "2024-01-02") & files for table, files in zip(gold, old))
    spots = lake.read(spark, tables.COUNTRY_HOTSPOTS).where("transaction_date = '2024-01-02'")
    assert spots.agg(F.sum("total_transactions")).first()[0] == 5
    # A date that has no rows any more is gone from all tables.
    lake.replace_batch(spark, {tables.BRONZE: one_day.limit(0)}, "2024-01-02")
    assert [str(day) for day in refresh_changed(spark, lake)] == ["2024-01-02"]
    assert not any(files_of(lake, table, "2024-01-02") for table in gold)
    assert lake.read(spark, tables.SILVER).where("transaction_date = '2024-01-02'").isEmpty()
    # Runs that were read and are deleted by now cannot tell their ids, so all is rebuilt.
    lake.replace_batch(spark, {tables.BRONZE: one_day.limit(9)}, "2024-01-02")
    assert [str(day) for day in refresh_changed(spark, lake)] == ["2024-01-02"]
    lake.replace_batch(spark, {tables.BRONZE: one_day}, "2024-01-02")
    assert lake.remove_superseded(spark, hours=0) > 0
    assert refresh_changed(spark, lake) is None
    assert lake.read(spark, tables.SILVER).count() == 1000


def test_dates_are_replaced_from_the_table_itself_in_one_pass(spark, tmp_path):
    """Rows of the replaced dates may come from their own files, and are made once."""
    lake = Lake(str(tmp_path))
    rows = curate_transactions(scored_payments(spark, SMALL))
    lake.replace(rows, tables.SILVER)
    made = spark.sparkContext.accumulator(0)

    def counted(day):
        made.add(1)
        return day

    stored = lake.read(spark, tables.SILVER)
    kept = stored.where("transaction_date = '2024-01-02' and risk_score > 0").withColumn("amount", F.col("amount") + 1)
    n = kept.count()
    again = kept.withColumn("transaction_date", F.udf(counted, "date")("transaction_date"))
    lake.replace_partitions(again, tables.SILVER, [date(2024, 1, 2), date(2024, 1, 3)])
    assert made.value == n
    after = lake.read(spark, tables.SILVER)
    day = F.col("transaction_date").cast("string")
    expected = rows.where((day == "2024-01-01") | ((day == "2024-01-02") & (F.col("risk_score") > 0)))
    expected = expected.withColumn("amount", F.when(day == "2024-01-02", F.col("amount") + 1).otherwise(F.col("amount")))
    assert expected.exceptAll(after).isEmpty() and after.exceptAll(expected).isEmpty()
    assert not files_of(lake, tables.SILVER, "2024-01-03")


def test_a_refresh_that_failed_is_followed_by_a_rebuild(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    rows = scored_payments(spark, SMALL).drop("publish_ts")
    lake.write_batch(rows.limit(100), tables.BRONZE, "a", "1")
    refresh_changed(spark, lake)
    lake.write_batch(rows, tables.BRONZE, "b", "1")
    replace = Lake.replace_partitions

    def failing(self, rows, table, values):
        if table is tables.MERCHANT_KPIS:
            raise OSError("disk full")
        replace(self, rows, table, values)

    monkeypatch.setattr(Lake, "replace_partitions", failing)
    with pytest.raises(OSError):
        refresh_changed(spark, lake)
    assert refresh_changed(spark, lake) is None
    assert lake.read(spark, tables.MERCHANT_KPIS).agg(F.sum("total_transactions")).first()[0] == 1000


def test_a_missing_required_value_fails_the_write(spark, tmp_path):
    rows = scored_payments(spark, SMALL).drop("publish_ts").withColumn("city", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL in a required column"):
        require_values(rows, BRONZE).collect()
