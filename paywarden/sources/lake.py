"""Tables of the lake: names, layout, definitions, readers and writers."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden import schemas
from paywarden.functions.curve import interleaved

NAMESPACES = ("bronze", "silver", "gold", "ops")

# A replayed period or the publish date of a stream; it is replaced as a whole.
BATCH = "batch_id"
# One micro-batch in it, or all of it; writing it again replaces exactly its own files.
RUN = "run_id"
# A run that is to replace a batch; it counts from its note on, and never without one.
REPLACING = "closed-"
BATCH_NOTE = "batch_id string, version long, run_id string"


@dataclass(frozen=True)
class Table:
    """A Parquet table partitioned by date and sorted by its cluster columns inside each file."""

    namespace: str
    name: str
    schema: T.StructType
    partition: str
    cluster: tuple[str, ...]
    # Source of a partition column that the schema does not have.
    derived_from: str | None = None
    per_batch: bool = False
    # Rebuilt as a whole, in one of two folders in turn.
    versioned: bool = False
    form: str = "parquet"
    partition_type: T.DataType = T.DateType()
    options: tuple[tuple[str, str], ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def partitions(self) -> list[str]:
        return [BATCH, RUN, self.partition] if self.per_batch else [self.partition]

    @property
    def stored_schema(self) -> T.StructType:
        """Schema with the partition columns at the end, as a directory layout keeps them."""
        data = [f for f in self.schema if f.name != self.partition]
        kept = [f for f in self.schema if f.name == self.partition]
        keys = kept or [T.StructField(self.partition, self.partition_type)]
        if self.per_batch:
            keys = [T.StructField(BATCH, T.StringType()), T.StructField(RUN, T.StringType()), *keys]
        return T.StructType(data + keys)


# Ids are spread over all files, so only a filter in each row group tells that it lacks one.
ID_FILTERS = (
    ("parquet.bloom.filter.enabled#transaction_id", "true"),
    ("parquet.bloom.filter.adaptive.enabled", "true"),
)

BRONZE = Table(
    "bronze",
    "payment_transactions",
    schemas.BRONZE,
    "transaction_date",
    ("risk_level", "txn_country", "merchant_category"),
    per_batch=True,
    options=ID_FILTERS,
)
ALERTS = Table(
    "ops",
    "flagged_transactions",
    schemas.ALERTS,
    "alert_date",
    ("risk_level", "txn_country", "merchant_category"),
    derived_from="transaction_ts",
    per_batch=True,
)
METRICS = Table(
    "ops",
    "realtime_fraud_metrics",
    schemas.METRICS,
    "window_date",
    ("txn_country", "merchant_category"),
    derived_from="window_start",
    per_batch=True,
)
# Complete metrics of a minute as they were at some time; the newest of a minute counts.
PANES = Table(
    "ops",
    "realtime_fraud_metrics_panes",
    schemas.METRIC_PANES,
    "window_date",
    ("txn_country", "merchant_category"),
    derived_from="window_start",
    per_batch=True,
)
AUDIT = Table("ops", "data_quality_audit", schemas.AUDIT, "run_date", ("check_name", "status"))
SILVER = Table(
    "silver",
    "transactions_curated",
    schemas.SILVER,
    "transaction_date",
    ("risk_level", "txn_country", "merchant_category"),
    versioned=True,
    options=ID_FILTERS,
)
MERCHANT_KPIS = Table(
    "gold",
    "merchant_risk_hourly_kpis",
    schemas.MERCHANT_KPIS,
    "window_date",
    ("merchant_category", "merchant_id"),
    derived_from="window_hour",
    versioned=True,
)
COUNTRY_HOTSPOTS = Table(
    "gold",
    "country_fraud_hotspots",
    schemas.COUNTRY_HOTSPOTS,
    "transaction_date",
    ("txn_country",),
    versioned=True,
)
# Rejected messages as JSON lines by five publish minutes; of the stream and of periods. Not in the catalog.
DEAD_LETTERS = Table(
    "",
    "dead-letter",
    schemas.DEAD_LETTER,
    "window",
    (),
    per_batch=True,
    form="json",
    partition_type=T.StringType(),
    options=(("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssX"),),
)
TABLES = (BRONZE, ALERTS, METRICS, PANES, AUDIT, SILVER, MERCHANT_KPIS, COUNTRY_HOTSPOTS)


class Superseded(RuntimeError):
    """Somebody else replaced the batch meanwhile; what this run wrote is not read."""


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder.

    A batch consists of all its runs until a note names the one run that it
    consists of from then on. A note is a file that is created once, so of two
    writers that replace the same batch one fails. It holds for all tables at
    once; before it readers get the old rows, after it the new ones, and never
    both. That needs a file system that creates files atomically.
    """

    root: str
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, table: Table) -> str:
        return "/".join(part for part in (self.root.rstrip("/"), table.namespace, table.name) if part)

    @property
    def staging_path(self) -> str:
        return f"{self.root.rstrip('/')}/bronze/_processed_messages"

    @property
    def replayed_path(self) -> str:
        """Staged messages that came from dead letters."""
        return f"{self.root.rstrip('/')}/bronze/_replayed_messages"

    @property
    def dead_letter_path(self) -> str:
        return self.path(DEAD_LETTERS)

    def checkpoint_path(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{query}"

    @contextmanager
    def scratch(self, spark: SparkSession, purpose: str) -> Iterator[str]:
        """A new folder that is deleted in the end."""
        path = f"{self.root.rstrip('/')}/_scratch/{purpose}-{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            _delete(spark, path)

    def current_runs(self, spark: SparkSession) -> dict[str, str]:
        """The run of each replaced batch: one entry for each date or period of the lake's life at most."""
        notes = _if_written(lambda: spark.read.schema(BATCH_NOTE).json(self._batch_notes))
        if notes is None:
            return {}
        latest = notes.groupBy(BATCH).agg(F.max_by(RUN, "version").alias(RUN))
        return {row[BATCH]: row[RUN] for row in latest.collect()}

    def create_tables(self, spark: SparkSession) -> None:
        """Define namespaces and tables in the catalog where they are absent."""
        for namespace in NAMESPACES:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
        for table in TABLES:
            self._define(spark, table, max(self._version(spark, table), 0))

    def publish_tables(self, spark: SparkSession) -> None:
        """Let the catalog see all that was written by path.

        A rebuilt table is defined anew over the folder that now holds it; only
        its definition is dropped for that, as the files are not the catalog's.
        """
        for table in TABLES:
            self.define(spark, table)

    def define(self, spark: SparkSession, table: Table) -> None:
        """Define a table by name over the folder and the partitions that hold it now."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.namespace}")
        if table.versioned:
            spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")
        self._define(spark, table, max(self._version(spark, table), 0))
        if self.written(spark, table):
            self.recover_partitions(spark, table)

    def recover_partitions(self, spark: SparkSession, table: Table) -> None:
        """Let the catalog see partitions that were written by path, but for runs that do not count."""
        spark.sql(f"ALTER TABLE {table.full_name} RECOVER PARTITIONS")
        if table.per_batch:
            current = self.current_runs(spark)
            listed = spark.sql(f"SHOW PARTITIONS {table.full_name}").collect()
            runs = {tuple(unquote(part.split("=", 1)[1]) for part in row[0].split("/")[:2]) for row in listed}
            for batch, run in sorted(runs):
                if current.get(batch, run) != run or (batch not in current and run.startswith(REPLACING)):
                    # The table is external, so its files stay.
                    spark.sql(
                        f"ALTER TABLE {table.full_name} DROP IF EXISTS PARTITION "
                        f"({BATCH} = {_literal(batch)}, {RUN} = {_literal(run)})"
                    )

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        """The table with exactly its documented columns; filters on the partition prune folders."""
        return self.stored(spark, table).select(*table.schema.fieldNames())

    def stored(self, spark: SparkSession, table: Table) -> DataFrame:
        """The table with its partition columns, without runs that do not count, no longer or not yet."""
        rows = self.all_runs(spark, table)
        return rows.where(self.counting(spark)) if table.per_batch else rows

    def counting(self, spark: SparkSession) -> Column:
        """Whether a run counts: on partition columns alone, so folders that do not are not even listed for a scan."""
        counts = ~F.col(RUN).startswith(REPLACING)
        current = self.current_runs(spark)
        if not current:
            return counts
        noted = F.concat(F.col(BATCH), F.lit("/"), F.col(RUN)).isin(*(f"{b}/{r}" for b, r in current.items()))
        return (counts & ~F.col(BATCH).isin(*current)) | noted

    def all_runs(self, spark: SparkSession, table: Table) -> DataFrame:
        """All that is stored of a table, also what no longer counts."""
        path = self._folder(table, self._version(spark, table))
        return spark.read.schema(table.stored_schema).format(table.form).load(path)

    def written(self, spark: SparkSession, table: Table) -> bool:
        return _if_written(lambda: self.all_runs(spark, table)) is not None

    def replace(
        self, rows: DataFrame, table: Table, seen: Mapping[str, Column] | None = None
    ) -> dict[str, int]:
        """Rebuild the whole table; until its files are complete, readers get the old one.

        The rows go to the folder that is not in use, and the version is noted
        afterwards. A rebuild that fails leaves the old version noted. The
        aggregates of ``seen`` are taken from the rows as they are written and
        returned: in the last stage, of which each task counts once, however
        often it or an earlier one is repeated.
        """
        spark = rows.sparkSession
        version = self._version(spark, table) + 1
        laid = _laid_out(rows, table)
        observation = Observation() if seen else None
        if observation:
            laid = laid.observe(observation, *(column.alias(name) for name, column in seen.items()))
        self._overwrite(laid, table.partitions, self._folder(table, version), options=dict(table.options))
        # Two notes in turn: while one is overwritten the other one holds.
        note = spark.range(1).select(F.lit(version).cast("long").alias("version"))
        self._overwrite(note, [], f"{self._notes(table)}/slot={version % 2}", "json")
        return observation.get if observation else {}

    def append(self, rows: DataFrame, table: Table) -> None:
        """Add rows."""
        self._writer(_laid_out(rows, table), table.partitions).mode("append").parquet(self.path(table))

    def write_batch(
        self, rows: DataFrame, table: Table, batch_id: Column | str, run_id: str = "all"
    ) -> None:
        """Add one run to the batches its rows belong to; the same run again replaces its files."""
        batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
        named = rows.withColumns({BATCH: batch, RUN: F.lit(run_id)})
        (
            self._writer(_laid_out(named, table), table.partitions)
            .options(**dict(table.options))
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .format(table.form)
            .save(self.path(table))
        )

    def replace_batch(self, spark: SparkSession, outputs: Mapping[Table, DataFrame], batch_id: str) -> None:
        """Make ``outputs`` all that the batch holds in these tables and, of the others, nothing.

        Earlier runs of it stay readable until all is written, and for good if
        a write fails.
        """
        version = self._last_note(spark, batch_id) + 1
        run_id = f"{REPLACING}{version:06d}-{uuid.uuid4().hex[:12]}"
        for table, rows in outputs.items():
            self.write_batch(rows, table, batch_id, run_id)
        note = json.dumps({BATCH: batch_id, "version": version, RUN: run_id})
        if not _create_once(spark, f"{self._batch_notes}/{_note_name(batch_id)}.{version}", note):
            raise Superseded(f"batch {batch_id} was replaced by another run")

    def remove_superseded(self, spark: SparkSession, hours: float = 24) -> int:
        """Delete runs that no longer count and were written over ``hours`` ago, so that reads of them have ended."""
        current, removed = self.current_runs(spark), 0
        latest = (time.time() - 3600 * hours) * 1000
        for table in (*TABLES, DEAD_LETTERS):
            for batch in _children(spark, self.path(table)) if table.per_batch else []:
                run_now = current.get(unquote(batch.getPath().getName().partition("=")[2]))
                for run in _children(spark, batch.getPath().toString()):
                    name = unquote(run.getPath().getName()).partition("=")[2]
                    counts = name == run_now or not (run_now or name.startswith(REPLACING))
                    if not counts and run.getModificationTime() <= latest:
                        removed += _delete(spark, run.getPath().toString())
        return removed

    def replace_partitions(self, rows: DataFrame, table: Table, values: Iterable[date]) -> None:
        """Make ``rows`` all that a rebuilt table holds of the dates ``values``; other dates keep their files.

        ``rows`` may come from the table itself: its files stay until all new
        ones are written. The dates that have rows are told by the write.
        """
        spark = rows.sparkSession
        folder = self._folder(table, self._version(spark, table))
        seen = Observation()
        laid = _laid_out(rows, table).observe(seen, F.collect_set(table.partition).alias("dates"))
        (
            self._writer(laid, table.partitions)
            .options(**dict(table.options))
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(folder)
        )
        # Dates that have no rows any more are not overwritten.
        for day in set(values) - set(seen.get["dates"]):
            _delete(spark, f"{folder}/{table.partition}={day}")

    def note_inputs(self, spark: SparkSession, runs: Iterable[tuple[str, str]]) -> None:
        """Note the runs of bronze that silver was built from; no runs while that is not known."""
        rows = spark.createDataFrame(sorted(runs), f"{BATCH} string, {RUN} string").coalesce(1)
        self._overwrite(rows, [], self._input_notes, "json")

    def noted_inputs(self, spark: SparkSession) -> set[tuple[str, str]]:
        notes = _if_written(lambda: spark.read.schema(f"{BATCH} string, {RUN} string").json(self._input_notes))
        return set() if notes is None else {tuple(row) for row in notes.collect()}

    @property
    def _batch_notes(self) -> str:
        return f"{self.root.rstrip('/')}/_versions/batches"

    @property
    def _input_notes(self) -> str:
        return f"{self.root.rstrip('/')}/_versions/silver_inputs"

    def _last_note(self, spark: SparkSession, batch_id: str) -> int:
        """By name, so that a note whose writer failed is passed over, too."""
        names = [f.getPath().getName() for f in _children(spark, self._batch_notes)]
        found = [name.rpartition(".") for name in names]
        return max((int(v) for name, _, v in found if name == _note_name(batch_id) and v.isdigit()), default=-1)

    def _folder(self, table: Table, version: int) -> str:
        return f"{self.path(table)}/version={version % 2}" if table.versioned else self.path(table)

    def _notes(self, table: Table) -> str:
        return f"{self.root.rstrip('/')}/_versions/{table.full_name}"

    def _version(self, spark: SparkSession, table: Table) -> int:
        """The version of a rebuilt table that is in use, -1 before its first rebuild."""
        if not table.versioned:
            return -1
        notes = _if_written(lambda: spark.read.schema("version long").json(self._notes(table)))
        latest = None if notes is None else notes.agg(F.max("version")).first()[0]
        return -1 if latest is None else latest

    def _define(self, spark: SparkSession, table: Table, version: int) -> None:
        location = self._folder(table, version).replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.stored_schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.full_name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(table.partitions)}) LOCATION '{location}'"
        )

    def _overwrite(
        self, rows: DataFrame, keys: list[str], folder: str, form: str = "parquet", options: Mapping[str, str] | None = None
    ) -> None:
        # Static, whatever the session says: nothing of the old folder may stay.
        writer = self._writer(rows, keys).mode("overwrite").option("partitionOverwriteMode", "static")
        writer.options(**(options or {})).format(form).save(folder)

    def _writer(self, rows: DataFrame, keys: list[str]):
        writer = rows.write.options(**self.options)
        return writer.partitionBy(*keys) if keys else writer


def _note_name(batch_id: str) -> str:
    # No name of a note starts like a hidden file.
    return f"batch={quote(batch_id, safe='')}"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder unless it is there, so that a stream can read it before anything is written."""
    place, files = _file_system(spark, path)
    files.mkdirs(place)


def _file_system(spark: SparkSession, path: str):
    """A path and its file system, through Hadoop's public interface."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list:
    place, files = _file_system(spark, folder)
    return list(files.listStatus(place)) if files.exists(place) else []


def _delete(spark: SparkSession, folder: str) -> bool:
    place, files = _file_system(spark, folder)
    return files.delete(place, True)


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there."""
    place, files = _file_system(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def _if_written(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, None if its folder does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def require_values(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the job on a NULL in a required column, by its name, which Parquet itself would accept."""
    first, *others = [f.name for f in schema if not f.nullable]
    missing = F.coalesce(*(F.when(F.col(name).isNull(), name) for name in (first, *others)))
    kind = schema[first].dataType
    failed = F.raise_error(F.concat(F.lit("NULL in a required column: "), missing)).cast(kind)
    return rows.withColumn(first, F.when(missing.isNull(), F.col(first)).otherwise(failed))


def _partition_value(table: Table) -> Column:
    return F.to_date(table.derived_from) if table.derived_from else F.col(table.partition)


def _laid_out(rows: DataFrame, table: Table, keys: list[str] | None = None) -> DataFrame:
    """One partition's rows together, in files of the advisory size, near each other in the cluster columns.

    The rebalance keeps a task from writing a sliver into every date, and AQE
    splits a date that is larger than one file. The sort gives each row group
    narrow ranges of all cluster columns to skip on, also of the last one.
    """
    # Spark's Parquet tables do not keep NOT NULL, so every writer checks.
    whole = require_values(rows, table.schema) if table.form == "parquet" else rows
    dated = whole.withColumn(table.partition, _partition_value(table))
    together = dated.hint("rebalance", table.partition)
    first = table.partitions if keys is None else keys
    if len(table.cluster) < 2:
        return together.sortWithinPartitions(*first, *table.cluster)
    # A column of its own, as a sort computes an expression again for each comparison.
    keyed = together.withColumn("_near", interleaved([F.col(name) for name in table.cluster]))
    return keyed.sortWithinPartitions(*first, "_near", *table.cluster).drop("_near")
