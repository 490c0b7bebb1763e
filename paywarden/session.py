"""Session settings the operators rely on, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; they can be put on a session that somebody else created.
SETTINGS = {
    # Every instant is stored and truncated in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # AQE coalesces small shuffle partitions, splits skewed join sides and
    # splits skewed partitions of the rebalance before a table write.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A repeated JSON key keeps its last value instead of failing the task.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM does not compile longer methods; wide projections then run as
    # split expressions instead of one large interpreted loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The one-minute de-duplication keeps whole rows in state.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Settings that only take effect when the session is created.
STATIC_SETTINGS = {
    # Call sites of single column expressions; recording them costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the required settings on an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "paywarden", **overrides: str) -> SparkSession:
    """Create a session with the required settings; the master comes from spark-submit or ``overrides``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` below the shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster the executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="paywarden-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
