"""Wall times of the headline jobs, as one JSON line.

The raw messages are written once before the clock starts; every timed job
then reads files and writes its table, as it does in production.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures.payments import raw_messages  # noqa: E402
from paywarden.operators.curate import curate_transactions  # noqa: E402
from paywarden.operators.kpis import country_fraud_hotspots, merchant_hourly_kpis  # noqa: E402
from paywarden.plans.batch import process_period  # noqa: E402
from paywarden.plans.warehouse import append_audit  # noqa: E402
from paywarden.session import build_session, shared_dir  # noqa: E402
from paywarden.sources import lake as tables  # noqa: E402
from paywarden.sources.lake import Lake  # noqa: E402
from paywarden.sources.raw import read_messages, stream_from_files  # noqa: E402
from paywarden.streaming.jobs import drain, staged_messages  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MAX_FILES = str(2**31 - 1)


def main() -> None:
    spark = build_session(
        "paywarden-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake(shared_dir(spark, "bench"))
    streamed = Lake(shared_dir(spark, "bench-stream"))
    source = f"{lake.root}/messages"
    raw = raw_messages(spark, SF_DIR)
    raw.repartition(int(CPUS)).write.parquet(source)
    messages = read_messages(spark, source)
    count = messages.count()
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    day = F.lit("2024-02-01").cast("date")

    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], None]) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    def bronze():
        return lake.read(spark, tables.BRONZE)

    def silver():
        return lake.read(spark, tables.SILVER)

    timed(
        "process_messages",
        lambda: staged_messages(messages, "publish_ts").write.format("noop").mode("overwrite").save(),
    )
    timed("period_batch", lambda: process_period(spark, messages, lake, "all", "publish_ts", now))
    timed("silver", lambda: lake.replace(curate_transactions(bronze()), tables.SILVER))
    timed("merchant_kpis", lambda: lake.replace(merchant_hourly_kpis(silver()), tables.MERCHANT_KPIS))
    timed("country_hotspots", lambda: lake.replace(country_fraud_hotspots(silver()), tables.COUNTRY_HOTSPOTS))
    timed("dq_audit", lambda: append_audit(spark, lake, day, now))
    timed(
        "stream_drain",
        lambda: drain(
            spark,
            stream_from_files(spark, source, maxFilesPerTrigger=MAX_FILES),
            streamed,
            "publish_ts",
            now,
            maxFilesPerTrigger=MAX_FILES,
        ),
    )
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "messages": count,
                "stream_messages_per_sec": round(count / seconds["stream_drain"]),
            }
        )
    )


if __name__ == "__main__":
    main()
