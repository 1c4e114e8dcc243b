"""Time the headline queries on one scale directory; print one JSON line.

Each query is fully evaluated into Spark's ``noop`` sink (every row computed,
nothing collected to the driver).  One untimed warm-up run loads the JVM
code paths; each query is then timed ``BENCH_REPEAT`` (default 3) times and the best run
is kept.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickmart.plans.registry import run  # noqa: E402
from clickmart.session import local_session  # noqa: E402
from clickmart.sources.clickstream import clickstream  # noqa: E402
from clickmart.sources.events_json import to_wire_json  # noqa: E402
from clickmart.streaming.ingest import read_events, start_ingest  # noqa: E402
from clickmart.streaming.progress import attach_progress_log  # noqa: E402

HEADLINE = [
    "stg_clickstream_events",
    "int_user_sessions",
    "mart_daily_metrics",
    "mart_conversion_funnel",
    "mart_product_performance",
    "mart_user_behavior",
    "dedup_keep_last",
    "kpi_summary",
    "check_summary",
]


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def stream_ingest(spark, sf_dir: str, files: int = 8) -> dict:
    """Time the streaming ingest over the whole clickstream of ``sf_dir``.

    The JSON lines are written first (not timed) as ``files`` files in event
    time order, as a topic replay delivers them; the stream then takes one file
    per micro-batch until it has caught up.
    """
    work = tempfile.mkdtemp(prefix="clickmart-bench-")
    src = os.path.join(work, "in")
    bronze = clickstream(spark, sf_dir).repartitionByRange(files, "event_timestamp", "event_id")
    to_wire_json(bronze.sortWithinPartitions("event_timestamp", "event_id")).write.text(src)
    log = attach_progress_log(spark)
    try:
        t0 = time.perf_counter()
        q = start_ingest(
            read_events(spark, "text", src, maxFilesPerTrigger=1),
            os.path.join(work, "bronze"),
            os.path.join(work, "rejects"),
            os.path.join(work, "ckpt"),
            available_now=True,
        )
        q.awaitTermination()
        seconds = time.perf_counter() - t0
        q.stop()
        deadline = time.time() + 30
        while log.summary(q.id)["batches"] < files and time.time() < deadline:
            time.sleep(0.2)
        s = log.summary(q.id)
    finally:
        spark.streams.removeListener(log)
    events = s["rows"]
    return {
        "seconds": round(seconds, 3),
        "events": events,
        "batches": s["batches"],
        "events_per_minute": round(events / seconds * 60) if seconds else None,
        "avg_batch_ms": round(s["avg_batch_ms"]) if s["avg_batch_ms"] else None,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="bench")

    run("kpi_summary", spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
            spark.catalog.clearCache()
        times[name] = round(best, 3)

    batch_total = round(sum(times.values()), 3)
    stream = stream_ingest(spark, sf_dir) if os.environ.get("BENCH_STREAM", "1") == "1" else None
    if stream:
        times["stream_ingest"] = stream["seconds"]

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "batch_queries_total": batch_total,
                "stream": stream,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
