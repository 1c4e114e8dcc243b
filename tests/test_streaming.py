"""Streaming ingest (file source), restart from checkpoint, dedup, live metrics."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from clickmart.sources.bronze import read_bronze
from clickmart.streaming.ingest import BronzeBatchWriter, read_events, run_until_caught_up
from clickmart.streaming.live import live_metrics, stream_dedup
from tests.test_ingest import GOOD


def _write_lines(d, name, objs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        for o in objs:
            f.write((o if isinstance(o, str) else json.dumps(o)) + "\n")


def _event(i, minute, etype="page_view"):
    return dict(GOOD, event_id=f"EVT_{i}", event_type=etype, quantity=1, event_timestamp=f"2024-01-03T10:{minute:02d}:00")


def test_ingest_restart_no_loss_no_duplicates(spark, tmp_dir):
    src, bronze, rejects, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "bronze", "rejects", "ckpt"))
    _write_lines(src, "a.json", [_event(i, i) for i in range(5)] + ["{broken"])
    run_until_caught_up(read_events(spark, "text", src), bronze, rejects, ckpt)
    assert read_bronze(spark, bronze).count() == 5
    # restart with new files: only the new ones are processed
    _write_lines(src, "b.json", [_event(i, i) for i in range(5, 8)])
    run_until_caught_up(read_events(spark, "text", src), bronze, rejects, ckpt)
    b = read_bronze(spark, bronze)
    assert b.count() == 8 and b.select("event_id").distinct().count() == 8
    assert spark.read.parquet(rejects).count() == 1
    assert b.filter(F.col("ingestion_timestamp").isNull()).count() == 0


def test_replayed_batch_overwrites_itself(spark, tmp_dir):
    bronze, rejects = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "rejects")
    batch = spark.createDataFrame([(json.dumps(_event(i, i)),) for i in range(4)], "value string")
    w = BronzeBatchWriter(bronze, rejects, as_of="2024-02-06 00:00:00")
    w(batch, 7)
    w(batch, 7)  # replay of the same batch id after a failure
    assert read_bronze(spark, bronze).count() == 4
    assert w.last_counts == {"batch_id": 7, "rows": 4, "rejects": w.last_counts["rejects"]}


def test_stream_dedup_and_live_metrics(spark, tmp_dir):
    from clickmart.sources.events_json import parse_events

    src = os.path.join(tmp_dir, "in")
    evs = [_event(1, 1), _event(2, 1, "purchase"), _event(3, 2), _event(1, 1)]  # EVT_1 delivered twice
    _write_lines(src, "a.json", evs)
    good, _ = parse_events(read_events(spark, "text", src))
    q = stream_dedup(good).writeStream.format("memory").queryName("dedup_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_out").count() == 3
    q2 = (
        live_metrics(good, "1 minute")
        .writeStream.format("memory")
        .queryName("live_out")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    q2.awaitTermination()
    rows = {r.window_start.minute: r for r in spark.table("live_out").collect()}
    assert rows[1].events == 3 and rows[1].purchases == 1 and rows[1].conversion_rate == 50.0
    assert rows[2].events == 1


def test_stream_output_equals_batch_output(spark, tmp_dir):
    """The stream sink and the batch ingest produce the same bronze rows."""
    from clickmart.sources.clickstream import clickstream
    from clickmart.sources.events_json import ingest, to_wire_json
    from tests.conftest import SF_SMALL

    src = os.path.join(tmp_dir, "in")
    wire = to_wire_json(clickstream(spark, SF_SMALL)).repartition(3)
    wire.write.text(src)
    run_until_caught_up(read_events(spark, "text", src), f"{tmp_dir}/b", f"{tmp_dir}/r", f"{tmp_dir}/c", as_of="2024-02-06 00:00:00")
    streamed = read_bronze(spark, f"{tmp_dir}/b")
    batch, _ = ingest(spark.read.text(src), as_of="2024-02-06 00:00:00")
    assert streamed.count() == batch.count() == 1100
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_append_mode_windows_close_with_the_watermark(spark, tmp_dir):
    """A window is emitted once the watermark passes it; an event behind the
    watermark is dropped instead of reopening the window.

    Spark judges lateness against the watermark of the previous batch, so
    the straggler arrives two batches after the event that moved it.
    """
    from clickmart.sources.events_json import parse_events

    src = os.path.join(tmp_dir, "in")
    batches = [
        ("a.json", [_event(1, 1), _event(2, 1), _event(3, 2), _event(4, 30)]),  # watermark -> 10:20
        ("b.json", [_event(5, 31)]),  # 10:01 and 10:02 windows close here
        ("c.json", [_event(6, 1)]),  # straggler for 10:01: dropped
    ]
    for i, (name, evs) in enumerate(batches):
        _write_lines(src, name, evs)
        # the file source takes files in modification-time order
        os.utime(os.path.join(src, name), (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    good, _ = parse_events(read_events(spark, "text", src, maxFilesPerTrigger=1))
    q = (
        live_metrics(good, "1 minute", watermark="10 minutes")
        .writeStream.format("memory")
        .queryName("live_append")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    rows = {r.window_start.minute: r.events for r in spark.table("live_append").collect()}
    assert rows == {1: 2, 2: 1}  # 10:30 and 10:31 stay open; the straggler is not counted


def test_latency_and_pruned_reads_over_the_stream_layout(spark, tmp_dir):
    """Per-batch ingest latency, and date-range reads of the stream's bronze
    folders (batch_id=N/event_date=D) prune to the requested days."""
    from clickmart.streaming.live import ingest_latency_per_batch

    src = os.path.join(tmp_dir, "in")
    evs = [dict(_event(i, 0), event_id=f"D{i}", event_timestamp=f"2024-01-0{i}T10:00:00") for i in range(1, 6)]
    _write_lines(src, "a.json", evs)
    run_until_caught_up(read_events(spark, "text", src), f"{tmp_dir}/b", f"{tmp_dir}/r", f"{tmp_dir}/c", as_of="2024-01-06 10:00:00")
    two_days = read_bronze(spark, f"{tmp_dir}/b", since="2024-01-02", until="2024-01-03")
    assert sorted(r.event_id for r in two_days.collect()) == ["D2", "D3"]
    lat = ingest_latency_per_batch(read_bronze(spark, f"{tmp_dir}/b")).collect()[0]
    assert lat.events == 5 and lat.max_latency_seconds == 5 * 86400.0 and lat.avg_latency_seconds == 3 * 86400.0


def test_live_windows_in_another_session_zone(spark):
    """Windows are those of the events' own clocks, also where the session's zone skips that hour."""
    from clickmart.plans.reports import events_per_minute
    from clickmart.sources.events_json import parse_events

    rows = [(json.dumps(dict(_event(i, i), event_timestamp=f"2024-03-10T02:3{i}:00")),) for i in range(3)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        good, _ = parse_events(spark.createDataFrame(rows, "value string"))
        live = {str(r[0]) for r in live_metrics(good, "1 minute").selectExpr("CAST(window_start AS STRING)").collect()}
        batch = {str(r[0]) for r in events_per_minute(good).selectExpr("CAST(minute_start AS STRING)").collect()}
        assert live == batch == {f"2024-03-10 02:3{i}:00" for i in range(3)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_trigger_interval_and_stop(spark, tmp_dir):
    """A running query takes new files at its trigger and stops cleanly on request; the totals cover all its batches."""
    import time

    from clickmart.streaming.ingest import start_ingest
    from clickmart.streaming.progress import attach_progress_log

    src = os.path.join(tmp_dir, "in")
    _write_lines(src, "a.json", [_event(i, i) for i in range(3)])
    log = attach_progress_log(spark)
    q = start_ingest(read_events(spark, "text", src), f"{tmp_dir}/b", f"{tmp_dir}/r", f"{tmp_dir}/c", trigger="5 seconds")

    def wait_for(rows):
        end = time.time() + 60
        while log.summary(q.id)["rows"] < rows and time.time() < end:
            time.sleep(0.2)
        return log.summary(q.id)

    try:
        assert wait_for(3)["rows"] == 3
        _write_lines(src, "b.json", [_event(i, i) for i in range(3, 5)])
        assert wait_for(5) | {"batch_ms_total": 0, "avg_batch_ms": 0, "rows_per_second": 0} == {"batches": 2, "rows": 5, "batch_ms_total": 0, "avg_batch_ms": 0, "rows_per_second": 0}
    finally:
        q.stop()
        spark.streams.removeListener(log)
    assert not q.isActive and q.exception() is None
    assert read_bronze(spark, f"{tmp_dir}/b").count() == 5
    # one stamp per batch
    assert read_bronze(spark, f"{tmp_dir}/b").select("ingestion_timestamp").distinct().count() == 2
