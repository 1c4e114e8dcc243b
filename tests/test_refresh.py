"""Refresh job writes silver, four marts and stored check failures."""

from __future__ import annotations

from clickmart.plans.refresh import refresh
from clickmart.sources.clickstream import clickstream
from tests.conftest import SF_SMALL


def test_refresh_writes_everything(spark, tmp_dir):
    out = refresh(spark, clickstream(spark, SF_SMALL), tmp_dir, as_of="2024-02-06 00:00:00")
    assert spark.read.parquet(out["paths"]["mart_conversion_funnel"]).count() == 4
    assert spark.read.parquet(out["paths"]["mart_user_behavior"]).count() == 119
    failures = out["failures"]
    assert len(failures) == 24
    # bronze carries replayed duplicates and an invalid event type
    assert failures["unique_clickstream_events_event_id"] > 0
    assert failures["accepted_values_clickstream_events_event_type"] == 1
    assert failures["unique_stg_clickstream_events_event_id"] == 0


def test_cleanup_duplicates(spark, tmp_dir):
    from clickmart.plans.cleanup import cleanup_duplicates

    out = cleanup_duplicates(clickstream(spark, SF_SMALL), f"{tmp_dir}/clean")
    assert out == {"duplicate_ids_found": 100, "rows_written": 1000, "duplicate_ids_remaining": 0}


def test_progress_log_measures_stream(spark, tmp_dir):
    import json
    import os

    from clickmart.streaming.ingest import read_events, start_ingest
    from clickmart.streaming.progress import attach_progress_log
    from tests.test_ingest import GOOD

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(50):
            f.write(json.dumps(dict(GOOD, event_id=f"E{i}")) + "\n")
    log = attach_progress_log(spark)
    try:
        q = start_ingest(read_events(spark, "text", src), f"{tmp_dir}/b", f"{tmp_dir}/r", f"{tmp_dir}/c", available_now=True)
        q.awaitTermination()
        q.stop()
        import time

        deadline = time.time() + 30  # progress events are delivered asynchronously
        while log.summary(q.id)["rows"] < 50 and time.time() < deadline:
            time.sleep(0.2)
        s = log.summary(q.id)
        assert s["rows"] == 50 and s["batches"] >= 1
    finally:
        spark.streams.removeListener(log)


def test_bronze_date_range_prunes_partitions(spark, tmp_dir):
    from clickmart.sources.bronze import read_bronze, write_bronze

    write_bronze(clickstream(spark, SF_SMALL), f"{tmp_dir}/bronze")
    df = read_bronze(spark, f"{tmp_dir}/bronze", since="2024-01-05", until="2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan
    dates = {r.d for r in df.selectExpr("CAST(event_timestamp AS DATE) AS d").distinct().collect()}
    assert {str(d) for d in dates} == {"2024-01-05", "2024-01-06"}
    assert read_bronze(spark, f"{tmp_dir}/bronze").count() == 1100


def test_command_line_jobs(spark, tmp_dir):
    """The CLI runs ingest (files), refresh, cleanup and checks end to end."""
    import json
    import os

    from clickmart.__main__ import main
    from clickmart.sources.events_json import to_wire_json

    src = os.path.join(tmp_dir, "in")
    to_wire_json(clickstream(spark, SF_SMALL)).write.text(src)
    b, r, c = (os.path.join(tmp_dir, x) for x in ("bronze", "rejects", "ckpt"))
    main(["ingest", "--source", "text", "--input", src, "--bronze", b, "--rejects", r, "--checkpoint", c, "--available-now"], spark)
    out = main(["refresh", "--bronze", b, "--out", os.path.join(tmp_dir, "out"), "--as-of", "2024-02-06 00:00:00"], spark)
    assert len(out["failures"]) == 24
    cleaned = main(["cleanup", "--bronze", b, "--out", os.path.join(tmp_dir, "clean")], spark)
    assert cleaned["duplicate_ids_found"] == 100 and cleaned["duplicate_ids_remaining"] == 0
    checks = main(["checks", "--bronze", b, "--as-of", "2024-02-06 00:00:00"], spark)
    assert len(checks["checks"]) == 24
    json.dumps(checks, default=str)


def test_command_line_plan(spark):
    from clickmart.__main__ import main

    out = main(["plan", "--query", "stg_clickstream_events", "--tables", SF_SMALL], spark)
    assert "WindowGroupLimit" in out["plan"] and "ReadSchema" in out["plan"]
