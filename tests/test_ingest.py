"""JSON parse with rejects, quantity repair, ingestion stamp."""

from __future__ import annotations

import json

from clickmart.sources.events_json import ingest, parse_events, repair_quantity

GOOD = {
    "event_id": "EVT_1", "event_timestamp": "2024-01-03T14:23:45", "user_id": "USER_1", "session_id": "S1",
    "event_type": "purchase", "product_id": "P1", "product_name": "Earbuds", "product_category": "Electronics",
    "product_price": 79.99, "quantity": 0, "page_url": "u", "referrer_url": "r", "device_type": "Mobile",
    "browser": "Chrome", "country": "Nigeria", "city": "Lagos",
}


def lines():
    missing_id = dict(GOOD, event_id=None)
    bad_ts = dict(GOOD, event_id="EVT_3", event_timestamp="not a time")
    wrong_q = dict(GOOD, event_id="EVT_4", quantity="two")
    view = dict(GOOD, event_id="EVT_5", event_type="page_view", quantity=None)
    return [json.dumps(GOOD), "{broken", json.dumps(missing_id), json.dumps(bad_ts), json.dumps(wrong_q), json.dumps(view), json.dumps(GOOD)]


def test_parse_and_rejects(spark):
    df = spark.createDataFrame([(x,) for x in lines()], "value string")
    good, rejects = parse_events(df)
    g = good.collect()
    # a wrong-typed field is NULLed, the row is kept (from_json partial results)
    assert sorted(r.event_id for r in g) == ["EVT_1", "EVT_1", "EVT_4", "EVT_5"]
    assert [r.quantity for r in g if r.event_id == "EVT_4"] == [None]
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["bad event_timestamp", "missing event_id", "unparseable"]
    assert str(g[0].event_timestamp) == "2024-01-03 14:23:45"


def test_repair_and_stamp(spark):
    df = spark.createDataFrame([(x,) for x in lines()], "value string")
    rows, _ = ingest(df, as_of="2024-02-06 00:00:00")
    got = {(r.event_id, r.event_type): r for r in rows.collect()}
    assert got[("EVT_1", "purchase")].quantity == 1  # 0 -> 1 for a purchase
    assert got[("EVT_4", "purchase")].quantity == 1  # unreadable -> NULL -> 1
    assert got[("EVT_5", "page_view")].quantity is None  # views untouched
    assert str(got[("EVT_5", "page_view")].ingestion_timestamp) == "2024-02-06 00:00:00"
    q = spark.createDataFrame([("add_to_cart", None), ("add_to_cart", -2), ("purchase", 3), ("page_view", 0)], "event_type string, quantity int")
    assert [r.quantity for r in repair_quantity(q).collect()] == [1, 1, 3, 0]


def test_offsets_are_honoured(spark):
    """Text with Z or an offset is converted to UTC; text without one is taken as it is, in any session zone."""
    times = {
        "2024-01-03T14:23:45": "2024-01-03 14:23:45",
        "2024-01-03 14:23:45.250": "2024-01-03 14:23:45.250000",
        "2024-01-03T14:23:45Z": "2024-01-03 14:23:45",
        "2024-01-03T14:23:45+01:00": "2024-01-03 13:23:45",
        "2024-01-03T14:23:45.5-05:30": "2024-01-03 19:53:45.500000",
        "2024-03-10T02:30:00": "2024-03-10 02:30:00",
        "2024-01-03": "2024-01-03 00:00:00",
    }
    rows = [(json.dumps(dict(GOOD, event_id=f"E{i}", event_timestamp=t)),) for i, t in enumerate(times)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            good, rejects = parse_events(spark.createDataFrame(rows, "value string"))
            got = {r.event_id: r.event_timestamp for r in good.selectExpr("event_id", "CAST(event_timestamp AS STRING) AS event_timestamp").collect()}
            want = {f"E{i}": t.rstrip("0") if "." in t else t for i, t in enumerate(times.values())}
            assert got == want
            assert rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
