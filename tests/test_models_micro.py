"""PostgreSQL semantics on hand-written micro tables (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickmart.functions import pg
from clickmart.operators.dedup import dedup_keep_first, dedup_keep_last, duplicate_event_ids
from clickmart.plans import gold, silver
from clickmart.schema import LIFECYCLE_STAGES
from tests.micro import T0, bronze_df, ev, minutes

AS_OF = "2024-02-06 00:00:00"


def test_dedup_keep_first_last_and_filter_order(spark):
    rows = [
        ev("E1", T0, "page_view", ingested=T0 + minutes(1)),
        ev("E1", T0, "add_to_cart", quantity=2, ingested=T0 + minutes(2)),
        ev("E1", T0, "purchase", quantity=3, ingested=T0 + minutes(3)),
        # first delivery invalid: the id must vanish from staging
        ev("E2", T0, "remove_from_cart", ingested=T0 + minutes(1)),
        ev("E2", T0, "page_view", ingested=T0 + minutes(2)),
        # tie on ingestion time: deterministic tie-break
        ev("E3", T0, "page_view", quantity=None, ingested=T0),
        ev("E3", T0, "add_to_cart", quantity=1, ingested=T0),
        ev(None, T0, "page_view"),
        ev(None, T0 + minutes(1), "page_view"),
    ]
    b = bronze_df(spark, rows)
    first = {(r.event_id, r.event_type) for r in dedup_keep_first(b).collect()}
    assert ("E1", "page_view") in first and ("E2", "remove_from_cart") in first
    assert sum(1 for k in first if k[0] is None) == 1  # window: NULL ids form one group
    last = dedup_keep_last(b).collect()
    assert {(r.event_id, r.event_type) for r in last if r.event_id} >= {("E1", "purchase"), ("E2", "page_view")}
    assert sum(1 for r in last if r.event_id is None) == 2  # join: NULL ids never match
    stg_ids = {r.event_id for r in silver.stg_clickstream_events(b, AS_OF).collect()}
    assert "E2" not in stg_ids and "E1" in stg_ids
    # repeated runs pick the same survivor for the tie
    runs = {tuple(sorted((r.event_id or "", r.event_type) for r in dedup_keep_first(b).collect())) for _ in range(3)}
    assert len(runs) == 1
    dup = {r.event_id: r.copies for r in duplicate_event_ids(b).collect()}
    assert dup == {"E1": 3, "E2": 2, "E3": 2, None: 2}


def test_calendar_parts(spark):
    # 2024-01-07 is a Sunday
    rows = [ev(f"C{i}", dt.datetime(2024, 1, 7 + i, 13, 0, 0)) for i in range(7)]
    stg = silver.stg_clickstream_events(bronze_df(spark, rows), AS_OF)
    got = {r.event_id: (r.day_of_week, r.day_name, r.event_hour) for r in stg.collect()}
    assert got["C0"] == (0, "Sunday   ", 13)
    assert got["C3"] == (3, "Wednesday", 13)
    assert got["C6"] == (6, "Saturday ", 13)


def test_revenue_null_price_and_sum_filter(spark):
    rows = [
        ev("N1", T0, "purchase", product="PX", price=None, quantity=2),
        ev("N2", T0, "purchase", product="PY", quantity=None),
        ev("N3", T0, "page_view", product="PZ"),
    ]
    stg = silver.stg_clickstream_events(bronze_df(spark, rows), AS_OF)
    rev = {r.event_id: r.revenue for r in stg.collect()}
    assert rev["N1"] is None and rev["N2"] == 0 and rev["N3"] == 0
    prods = {r.product_id: r for r in gold.mart_product_performance(stg, AS_OF).collect()}
    assert set(prods) == {"PX", "PY"}  # HAVING purchases > 0
    assert prods["PY"].units_sold is None  # SUM FILTER over NULLs is NULL
    assert prods["PX"].total_revenue is None
    # DESC ranks put NULL first
    assert prods["PX"].revenue_rank == 1 and prods["PY"].revenue_rank == 2


def test_session_over_midnight_and_left_join(spark):
    d = dt.datetime(2024, 1, 10, 23, 50)
    rows = [
        ev("M1", d, "add_to_cart", quantity=1),
        ev("M2", d + minutes(30), "page_view"),
        # a second day with only a session that started the day before
    ]
    stg = silver.stg_clickstream_events(bronze_df(spark, rows), AS_OF)
    sessions = silver.int_user_sessions(stg, AS_OF)
    s = sessions.collect()[0]
    assert s.session_duration_seconds == 1800.0 and s.cart_abandoned
    daily = {r.event_date: r for r in gold.mart_daily_metrics(stg, sessions, AS_OF).collect()}
    assert daily[dt.date(2024, 1, 10)].abandoned_carts == 1
    assert daily[dt.date(2024, 1, 11)].abandoned_carts is None  # no session started that day
    assert daily[dt.date(2024, 1, 11)].cart_abandonment_rate is None


def test_mode_ties_and_nulls(spark):
    rows = [
        ev("D1", T0, device="Mobile"),
        ev("D2", T0 + minutes(1), device="Mobile"),
        ev("D3", T0 + minutes(2), device="Desktop"),
        ev("D4", T0 + minutes(3), device="Desktop"),
        ev("D5", T0 + minutes(4), device=None),
        ev("D6", T0 + minutes(5), device=None),
        ev("D7", T0 + minutes(6), device=None),
    ]
    s = silver.int_user_sessions(silver.stg_clickstream_events(bronze_df(spark, rows), AS_OF), AS_OF).collect()[0]
    assert s.primary_device == "Desktop"  # tie -> smallest, NULLs ignored


def test_whole_day_intervals(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 3, 1, 0)), (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 23, 59, 59, 999999))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r.d for r in df.select(pg.interval_days("a", "b").alias("d")).collect()]
    assert got == [1, 0]  # 26 h over two midnights is one whole day


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (2, 3), (0, 0)], "a long, b long")
    got = [r.p for r in df.select(pg.pct("a", "b").alias("p")).collect()]
    assert got == [0.13, 33.33, 66.67, None]


def _users(spark, rows):
    df = spark.createDataFrame(
        rows,
        "user_id string, total_sessions long, lifetime_revenue decimal(20,2), avg_events_per_session double, "
        "total_purchases long, abandoned_sessions long, total_page_views long, total_add_to_carts long, "
        "days_since_last_session long",
    )
    return df


@pytest.mark.parametrize(
    "row, lifecycle",
    [
        (("a", 1, Decimal("1"), 1.0, 3, 0, 0, 0, 30), 0),
        (("b", 1, Decimal("1"), 1.0, 2, 0, 0, 0, 30), 1),
        (("c", 1, Decimal("1"), 1.0, 1, 0, 0, 0, 31), 2),
        (("d", 1, Decimal("0"), 1.0, 0, 1, 0, 0, 7), 3),
        (("e", 1, Decimal("0"), 1.0, 0, 1, 0, 0, 8), 4),
        (("f", 1, Decimal("0"), 1.0, 0, 0, 1, 0, 7), 5),
        (("g", 1, Decimal("0"), 1.0, 0, 0, 1, 0, 8), 6),
        (("h", 1, Decimal("0"), 1.0, 0, 0, 0, 0, None), 6),
    ],
)
def test_lifecycle_branches(spark, row, lifecycle):
    from clickmart.functions import segments as seg

    got = _users(spark, [row]).select(seg.lifecycle_stage().alias("s")).collect()[0].s
    assert got == LIFECYCLE_STAGES[lifecycle]


def test_segment_thresholds(spark):
    from clickmart.functions import segments as seg

    rows = [
        ("a", 10, Decimal("500"), 10.0, 0, 0, 90, 2, 1),
        ("b", 9, Decimal("499.99"), 9.99, 0, 0, 200, 0, 2),
        ("c", 5, Decimal("200"), 5.0, 0, 0, 0, 0, 7),
        ("d", 4, Decimal("50"), 2.0, 0, 0, 0, 0, 8),
        ("e", 2, Decimal("0.01"), 1.99, 0, 0, 0, 0, 30),
        ("f", 1, Decimal("0"), 1.0, 0, 0, 0, 0, 31),
        ("g", 1, None, 1.0, 0, 0, 0, 0, None),
    ]
    df = _users(spark, rows).select(
        "user_id",
        seg.frequency_segment().alias("f"),
        seg.monetary_segment().alias("m"),
        seg.recency_segment().alias("r"),
        seg.engagement_level().alias("e"),
        seg.purchase_propensity_score().alias("p"),
    )
    got = {r.user_id: (r.f, r.m, r.r, r.e, r.p) for r in df.collect()}
    assert got["a"] == ("Power User (10+ sessions)", "High Value (₦825k+)", "Active (Today/Yesterday)", "Highly Engaged", 100)
    assert got["b"][:4] == ("Regular User (5-9 sessions)", "Medium Value (₦330k-₦825k)", "Recent (This Week)", "Moderately Engaged")
    assert got["b"][4] == 100  # capped
    assert got["c"][:4] == ("Regular User (5-9 sessions)", "Medium Value (₦330k-₦825k)", "Recent (This Week)", "Moderately Engaged")
    assert got["d"][:4] == ("Casual User (2-4 sessions)", "Low Value (₦82.5k-₦330k)", "Warm (This Month)", "Low Engagement")
    assert got["e"][:4] == ("Casual User (2-4 sessions)", "Micro Value (<₦82.5k)", "Warm (This Month)", "Very Low Engagement")
    assert got["f"][:4] == ("One-Time Visitor (1 session)", "Non-Buyer", "Cold (30+ days ago)", "Very Low Engagement")
    assert got["g"][1:3] == ("Non-Buyer", "Cold (30+ days ago)")  # NULL falls to the last branch
    assert got["a"][4] == 100 and got["c"][4] == 10 and got["d"][4] == 0


def test_customer_tier_edges(spark):
    from clickmart.functions import segments as seg

    df = spark.createDataFrame([(s,) for s in (3, 4, 5, 6, 7, 9, 10, 12, 13, 15)], "customer_score long")
    got = [r.t for r in df.select(seg.customer_tier().alias("t")).collect()]
    assert got == ["Lost", "Lost", "At Risk", "At Risk", "Potential", "Potential", "Loyal", "Loyal", "Champion", "Champion"]


def test_funnel_edges(spark):
    sessions_schema = (
        "session_id string, user_id string, page_views long, add_to_carts long, purchases long"
    )
    rows = [("s1", "u", 0, 0, 1), ("s2", "u", 0, 1, 0), ("s3", "u", 1, 0, 0)]
    f = {r.stage_order: r for r in gold.mart_conversion_funnel(spark.createDataFrame(rows, sessions_schema)).collect()}
    assert f[4].users_dropped == 0 and f[3].users_dropped == 0 and f[2].users_dropped == 2
    empty = gold.mart_conversion_funnel(spark.createDataFrame([], sessions_schema)).collect()
    assert len(empty) == 4 and empty[1].conversion_rate_from_previous is None and empty[0].sessions == 0
    # purchases without carts: negative drop
    rows = [("s1", "u", 1, 0, 1), ("s2", "u", 1, 0, 1)]
    f = {r.stage_order: r for r in gold.mart_conversion_funnel(spark.createDataFrame(rows, sessions_schema)).collect()}
    assert f[4].users_dropped == -2 and f[4].conversion_rate_from_previous is None


def test_rfm_join_equivalence(spark):
    """Scores appended in place equal the reference's self-join form."""
    rows = [(f"u{i}", i % 4, i % 6 + 1, Decimal(i % 5) if i % 7 else None) for i in range(40)]
    users = spark.createDataFrame(rows, "user_id string, days_since_last_session long, total_sessions long, lifetime_revenue decimal(10,2)")
    scores = gold.rfm_scores(users)
    joined = users.join(scores, "user_id", "left")
    from pyspark.sql import Window

    exp = users.select(
        "user_id",
        F.ntile(5).over(Window.orderBy(F.col("days_since_last_session").asc_nulls_last(), "user_id")).alias("r"),
        F.ntile(5).over(Window.orderBy(F.col("total_sessions").asc_nulls_last(), "user_id")).alias("f"),
        F.ntile(5).over(Window.orderBy(F.col("lifetime_revenue").asc_nulls_last(), "user_id")).alias("m"),
    )
    bad = joined.join(exp, "user_id").filter(
        (F.col("recency_score") != F.col("r")) | (F.col("frequency_score") != F.col("f")) | (F.col("monetary_score") != F.col("m"))
    )
    assert joined.count() == 40 and bad.count() == 0


def test_funnel_stack_equals_union(spark):
    """One aggregate + stack gives the same rows as four unioned selects."""
    from clickmart.plans.registry import Models

    sessions = Models(spark, "/root/testdata/sf0.001").sessions
    f = gold.funnel_counts(sessions)
    t, v, c, p = (F.col(x) for x in ("total_sessions", "sessions_with_views", "sessions_with_carts", "sessions_with_purchases"))
    stages = [
        (1, t, F.lit(0), F.lit(100.0), F.lit(100.0)),
        (2, v, t - v, pg.pct(v, t), pg.pct(v, t)),
        (3, c, v - c, pg.pct(c, v), pg.pct(c, t)),
        (4, p, c - p, pg.pct(p, c), pg.pct(p, t)),
    ]
    union = None
    for order, n, dropped, prev, start in stages:
        part = f.select(
            F.lit(order).cast("bigint").alias("stage_order"),
            n.cast("bigint").alias("sessions"),
            dropped.cast("bigint").alias("users_dropped"),
            prev.cast("double").alias("conversion_rate_from_previous"),
            start.cast("double").alias("conversion_rate_from_start"),
        )
        union = part if union is None else union.unionByName(part)
    cols = ["stage_order", "sessions", "users_dropped", "conversion_rate_from_previous", "conversion_rate_from_start"]
    stacked = gold.mart_conversion_funnel(sessions).select(*cols)
    assert sorted(stacked.collect()) == sorted(union.collect())


def test_rows_that_differ_in_city_alone(spark):
    """The survivor follows from the row's columns, not from the layout."""
    rows = [ev("E1", T0, "page_view")[:15] + (city, T0) for city in ("Lagos", "Abuja", None, "Kano")]
    for order in (rows, rows[::-1]):
        b = bronze_df(spark, order).repartition(3)
        assert [r.city for r in dedup_keep_first(b).collect()] == ["Abuja"]
        assert [r.city for r in dedup_keep_last(b).collect()] == [None]
