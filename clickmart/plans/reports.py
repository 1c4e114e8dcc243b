"""Operational reports the README describes: KPIs, throughput, ingest latency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pg


def kpi_summary(sessions: DataFrame) -> DataFrame:
    """One row of headline KPIs from the session table (every event belongs to
    exactly one session, so event totals are sums of session totals)."""
    totals = sessions.agg(
        F.sum("total_events").alias("total_events"),
        F.sum("page_views").alias("page_views"),
        F.sum("add_to_carts").alias("add_to_carts"),
        F.sum("purchases").alias("purchases"),
        F.sum("session_revenue").alias("total_revenue"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_if(F.col("cart_abandoned")).alias("abandoned_carts"),
    )
    return totals.select(
        "*",
        pg.pct("purchases", "page_views").alias("conversion_rate"),
        pg.pct("add_to_carts", "page_views").alias("cart_rate"),
        pg.pct("purchases", "add_to_carts").alias("checkout_rate"),
        pg.pct("abandoned_carts", "total_sessions").alias("cart_abandonment_rate"),
        pg.money_ratio("total_revenue", "purchases").alias("average_order_value"),
        pg.money_ratio("total_revenue", "unique_users").alias("revenue_per_user"),
    )


def events_per_minute(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Throughput: events per one-minute tumbling window (batch form of the
    live metric in ``streaming.live``)."""
    w = F.window(ts, "1 minute")
    return events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("w.start").alias("minute_start"), F.col("w.end").alias("minute_end"), "events"
    )


def ingest_latency(bronze: DataFrame) -> DataFrame:
    """Ingestion minus event time, per event day: average (exact, from whole
    microseconds) and maximum, in seconds."""
    us = pg.micros_between("event_timestamp", "ingestion_timestamp")
    return bronze.groupBy(F.to_date("event_timestamp").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"),
        (F.sum(us).cast("double") / F.nullif(F.count(us), F.lit(0)) / F.lit(1e6)).alias("avg_latency_seconds"),
        (F.max(us).cast("double") / F.lit(1e6)).alias("max_latency_seconds"),
    )
