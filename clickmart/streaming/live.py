"""Live metrics and streaming deduplication (bounded state, event time).

The stream carries zone-less UTC timestamps; watermarks need ``TIMESTAMP``, so
the event time is converted through UTC, whatever the session's time zone.
State is bounded by the watermark: a window or an event id is forgotten once
the watermark passes it.  Spark closes windows with the watermark of the
current batch but judges an input row late against the watermark of the
previous batch, so a straggler is dropped from the second batch after the
event that moved the watermark on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pg
from ..schema import ADD_TO_CART, PAGE_VIEW, PURCHASE

EVENT_TIME = "event_time"


def with_event_time(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    return events.withColumn(EVENT_TIME, pg.utc_instant(F.col("event_timestamp"))).withWatermark(EVENT_TIME, watermark)


def live_metrics(events: DataFrame, window: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """Events, page views, carts, purchases and the current conversion rate
    per tumbling window of event time (throughput and conversion panels).

    Run with ``outputMode("update")`` to see a window refresh every trigger,
    or ``append`` to get each window once, after the watermark passes it.
    """
    e = with_event_time(events, watermark)
    etype = F.col("event_type")
    agg = e.groupBy(F.window(EVENT_TIME, window).alias("w")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(etype == PAGE_VIEW).alias("page_views"),
        F.count_if(etype == ADD_TO_CART).alias("add_to_carts"),
        F.count_if(etype == PURCHASE).alias("purchases"),
    )
    # back to zone-less wall-clock time, like the input
    return agg.select(
        pg.utc_clock(F.col("w.start")).alias("window_start"),
        pg.utc_clock(F.col("w.end")).alias("window_end"),
        "events",
        "page_views",
        "add_to_carts",
        "purchases",
        pg.pct("purchases", "page_views").alias("conversion_rate"),
    )


def stream_dedup(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries of an event id seen within ``delay`` of event
    time (a replayed batch), keeping state only inside the watermark."""
    return with_event_time(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def ingest_latency_per_batch(batch: DataFrame) -> DataFrame:
    """Average and maximum ingest latency (seconds) of one micro-batch."""
    us = pg.micros_between("event_timestamp", "ingestion_timestamp")
    return batch.agg(
        F.count(F.lit(1)).alias("events"),
        (F.sum(us).cast("double") / F.nullif(F.count(us), F.lit(0)) / F.lit(1e6)).alias("avg_latency_seconds"),
        (F.max(us).cast("double") / F.lit(1e6)).alias("max_latency_seconds"),
    )
