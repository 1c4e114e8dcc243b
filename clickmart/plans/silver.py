"""Silver models: staged events and user sessions (lazy DataFrames, like views)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pg
from ..operators.dedup import dedup_keep_first
from ..schema import ADD_TO_CART, BRONZE_COLUMNS, PAGE_VIEW, PURCHASE, QUANTITY_EVENT_TYPES, VALID_EVENT_TYPES
from ..sources.bronze import bronze_scan, read_bronze

STG_DERIVED = ["event_date", "event_hour", "day_of_week", "day_name", "revenue", "has_missing_quantity", "dbt_updated_at"]
STG_COLUMNS = BRONZE_COLUMNS + STG_DERIVED

SESSION_COLUMNS = [
    "session_id",
    "user_id",
    "session_start",
    "session_end",
    "session_duration_seconds",
    "total_events",
    "unique_event_types",
    "page_views",
    "add_to_carts",
    "purchases",
    "primary_device",
    "primary_browser",
    "country",
    "session_revenue",
    "converted",
    "added_to_cart",
    "cart_abandoned",
    "dbt_updated_at",
]


def enrich_events(df: DataFrame, as_of=None) -> DataFrame:
    """Calendar parts, revenue and the missing-quantity flag."""
    ts = F.col("event_timestamp")
    etype = F.col("event_type")
    q = F.col("quantity")
    revenue = F.when((etype == PURCHASE) & q.isNotNull(), F.col("product_price") * q).otherwise(F.lit(0))
    return df.select(
        *BRONZE_COLUMNS,
        F.to_date(ts).alias("event_date"),
        F.hour(ts).cast("bigint").alias("event_hour"),
        pg.pg_dow(ts).alias("day_of_week"),
        pg.pg_day_name(ts).alias("day_name"),
        revenue.alias("revenue"),
        (etype.isin(*QUANTITY_EVENT_TYPES) & q.isNull()).alias("has_missing_quantity"),
        pg.as_of_literal(as_of).alias("dbt_updated_at"),
    )


def stg_clickstream_events(bronze: DataFrame, as_of=None) -> DataFrame:
    """Deduplicate (keep first ingested), keep valid event types, derive fields.

    The event-type filter stays *above* the dedup: an id whose first delivery
    has an invalid type must vanish, not fall back to a later valid copy.
    Catalyst keeps it there because ``event_type`` is not the window key.
    """
    deduped = dedup_keep_first(bronze_scan(bronze))
    return enrich_events(deduped.filter(F.col("event_type").isin(*VALID_EVENT_TYPES)), as_of)


def register_views(stg: DataFrame, sessions: DataFrame) -> None:
    """The silver models as temporary views, for SQL users of the session."""
    stg.createOrReplaceTempView("stg_clickstream_events")
    sessions.createOrReplaceTempView("int_user_sessions")


def register_live_views(spark: SparkSession, bronze_path: str, as_of=None) -> None:
    """The silver models as temporary views over the bronze table itself, nothing written.

    A view shows the files that were there when it was registered; the ingest registers them
    anew after every batch (``start_ingest(..., live_views=True)``), so a query sees all events
    of the batches before it.
    """
    stg = stg_clickstream_events(read_bronze(spark, bronze_path), as_of)
    register_views(stg, int_user_sessions(stg, as_of))


def session_aggregates(stg: DataFrame) -> DataFrame:
    """One row per ``(session_id, user_id)``; every aggregate is partial-
    aggregation friendly, so a hot session costs one row per map task."""
    etype = F.col("event_type")
    pv = pg.count_where(etype == PAGE_VIEW)
    atc = pg.count_where(etype == ADD_TO_CART)
    pur = pg.count_where(etype == PURCHASE)
    return stg.groupBy("session_id", "user_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        # COUNT(DISTINCT event_type): staged rows carry only the three valid,
        # non-NULL types, so the distinct count is the number of non-zero
        # per-type counts -- no extra distinct-aggregation stage.
        ((pv > 0).cast("bigint") + (atc > 0).cast("bigint") + (pur > 0).cast("bigint")).alias(
            "unique_event_types"
        ),
        pv.alias("page_views"),
        atc.alias("add_to_carts"),
        pur.alias("purchases"),
        # MODE() WITHIN GROUP (ORDER BY x): NULLs ignored, ties -> smallest
        F.mode("device_type", deterministic=True).alias("primary_device"),
        F.mode("browser", deterministic=True).alias("primary_browser"),
        F.mode("country", deterministic=True).alias("country"),
        F.sum("revenue").alias("session_revenue"),
    )


def int_user_sessions(stg: DataFrame, as_of=None) -> DataFrame:
    s = session_aggregates(stg)
    converted = F.col("purchases") > 0
    added = F.col("add_to_carts") > 0
    return s.select(
        "session_id",
        "user_id",
        "session_start",
        "session_end",
        pg.epoch_seconds_between("session_start", "session_end").alias("session_duration_seconds"),
        "total_events",
        "unique_event_types",
        "page_views",
        "add_to_carts",
        "purchases",
        "primary_device",
        "primary_browser",
        "country",
        "session_revenue",
        converted.alias("converted"),
        added.alias("added_to_cart"),
        (added & ~converted).alias("cart_abandoned"),
        pg.as_of_literal(as_of).alias("dbt_updated_at"),
    )
