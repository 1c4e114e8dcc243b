"""Deduplication by event id: keep-first (staging) and keep-last (cleanup).

Both are a ``row_number() = 1`` filter over a window partitioned by the key.
Catalyst plans that as ``WindowGroupLimit``: each map task first keeps only its
best row per key, so even a key holding a third of all rows (a replay storm,
or NULL ids) shrinks to one row per task before the shuffle.

Ties: the reference orders by ingestion time only, which ties inside one
micro-batch (one stamp per batch).  We add fixed tie-breaks so the survivor
is the same on every run and every cluster layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "event_id"
ORDER_COLUMN = "ingestion_timestamp"
# all other columns, so that only rows equal in every column tie
TIE_BREAKS = [
    "event_timestamp",
    "event_type",
    "quantity",
    "product_id",
    "product_price",
    "user_id",
    "session_id",
    "device_type",
    "browser",
    "product_name",
    "product_category",
    "page_url",
    "referrer_url",
    "country",
    "city",
]


def _order(first: bool, columns: list[str]) -> list[Column]:
    cols = [ORDER_COLUMN] + [c for c in TIE_BREAKS if c in columns]
    # PostgreSQL ASC sorts NULLs last; keep-last is the mirror image.
    return [F.col(c).asc_nulls_last() if first else F.col(c).desc_nulls_first() for c in cols]


def _keep_one(df: DataFrame, first: bool) -> DataFrame:
    w = Window.partitionBy(KEY).orderBy(*_order(first, df.columns))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_keep_first(df: DataFrame) -> DataFrame:
    """Earliest ingested row per ``event_id``.  NULL ids form one group, so
    exactly one of them survives (window semantics)."""
    return _keep_one(df, first=True)


def dedup_keep_last(df: DataFrame) -> DataFrame:
    """Latest ingested row per ``event_id``; rows with a NULL id never match
    each other (join semantics), so all of them are kept.

    The rows with an id are deduplicated; the others join them as they are,
    found by a pushed-down filter and never shuffled, so a flood of NULL ids
    fills no task and the result doesn't depend on any row number.
    """
    without = df.filter(F.col(KEY).isNull())
    return _keep_one(df.filter(F.col(KEY).isNotNull()), first=False).unionByName(without)


def duplicate_event_ids(df: DataFrame) -> DataFrame:
    """``GROUP BY event_id HAVING COUNT(*) > 1``: (event_id, copies).

    Partial aggregation makes each map task send one row per key it holds.
    """
    return (
        df.groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
