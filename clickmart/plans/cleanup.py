"""Duplicate report and cleanup of a bronze table (count, remove, re-count).

The cleaned table is written to a new path (keep-last per event id, NULL ids
kept); the source is never modified in place.  Counts come from partial
aggregations, never from rows fetched to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.dedup import dedup_keep_last, duplicate_event_ids


def cleanup_duplicates(bronze: DataFrame, out_path: str) -> dict[str, int]:
    found = duplicate_event_ids(bronze).count()
    dedup_keep_last(bronze).write.mode("overwrite").parquet(out_path)
    cleaned = bronze.sparkSession.read.parquet(out_path)
    remaining = duplicate_event_ids(cleaned.filter(cleaned.event_id.isNotNull())).count()
    return {"duplicate_ids_found": found, "rows_written": cleaned.count(), "duplicate_ids_remaining": remaining}
