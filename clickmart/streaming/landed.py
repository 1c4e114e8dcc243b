"""Dropping events that landed long ago, beyond what a watermark remembers.

A stream's state forgets an id once the watermark has passed it; a replay a week later would be
written again.  Compacted days have a filter over their event ids (``sources.id_filters``), so a
micro-batch is checked without any state: the ids of its late days are looked up in the filters,
and only the possible hits are joined with the days' event ids, which decides.  Events that came
for a compacted day after its compaction are few, and are compared as they are.  A replay has the
event's own time, so it comes for the same day.  Null ids are never dropped, nor are events of
days that aren't compacted yet: those are what the watermark is for.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from ..sources import id_filters
from ..sources.compaction import BATCH_COLUMN, PARTITION_COLUMN, manifest_log, read_compacted, read_filters, read_raw

KEY = [PARTITION_COLUMN, "event_id"]


def late_days(events: DataFrame, days: dict[str, dict]) -> dict[str, dict]:
    """The compacted days (of a manifest) that ``events`` has rows for."""
    if not days:
        return {}
    seen = {str(r[0]) for r in events.select(PARTITION_COLUMN).distinct().collect()}
    return {d: days[d] for d in sorted(seen & set(days))}


def landed_ids(events: DataFrame, path: str, batch_id: int, days: dict[str, dict]) -> DataFrame:
    """Those ids (event_date, event_id) of ``events`` on the compacted ``days`` that bronze has."""
    spark = events.sparkSession
    chosen = [date.fromisoformat(d) for d in days]
    late = events.filter(F.col(PARTITION_COLUMN).isin(chosen)).select(*KEY)
    sizes = {d: entry["bits"] for d, entry in days.items()}
    possible = materialise(id_filters.possible(late, read_filters(spark, path, days), sizes), "possible")
    after = read_raw(spark, path, days).filter(F.col(PARTITION_COLUMN).isin(chosen) & (F.col(BATCH_COLUMN) < batch_id))
    landed = after.select(*KEY).join(late.distinct(), KEY, "left_semi")
    if not possible.isEmpty():
        landed = landed.unionByName(read_compacted(spark, path, days).select(*KEY).join(possible, KEY, "left_semi"))
    return landed.distinct()


def drop_landed(events: DataFrame, path: str, batch_id: int) -> DataFrame:
    """``events`` (bronze rows with their day) without those that earlier batches wrote for compacted days."""
    days = manifest_log(events.sparkSession, path).read()[1].get("days", {})
    days = late_days(events, days)
    if not days:
        return events
    return events.join(landed_ids(events, path, batch_id, days), KEY, "left_anti")
