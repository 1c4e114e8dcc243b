"""Micro-batch progress: rows, rates and durations from the query listener.

Registered once per session.  Per query it keeps running totals over all its
batches, and the last progress event, so its size doesn't grow with the run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}
        self.last: dict[str, dict] = {}

    def onQueryStarted(self, event):  # noqa: N802 (listener API)
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        ms = (p.durationMs or {}).get("triggerExecution") or 0
        self.last[str(p.id)] = {
            "batch_id": p.batchId,
            "rows": p.numInputRows,
            "input_rows_per_second": p.inputRowsPerSecond,
            "processed_rows_per_second": p.processedRowsPerSecond,
            "trigger_ms": ms,
        }
        if p.numInputRows:
            total = self.totals.setdefault(str(p.id), {"batches": 0, "rows": 0, "ms": 0})
            total["batches"] += 1
            total["rows"] += p.numInputRows
            total["ms"] += ms

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def summary(self, query_id: str) -> dict:
        total = self.totals.get(str(query_id), {"batches": 0, "rows": 0, "ms": 0})
        batches, rows, ms = total["batches"], total["rows"], total["ms"]
        return {
            "batches": batches,
            "rows": rows,
            "batch_ms_total": ms,
            "avg_batch_ms": ms / batches if batches else None,
            "rows_per_second": rows / (ms / 1000.0) if ms else None,
        }


def attach_progress_log(spark: SparkSession) -> ProgressLog:
    log = ProgressLog()
    spark.streams.addListener(log)
    return log
