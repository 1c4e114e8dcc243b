"""Streaming ingest: broker (or file) stream -> parse/repair/stamp -> bronze.

The same ``sources.events_json`` functions run per micro-batch, so stream and
batch produce identical rows.  The sink is ``foreachBatch``:

* good rows go to ``<bronze>/event_date=<day>/batch_id=<n>``, overwriting just
  the folders the batch has rows for, and rejects (with the raw text and a
  reason) to ``<rejects>/batch_id=<n>`` when there are any.  A batch that fails after a partial write is replayed under
  the same id after restart and replaces its own output: exactly-once files on
  top of the at-least-once source;
* the batch is parsed once for the bronze write, and its message and reject
  counts are observed during that write (no separate ``count()`` pass);
* the engine calls the sink only for batches that brought data, so there is
  no emptiness probe (an extra job per batch).

Progress lives in the checkpoint folder; ``trigger`` is a processing-time
interval (``"5 seconds"``) or ``available_now=True`` for a bounded catch-up.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.silver import register_live_views
from ..sources import events_json
from ..sources.bronze import BATCH_COLUMN, PARTITION_COLUMN, bronze_scan
from ..sources.compaction import SCHEMA, write_batch
from . import landed

log = logging.getLogger(__name__)


def read_events(spark: SparkSession, source: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """A streaming DataFrame with one ``value`` column of JSON text.

    ``source="kafka"`` subscribes to ``options["subscribe"]`` on
    ``options["kafka.bootstrap.servers"]`` (starting at the latest offsets on
    the first run, tolerating lost offsets); it needs the Kafka connector on
    the classpath.  ``source="text"`` reads new files of JSON lines from
    ``path`` (used by tests and for replaying exported topics).
    """
    if source == "kafka":
        opts = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    if source == "text":
        if path is None:
            raise ValueError("text source needs a path")
        return spark.readStream.options(**options).format("text").load(path)
    raise ValueError(f"unknown source {source!r}")


class BronzeBatchWriter:
    """``foreachBatch`` callback writing one micro-batch idempotently.

    ``jdbc_options`` (``url``, ``dbtable``, ``user``, ``password``, ``driver``)
    additionally appends the good rows to a database table through Spark's
    JDBC writer, as the reference sink does.  A JDBC append is at-least-once:
    a replayed batch appends again, and the downstream dedup removes the
    copies.  No credentials have defaults.

    ``drop_landed`` drops events that earlier batches wrote for days compacted
    since (``streaming.landed``): replays from beyond any watermark.
    ``live_views`` registers the silver views over bronze anew after each batch.
    """

    def __init__(self, bronze_path: str, rejects_path: str, as_of=None, jdbc_options: dict | None = None, drop_landed: bool = False, live_views: bool = False):
        self.bronze_path = bronze_path
        self.rejects_path = rejects_path
        self.as_of = as_of
        self.jdbc_options = jdbc_options
        self.drop_landed = drop_landed
        self.live_views = live_views
        # where live views are registered; that of the batch by default
        self.session: SparkSession | None = None
        # of the last batch alone: batch id, rows, rejects
        self.last_counts: dict[str, int] = {}

    def _bronze(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self.bronze_path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # No persist: the bronze write is normally the only pass over the
        # batch; the rejects write (a second parse) only runs when there are
        # rejects.
        parsed = events_json.parse_with_reason(batch, "value")
        try:
            # message and reject counts are observed during the bronze write:
            # no separate count() pass, and no rejects job when there are none
            obs = Observation(f"bronze_batch_{batch_id}")
            observed = parsed.observe(
                obs,
                F.count(F.lit(1)).alias("messages"),
                F.count_if(F.col(events_json.REASON).isNotNull()).alias("rejects"),
            )
            # one stamp for the batch, whatever is written from it
            stamp = self.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
            good, _ = events_json.ingest_parsed(observed, stamp)
            good = good.withColumn(PARTITION_COLUMN, F.to_date("event_timestamp"))
            if self.drop_landed:
                good = landed.drop_landed(good, self.bronze_path, batch_id)
            write_batch(good, self.bronze_path, batch_id)
            metrics = obs.get
            rejected = int(metrics.get("rejects", 0))
            if rejected:
                _, rejects = events_json.split_parsed(parsed)
                rejects.write.mode("overwrite").parquet(f"{self.rejects_path}/batch_id={batch_id}")
            if self.jdbc_options:
                # the rows as written: the batch isn't parsed and observed again
                of_batch = F.col(BATCH_COLUMN) == batch_id
                written = bronze_scan(self._bronze(batch.sparkSession).filter(of_batch))
                written.write.format("jdbc").options(**self.jdbc_options).mode("append").save()
            if self.live_views:
                # the batch may come in a clone of the caller's session; views are the caller's
                register_live_views(self.session or batch.sparkSession, self.bronze_path)
            rows = int(metrics.get("messages", 0)) - rejected
            self.last_counts = {"batch_id": batch_id, "rows": rows, "rejects": rejected}
            log.info("batch %s: %s events written, %s rejected", batch_id, rows, rejected)
        except Exception:
            log.exception("batch %s failed; it is replayed on restart", batch_id)
            raise


def start_ingest(
    stream: DataFrame,
    bronze_path: str,
    rejects_path: str,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    available_now: bool = False,
    as_of=None,
    query_name: str | None = None,
    jdbc_options: dict | None = None,
    drop_landed: bool = False,
    live_views: bool = False,
) -> StreamingQuery:
    """Start the ingest query; stop it with ``query.stop()`` (graceful)."""
    sink = BronzeBatchWriter(bronze_path, rejects_path, as_of, jdbc_options, drop_landed, live_views)
    sink.session = stream.sparkSession
    writer = stream.writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def run_until_caught_up(stream: DataFrame, bronze_path: str, rejects_path: str, checkpoint: str, as_of=None) -> None:
    """Process everything available now, then stop (batch-style catch-up)."""
    q = start_ingest(stream, bronze_path, rejects_path, checkpoint, available_now=True, as_of=as_of)
    try:
        q.awaitTermination()
    finally:
        q.stop()


def run_ingest(stream: DataFrame, bronze_path: str, rejects_path: str, checkpoint: str, **kwargs) -> None:
    """Run the ingest until it fails or is interrupted; always stop it cleanly.

    A failing batch ends the query with its exception (re-raised); restarting
    with the same checkpoint replays that batch into its own folder.
    """
    q = start_ingest(stream, bronze_path, rejects_path, checkpoint, **kwargs)
    try:
        q.awaitTermination()
    except KeyboardInterrupt:
        log.info("stopping ingest on request")
    finally:
        q.stop()
