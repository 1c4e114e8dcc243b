"""Compaction of a streamed bronze table: closed days in a few large files, every event read once.

The stream leaves ``event_date=<day>/batch_id=<n>`` folders, one file per task, day and batch.  A
compaction rewrites the days before a given one into ``_compacted/data/<run>/event_date=<day>``
and commits a manifest (``sources.commits``) that says, per day, where its rows are and through
which batch they are in there.  A reader takes the manifest first: it reads those files, and of
the batch folders only those beyond.  So it sees a batch's old files or the new ones, never both
and never neither, whether it starts before or after the commit.

* Late events of a compacted day come in a later batch and are read from its folder, until the
  next compaction rewrites that day.
* A replayed batch that was compacted writes its folder again, and readers pass it by.  Only
  batches followed by another one are compacted: a stream ends a batch before it begins the next,
  so none of them can be half written.
* Each compacted day has a filter over its event ids (``sources.id_filters``) beside its rows, by
  which the ingest can drop replays that come long after.
* ``clean`` deletes what no reader of the latest manifest opens.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BRONZE_SCHEMA
from . import id_filters
from .commits import CommitLog, Folder

PARTITION_COLUMN = "event_date"
BATCH_COLUMN = "batch_id"
FOLDER = "_compacted"
#: Rows of a file, and of the range that one task sorts to write it (about half a KB each in memory).
ROWS_PER_FILE = 1_000_000

_DAY, _BATCH = f"{PARTITION_COLUMN}=", f"{BATCH_COLUMN}="
FILTER_SCHEMA = "event_date date, bucket int, bitmap binary"
#: Of a row in either kind of file.
SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(BATCH_COLUMN, T.LongType()), T.StructField(PARTITION_COLUMN, T.DateType())])


def manifest_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}/{FOLDER}/log")


def read_raw(spark: SparkSession, path: str, days: dict[str, dict]) -> DataFrame:
    """The rows of batch folders that ``days`` (of a manifest) doesn't cover.

    The folders' names decide, so covered files aren't opened.
    """
    raw = spark.read.schema(SCHEMA).parquet(path)
    through = defaultdict(list)
    for name in Folder(spark, path).names():
        day = name.removeprefix(_DAY)
        if day != name and day in days:
            through[days[day]["through"]].append(date.fromisoformat(day))
    for last, covered in through.items():
        inside = F.col(PARTITION_COLUMN).isin(covered) & (F.col(BATCH_COLUMN) <= last)
        raw = raw.filter(~F.coalesce(inside, F.lit(False)))
    return raw


def read_compacted(spark: SparkSession, path: str, days: dict[str, dict], since=None, until=None) -> DataFrame | None:
    """The compacted rows; ``since`` and ``until`` choose days by the manifest alone."""
    chosen = [d for d in sorted(days) if (since is None or d >= str(since)) and (until is None or d <= str(until))]
    by_run = defaultdict(list)
    for d in chosen:
        by_run[days[d]["run"]].append(f"{path}/{FOLDER}/data/{days[d]['run']}/{_DAY}{d}")
    out = None
    for run, paths in by_run.items():
        part = spark.read.schema(SCHEMA).option("basePath", f"{path}/{FOLDER}/data/{run}").parquet(*paths)
        out = part if out is None else out.unionByName(part)
    return out


def read_filters(spark: SparkSession, path: str, days: dict[str, dict]) -> DataFrame:
    """The id filters of compacted ``days``."""
    out = None
    for run in sorted({entry["run"] for entry in days.values()}):
        own = [date.fromisoformat(d) for d, entry in days.items() if entry["run"] == run]
        part = spark.read.schema(FILTER_SCHEMA).parquet(f"{path}/{FOLDER}/filters/{run}").filter(F.col(PARTITION_COLUMN).isin(own))
        out = part if out is None else out.unionByName(part)
    return out


def read_rows(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """All rows of a bronze table with their day and batch, compacted or not."""
    path = path.rstrip("/")
    days = manifest_log(spark, path).read()[1].get("days", {})
    rows = read_raw(spark, path, days)
    if since is not None:
        rows = rows.filter(F.col(PARTITION_COLUMN) >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.filter(F.col(PARTITION_COLUMN) <= F.lit(until).cast("date"))
    compacted = read_compacted(spark, path, days, since, until)
    return rows if compacted is None else rows.unionByName(compacted)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write bronze rows with their day as one batch, in place of what that batch wrote for these days."""
    (
        rows.withColumn(BATCH_COLUMN, F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN, BATCH_COLUMN)
        .parquet(path)
    )


def _batches(folder: Folder) -> dict[str, list[int]]:
    """Batch numbers of each day that has folders."""
    days = [n for n in folder.names() if n.startswith(_DAY)]
    return {n.removeprefix(_DAY): sorted(int(b.removeprefix(_BATCH)) for b in folder.names(n) if b.startswith(_BATCH)) for n in days}


def compact(spark: SparkSession, path: str, before: str | date, through: int | None = None, rows_per_file: int = ROWS_PER_FILE, bits_per_id: int = id_filters.BITS_PER_ID) -> dict[str, object]:
    """Compact the days before ``before``; returns the version and the days rewritten.

    ``through``: the last batch to include, one that has ended; by default the last but one of
    the table.
    """
    path = path.rstrip("/")
    log = manifest_log(spark, path)
    version, manifest = log.read()
    days = manifest.get("days", {})
    found = _batches(Folder(spark, path))
    if through is None:
        through = max((b for own in found.values() for b in own), default=0) - 1
    open_days = [d for d, own in found.items() if d < str(before) and any(days.get(d, {}).get("through", -1) < b <= through for b in own)]
    if not open_days:
        return {"version": version, "days": []}

    chosen = {d: days[d] for d in open_days if d in days}
    rows = read_raw(spark, path, days).filter(F.col(PARTITION_COLUMN).isin([date.fromisoformat(d) for d in open_days]) & (F.col(BATCH_COLUMN) <= through))
    old = read_compacted(spark, path, chosen)
    rows = rows if old is None else rows.unionByName(old)
    total = rows.count()
    run = uuid.uuid4().hex
    order = [PARTITION_COLUMN, "event_timestamp", "event_id", BATCH_COLUMN]
    # a day's rows lie in neighbouring ranges, in order of time, so files can be passed by for a time
    dealt = rows.repartitionByRange(max(1, -(-total // rows_per_file)), *order).sortWithinPartitions(*order)
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy(PARTITION_COLUMN).parquet(f"{path}/{FOLDER}/data/{run}")
    made = {d: {"run": run, "through": through} for d in open_days}
    written = read_compacted(spark, path, made)
    counts = {str(r[0]): r[1] for r in written.groupBy(PARTITION_COLUMN).agg(F.count("event_id")).collect()}  # a row per day
    for d, entry in made.items():
        entry["bits"] = id_filters.size_of(counts[d], bits_per_id)
    filters = id_filters.build(written, {d: entry["bits"] for d, entry in made.items()})
    filters.repartitionByRange(PARTITION_COLUMN, "bucket").sortWithinPartitions(PARTITION_COLUMN, "bucket").write.parquet(f"{path}/{FOLDER}/filters/{run}")
    days = {**days, **made}
    committed = log.commit({"days": days}, version)
    if committed is None:
        Folder(spark, f"{path}/{FOLDER}/data").delete(run)
        Folder(spark, f"{path}/{FOLDER}/filters").delete(run)
        raise RuntimeError("another compaction committed meanwhile; nothing was changed")
    return {"version": committed, "days": sorted(open_days)}


def clean(spark: SparkSession, path: str) -> dict[str, int]:
    """Delete batch folders that the latest manifest covers and files of earlier compactions.

    Readers that began before the latest compaction must have ended, and no compaction may run.
    """
    path = path.rstrip("/")
    log = manifest_log(spark, path)
    version, manifest = log.read()
    days = manifest.get("days", {})
    folder, batches, runs = Folder(spark, path), 0, 0
    for day, own in _batches(folder).items():
        for b in own:
            if b <= days.get(day, {}).get("through", -1):
                folder.delete(f"{_DAY}{day}/{_BATCH}{b}")
                batches += 1
        if day in days and not folder.names(f"{_DAY}{day}"):
            folder.delete(f"{_DAY}{day}")
    used = defaultdict(set)
    for day, entry in days.items():
        used[entry["run"]].add(f"{_DAY}{day}")
    data = Folder(spark, f"{path}/{FOLDER}/data")
    for run in data.names():
        if run not in used:
            data.delete(run)
            Folder(spark, f"{path}/{FOLDER}/filters").delete(run)
            runs += 1
            continue
        for name in data.names(run):  # days that a later run rewrote
            if name.startswith(_DAY) and name not in used[run]:
                data.delete(f"{run}/{name}")
    for v in log.versions():
        if v != version:
            log.forget(v)
    return {"batch_folders": batches, "runs": runs}
