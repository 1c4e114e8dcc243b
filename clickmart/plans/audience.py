"""Distinct users and sessions by day, kept so that they add up to any longer period.

A distinct count of a day can't be added to another day's.  Here every id has a dense number, and
a day's ids are bitmaps over those numbers (Spark's: 32768 bits a row), stored per day.  A week's
count is the bits of the OR of its days' bitmaps: no event is read again, and each day's part is
at most one bit per known id.

    <root>/log                    commits: days with their run, runs of the dictionary, next numbers
    <root>/dictionary/<run>       what, id, number (only ids that no earlier run has)
    <root>/bitmaps/<run>          event_date, what, bucket, bitmap

Days are added or replaced by one commit; a run that fails leaves the store as it was.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import asc, global_row_number, idiv
from ..session import materialise
from ..sources.commits import CommitLog

#: What is counted, by the column of its ids.
IDS = {"users": "user_id", "sessions": "session_id"}
#: Bits of one of Spark's bitmaps.
BUCKET = 8 * 4096

DICTIONARY = "what string, id string, number long"
BITMAPS = "event_date date, what string, bucket long, bitmap binary"


def seen_ids(stg: DataFrame) -> DataFrame:
    """The distinct (event_date, what, id), nulls left out: one row per day and id."""
    pairs = F.array(*(F.struct(F.lit(what).alias("what"), F.col(c).alias("id")) for what, c in IDS.items()))
    days = stg.groupBy("event_date", *IDS.values()).agg(F.count(F.lit(1)).alias("n"))  # before the rows are doubled
    seen = days.select("event_date", F.explode(pairs).alias("p")).select("event_date", "p.what", "p.id")
    return seen.filter(F.col("id").isNotNull() & F.col("event_date").isNotNull()).distinct()


def numbered(new: DataFrame, first: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Dense numbers for distinct (what, id), from ``first[what]`` on; and the next free ones."""
    counts = dict(new.groupBy("what").count().collect())  # a row per kind
    before, offset = 0, {}
    for what in sorted(counts):
        offset[what] = first.get(what, 0) - before - 1
        before += counts[what]
    if not counts:
        return new.select("what", "id", F.lit(0).cast("long").alias("number")), dict(first)
    shift = F.create_map(*(F.lit(x) for pair in offset.items() for x in pair))[F.col("what")]
    rows = global_row_number(new.select("what", "id"), [asc("what"), asc("id")], "place")
    rows = rows.select("what", "id", (F.col("place") + shift).cast("long").alias("number"))
    return rows, {what: first.get(what, 0) + counts.get(what, 0) for what in {*first, *counts}}


def day_bitmaps(seen: DataFrame, dictionary: DataFrame) -> DataFrame:
    """BITMAPS of the seen ids."""
    placed = seen.join(dictionary, ["what", "id"])
    bit = F.pmod("number", F.lit(BUCKET))
    bucket = idiv(F.col("number"), F.lit(BUCKET).cast("long"))
    return placed.select("event_date", "what", bucket.alias("bucket"), bit.alias("bit")).groupBy("event_date", "what", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, period: Column, name: str = "period") -> DataFrame:
    """Distinct ids per period (an expression over event_date): a column per kind, zero where none."""
    joined = bitmaps.groupBy(period.alias(name), "what", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counts = [F.coalesce(F.sum(F.when(F.col("what") == what, F.bitmap_count("bitmap"))), F.lit(0)).cast("long").alias(what) for what in IDS]
    return joined.groupBy(name).agg(*counts)


class Audience:
    """The stored bitmaps under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def _dictionary(self, runs: list[str]) -> DataFrame:
        read = self.spark.read.schema(DICTIONARY)
        return read.parquet(*(f"{self.root}/dictionary/{r}" for r in runs)) if runs else self.spark.createDataFrame([], DICTIONARY)

    def days(self) -> list[str]:
        return sorted(self.log.read()[1].get("days", {}))

    def bitmaps(self, since=None, until=None) -> DataFrame:
        """The stored rows of the days from ``since`` to ``until`` (inclusive); only their runs are read."""
        days = self.log.read()[1].get("days", {})
        by_run: dict[str, list[date]] = {}
        for d, run in days.items():
            if (since is None or d >= str(since)) and (until is None or d <= str(until)):
                by_run.setdefault(run, []).append(date.fromisoformat(d))
        parts = [self.spark.read.schema(BITMAPS).parquet(f"{self.root}/bitmaps/{run}").filter(F.col("event_date").isin(own)) for run, own in by_run.items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], BITMAPS)

    def add(self, stg: DataFrame, days: list[str | date]) -> int:
        """Add or replace ``days`` from the staged events; returns the version.

        A day without events is stored as empty.  Raises where another run committed meanwhile.
        """
        wanted = [date.fromisoformat(str(d)) for d in days]
        version, manifest = self.log.read()
        runs = manifest.get("dictionaries", [])
        seen = materialise(seen_ids(stg.filter(F.col("event_date").isin(wanted))), "seen")
        known = self._dictionary(runs)
        rows, following = numbered(materialise(seen.select("what", "id").distinct().join(known, ["what", "id"], "left_anti"), "new_ids"), manifest.get("next", {}))
        run = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/dictionary/{run}")
        made = day_bitmaps(seen, self._dictionary([*runs, run]))
        made.repartitionByRange("event_date", "what", "bucket").sortWithinPartitions("event_date", "what", "bucket").write.parquet(f"{self.root}/bitmaps/{run}")
        committed = self.log.commit({"days": {**manifest.get("days", {}), **{str(d): run for d in wanted}}, "dictionaries": [*runs, run], "next": following}, version)
        if committed is None:
            raise RuntimeError("another run committed meanwhile; nothing was changed")
        return committed

    def counts(self, period: Column | None = None, since=None, until=None, name: str = "period") -> DataFrame:
        """Distinct users and sessions per period; by default per day."""
        return distinct_counts(self.bitmaps(since, until), F.col("event_date") if period is None else period, name)


def weekly_audience(stg: DataFrame) -> DataFrame:
    """(week_start, users, sessions): the distinct ids of each week, from the days' bitmaps."""
    seen = materialise(seen_ids(stg), "seen")
    dictionary, _ = numbered(seen.select("what", "id").distinct(), {})
    bitmaps = day_bitmaps(seen, dictionary)
    return distinct_counts(bitmaps, F.date_trunc("week", F.col("event_date")).cast("date"), "week_start")
