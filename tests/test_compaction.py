"""Compaction of streamed bronze: every event once, before, during and after; replays; files per day."""

from __future__ import annotations

import json
import os
from collections import Counter
from datetime import datetime

import pytest

from clickmart.sources import compaction
from clickmart.sources.bronze import read_bronze
from clickmart.sources.commits import Folder
from clickmart.streaming.ingest import BronzeBatchWriter
from tests.test_ingest import GOOD

STAMP = datetime(2024, 2, 1)


def batch(spark, tmp_dir, n, ids, day="2024-01-05", parts=4):
    """Write micro-batch ``n`` with an event per id."""
    rows = [(json.dumps(dict(GOOD, event_id=i, event_timestamp=f"{day} 10:00:{k % 60:02d}")),) for k, i in enumerate(ids)]
    writer = BronzeBatchWriter(f"{tmp_dir}/bronze", f"{tmp_dir}/rejects", STAMP)
    writer(spark.createDataFrame(rows, "value string").repartition(parts), n)


def ids(df):
    return Counter(r.event_id for r in df.select("event_id").collect())


def read(spark, tmp_dir, **kwargs):
    return read_bronze(spark, f"{tmp_dir}/bronze", **kwargs)


def named(*ranges):
    return Counter(f"E{i}" for r in ranges for i in r)


@pytest.fixture()
def table(spark, tmp_dir):
    """Six batches: five on day 5, the last on days 5 and 6."""
    for n in range(5):
        batch(spark, tmp_dir, n, [f"E{i}" for i in range(10 * n, 10 * n + 10)])
    batch(spark, tmp_dir, 5, [f"E{i}" for i in range(50, 60)], "2024-01-06")
    return f"{tmp_dir}/bronze"


def test_compacted_days_are_read_once(spark, tmp_dir, table):
    folder = Folder(spark, table)
    assert folder.files("event_date=2024-01-05") > 5
    before = read(spark, tmp_dir)  # a reader that began before the compaction
    plain = sorted(map(str, before.collect()))
    out = compaction.compact(spark, table, "2024-01-06")
    assert out == {"version": 0, "days": ["2024-01-05"]}
    after = read(spark, tmp_dir)
    assert ids(before) == ids(after) == named(range(60))
    assert sorted(map(str, after.collect())) == plain and after.columns == before.columns
    # one new file for the day
    files = [f for f in after.inputFiles() if "2024-01-05" in f]
    assert len([f for f in files if "_compacted" in f]) == 1
    assert compaction.compact(spark, table, "2024-01-06")["days"] == []  # nothing left to do
    days = ids(read(spark, tmp_dir, since="2024-01-05", until="2024-01-05")), ids(read(spark, tmp_dir, since="2024-01-06"))
    assert days == (named(range(50)), named(range(50, 60)))


def test_covered_folders_are_not_opened(spark, tmp_dir, table):
    compaction.compact(spark, table, "2024-01-06")
    # files that would fail if they were opened
    for at, _, names in os.walk(f"{table}/event_date=2024-01-05"):
        for n in names:
            if n.endswith(".parquet"):
                crc = os.path.join(at, f".{n}.crc")
                with open(os.path.join(at, n), "wb") as f:
                    f.write(b"no parquet")
                if os.path.exists(crc):
                    os.truncate(crc, 0)
    assert ids(read(spark, tmp_dir)) == named(range(60))


def test_replay_of_a_compacted_batch_is_harmless(spark, tmp_dir, table):
    compaction.compact(spark, table, "2024-01-06")
    batch(spark, tmp_dir, 3, [f"E{i}" for i in range(30, 40)])
    assert ids(read(spark, tmp_dir)) == named(range(60))
    # also after the old folders are gone
    assert compaction.clean(spark, table)["batch_folders"] == 5
    assert Folder(spark, table).files("event_date=2024-01-05") == 0
    assert ids(read(spark, tmp_dir)) == named(range(60))
    batch(spark, tmp_dir, 3, [f"E{i}" for i in range(30, 40)])
    assert ids(read(spark, tmp_dir)) == named(range(60))


def test_the_last_batch_may_be_half_written(spark, tmp_dir):
    """The last batch isn't compacted, so its replay with more rows isn't lost."""
    batch(spark, tmp_dir, 0, ["E0", "E1"])
    batch(spark, tmp_dir, 1, ["E2"])  # failed after a part of its rows
    assert compaction.compact(spark, f"{tmp_dir}/bronze", "2024-01-06")["days"] == ["2024-01-05"]
    batch(spark, tmp_dir, 1, ["E2", "E3"])
    assert ids(read(spark, tmp_dir)) == named(range(4))


def test_late_events_and_second_compaction(spark, tmp_dir, table):
    compaction.compact(spark, table, "2024-01-06")
    batch(spark, tmp_dir, 6, [f"E{i}" for i in range(60, 70)])  # late, on the compacted day
    batch(spark, tmp_dir, 7, ["E70"], "2024-01-07")
    assert ids(read(spark, tmp_dir)) == named(range(71))
    middle = read(spark, tmp_dir)
    out = compaction.compact(spark, table, "2024-01-07", rows_per_file=25)
    assert out == {"version": 1, "days": ["2024-01-05", "2024-01-06"]}
    assert ids(middle) == ids(read(spark, tmp_dir)) == named(range(71))
    # 60 and 10 rows, 25 a file; a file boundary may fall into a day once more
    log = compaction.manifest_log(spark, table)
    run = log.read()[1]["days"]["2024-01-05"]["run"]
    assert Folder(spark, f"{table}/_compacted/data/{run}").files("event_date=2024-01-05") <= 4
    cleaned = compaction.clean(spark, table)
    assert cleaned["runs"] == 1 and log.versions() == [1]
    assert ids(read(spark, tmp_dir)) == named(range(71))


def test_two_compactions_at_once(spark, tmp_dir, table, monkeypatch):
    """The one that commits second changes nothing."""
    commit = compaction.CommitLog.commit

    def late(self, manifest, after):
        monkeypatch.setattr(compaction.CommitLog, "commit", commit)
        compaction.compact(spark, table, "2024-01-06")
        return commit(self, manifest, after)

    monkeypatch.setattr(compaction.CommitLog, "commit", late)
    with pytest.raises(RuntimeError, match="another compaction"):
        compaction.compact(spark, table, "2024-01-06")
    assert ids(read(spark, tmp_dir)) == named(range(60))
    assert len(Folder(spark, f"{table}/_compacted/data").names()) == 1


def test_tables_without_batches(spark, tmp_dir):
    """A table written in batch mode has no batch folders: nothing to compact, all rows read."""
    from clickmart.sources.bronze import write_bronze

    batch(spark, tmp_dir, 0, ["E0", "E1"])
    write_bronze(read(spark, tmp_dir), f"{tmp_dir}/plain")
    assert compaction.compact(spark, f"{tmp_dir}/plain", "2024-02-01") == {"version": None, "days": []}
    assert ids(read_bronze(spark, f"{tmp_dir}/plain")) == named(range(2))
