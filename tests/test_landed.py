"""Late replays are dropped by the id filters of compacted days, and nothing else is."""

from __future__ import annotations

import json
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickmart.sources import compaction, id_filters
from clickmart.sources.bronze import read_bronze
from clickmart.streaming import landed
from clickmart.streaming.ingest import BronzeBatchWriter, read_events, start_ingest
from tests.test_ingest import GOOD


def messages(ids, day):
    return [json.dumps(dict(GOOD, event_id=i, event_timestamp=f"{day} 10:00:{k % 60:02d}")) for k, i in enumerate(ids)]


def batch(spark, tmp_dir, n, rows, drop=True):
    writer = BronzeBatchWriter(f"{tmp_dir}/bronze", f"{tmp_dir}/rejects", datetime(2024, 2, 1), drop_landed=drop)
    writer(spark.createDataFrame([(r,) for r in rows], "value string").repartition(3), n)


def ids(spark, tmp_dir):
    return Counter(r.event_id for r in read_bronze(spark, f"{tmp_dir}/bronze").select("event_id").collect())


@pytest.mark.parametrize("bits_per_id", [10, 0])  # 0: one bucket for all, still no false drop
def test_replay_a_week_later(spark, tmp_dir, bits_per_id):
    old = [f"E{i}" for i in range(300)]
    batch(spark, tmp_dir, 0, messages(old[:150], "2024-01-05"))
    batch(spark, tmp_dir, 1, messages(old[150:], "2024-01-05"))
    batch(spark, tmp_dir, 2, messages(["F0"], "2024-01-12"))
    compaction.compact(spark, f"{tmp_dir}/bronze", "2024-01-06", bits_per_id=bits_per_id)
    compaction.clean(spark, f"{tmp_dir}/bronze")
    # a week later: a replay of the old day with late new events among it, and the day's own events
    late = [f"L{i}" for i in range(40)]
    batch(spark, tmp_dir, 3, messages(old + late, "2024-01-05") + messages(["F1", "F2"], "2024-01-12"))
    want = Counter(old + late + ["F0", "F1", "F2"])
    assert ids(spark, tmp_dir) == want
    # late events that came after the compaction are known as well
    batch(spark, tmp_dir, 4, messages(late + ["L99"], "2024-01-05"))
    assert ids(spark, tmp_dir) == want + Counter(["L99"])
    # the same batch again (a failed one, replayed) finds itself and writes the same
    batch(spark, tmp_dir, 4, messages(late + ["L99"], "2024-01-05"))
    assert ids(spark, tmp_dir) == want + Counter(["L99"])
    # the same id on another day is another event; open days aren't looked up
    batch(spark, tmp_dir, 5, messages(["E1"], "2024-01-12"))
    assert ids(spark, tmp_dir) == want + Counter(["L99", "E1"])
    batch(spark, tmp_dir, 6, messages(["L99", "E1"], "2024-01-05"), drop=False)
    assert ids(spark, tmp_dir) == want + Counter(["L99", "E1", "L99", "E1"])


def test_filter_alone(spark):
    day = date(2024, 1, 5)
    rows = spark.createDataFrame([(day, f"E{i}") for i in range(20_000)] + [(day, None), (date(2024, 1, 6), "X")], "event_date date, event_id string").repartition(5)
    sizes = {"2024-01-05": id_filters.size_of(20_000), "2024-01-06": id_filters.size_of(1)}
    assert sizes == {"2024-01-05": 7 * id_filters.BUCKET, "2024-01-06": id_filters.BUCKET}
    filters = id_filters.build(rows, sizes).persist()
    assert filters.filter("event_date = '2024-01-05'").count() == 7 and {len(r.bitmap) for r in filters.collect()} == {4096}
    known = id_filters.possible(rows, filters, sizes)
    assert known.count() == 20_001  # all of the ids, not the null one
    others = spark.createDataFrame([(day, f"N{i}") for i in range(20_000)] + [(date(2024, 1, 6), "E1")], "event_date date, event_id string")
    assert id_filters.possible(others, filters, sizes).count() < 0.03 * 20_000
    filters.unpersist()


def test_filters_are_built_in_shares_of_bitmaps(spark, monkeypatch):
    """A task's share follows the number of bitmaps, not the partitions that the rows come in."""
    monkeypatch.setattr(id_filters, "BUCKETS_PER_TASK", 2)
    rows = spark.createDataFrame([(date(2024, 1, 5), f"E{i}") for i in range(20_000)], "event_date date, event_id string").coalesce(1)
    sizes = {"2024-01-05": id_filters.size_of(20_000)}
    made = id_filters.build(rows, sizes)
    assert made.rdd.getNumPartitions() == 4  # of 7 bitmaps
    assert made.count() == 7 and id_filters.possible(rows, made, sizes).count() == 20_000
    assert compaction.ROWS_PER_FILE <= 1_000_000  # a task sorts so many rows of half a KB


def test_only_possible_hits_meet_bronze(spark, tmp_dir, monkeypatch):
    batch(spark, tmp_dir, 0, messages([f"E{i}" for i in range(50)], "2024-01-05"))
    batch(spark, tmp_dir, 1, messages(["F"], "2024-01-06"))
    compaction.compact(spark, f"{tmp_dir}/bronze", "2024-01-06")
    path = f"{tmp_dir}/bronze"
    days = compaction.manifest_log(spark, path).read()[1]["days"]
    events = spark.createDataFrame([("2024-01-05", "E7"), ("2024-01-05", "new"), ("2024-01-06", "F")], "d string, event_id string").select(F.to_date("d").alias("event_date"), "event_id")
    late = landed.late_days(events, days)
    assert list(late) == ["2024-01-05"]
    out = landed.landed_ids(events, path, 9, late)
    assert [(str(r.event_date), r.event_id) for r in out.collect()] == [("2024-01-05", "E7")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "possible-" in plan and "LeftSemi" in plan and "_compacted/data" in plan
    # without a possible hit the day's rows aren't read at all
    none = landed.landed_ids(events.filter("event_id = 'new'"), path, 9, late)
    assert none.count() == 0 and "_compacted/data" not in none._jdf.queryExecution().executedPlan().toString()


def test_null_ids_are_kept(spark, tmp_dir):
    batch(spark, tmp_dir, 0, messages(["E0"], "2024-01-05"))
    batch(spark, tmp_dir, 1, messages(["E1"], "2024-01-05"))
    compaction.compact(spark, f"{tmp_dir}/bronze", "2024-01-06")
    rows = spark.createDataFrame([(date(2024, 1, 5), None), (date(2024, 1, 5), "E0"), (None, "E0")], "event_date date, event_id string")
    kept = landed.drop_landed(rows, f"{tmp_dir}/bronze", 5).collect()
    assert sorted(map(str, ((r.event_date, r.event_id) for r in kept))) == ["(None, 'E0')", "(datetime.date(2024, 1, 5), None)"]


def test_stream_with_late_replay(spark, tmp_dir):
    """The stream itself: ingest, compact, then a replayed file arrives."""
    import os

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)

    def run(name, rows):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(rows) + "\n")
        q = start_ingest(read_events(spark, "text", src), f"{tmp_dir}/bronze", f"{tmp_dir}/r", f"{tmp_dir}/c", available_now=True, drop_landed=True)
        q.awaitTermination()
        q.stop()

    old = messages([f"E{i}" for i in range(30)], "2024-01-05")
    run("a.json", old)
    run("b.json", messages(["F0"], "2024-01-12"))
    compaction.compact(spark, f"{tmp_dir}/bronze", "2024-01-10")
    run("c.json", old + messages(["F1"], "2024-01-12"))
    assert ids(spark, tmp_dir) == Counter([f"E{i}" for i in range(30)] + ["F0", "F1"])
