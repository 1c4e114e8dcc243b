"""Versioned rebuilds: all tables of a run or none, pinned readers, concurrent writers, expiry."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from clickmart.plans import gold, quality
from clickmart.plans.refresh import refresh
from clickmart.plans.snapshots import Snapshots
from clickmart.sources.clickstream import clickstream
from clickmart.sources.commits import CommitLog
from tests.conftest import SF_SMALL

AS_OF = "2024-02-06 00:00:00"
MARTS = (quality.DAILY, quality.FUNNEL, quality.PRODUCTS, quality.USERS)


def rows(snapshot, table):
    return sorted(map(str, snapshot.read(table).collect()))


def test_failing_mart_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    bronze = clickstream(spark, SF_SMALL)
    first = refresh(spark, bronze, tmp_dir, AS_OF, run_checks=False)
    versions = Snapshots(spark, tmp_dir)
    old = versions.pin()
    assert old.version == first["version"] == 0 and len(old.tables) == 6
    before = {m: rows(old, f"gold/{m}") for m in MARTS}

    def fails(*args, **kwargs):
        raise RuntimeError("the third mart fails")

    half = bronze.filter("event_timestamp < '2024-01-10'")
    with monkeypatch.context() as m:
        m.setattr(gold, "mart_product_performance", fails)
        with pytest.raises(RuntimeError, match="third mart"):
            refresh(spark, half, tmp_dir, AS_OF, run_checks=False)
    # the two marts that were written can't be seen; the old four are read, together
    now = versions.pin()
    assert now.version == 0 and {m: rows(now, f"gold/{m}") for m in MARTS} == before
    assert spark.table("stg_clickstream_events").count() == old.read("silver/stg_clickstream_events").count()

    second = refresh(spark, half, tmp_dir, AS_OF, run_checks=False)
    assert second["version"] == 1
    new = versions.pin()
    assert rows(new, f"gold/{quality.USERS}") != before[quality.USERS]
    # a reader that pinned the old version still reads all of it
    assert {m: rows(old, f"gold/{m}") for m in MARTS} == before
    assert spark.table("int_user_sessions").count() == new.read("silver/int_user_sessions").count()

    # the failed run's folder goes with the unfinished ones, the old version with the old ones
    later = datetime.now(timezone.utc) + timedelta(seconds=1)
    assert len(versions.expire(keep=2)) == 0
    gone = versions.expire(keep=1, unfinished_before=later)
    assert len(gone) == 2 and old.manifest["run"] in gone and versions.log.versions() == [1]
    assert rows(versions.pin(), f"gold/{quality.USERS}") == rows(new, f"gold/{quality.USERS}")
    with pytest.raises(ValueError):
        versions.expire(keep=0)


def test_check_results_are_part_of_a_version(spark, tmp_dir):
    out = refresh(spark, clickstream(spark, SF_SMALL), tmp_dir, AS_OF)
    version = Snapshots(spark, tmp_dir).pin(out["version"])
    assert version.notes["failures"] == out["failures"]
    stored = {t.split("/")[1]: version.read(t).count() for t in version.tables if t.startswith("test_results/")}
    assert stored == out["failures"] and len(stored) == 24


def test_concurrent_rebuilds_take_different_numbers(spark, tmp_dir):
    versions = Snapshots(spark, tmp_dir)
    assert versions.latest() is None
    with pytest.raises(FileNotFoundError):
        versions.pin()
    with versions.rebuild() as one:
        one.write("t", spark.range(1))
        with versions.rebuild() as other:
            other.write("t", spark.range(2))
        one_sees = versions.pin()
        assert one_sees.read("t").count() == 2
    assert (other.version, one.version) == (0, 1)
    assert versions.pin(0).read("t").count() == 2 and versions.pin().read("t").count() == 1


def test_empty_tables_and_schemas(spark, tmp_dir):
    versions = Snapshots(spark, tmp_dir)
    schema = "a decimal(10,2), b struct<c:array<timestamp_ntz>>"
    with versions.rebuild() as new:
        new.write("gold/none", spark.createDataFrame([], schema))
    got = versions.pin().read("gold/none")
    assert got.count() == 0 and got.schema == spark.createDataFrame([], schema).schema


def test_commit_log(spark, tmp_dir):
    log = CommitLog(spark, f"{tmp_dir}/log")
    assert log.read() == (None, {})
    assert log.commit({"a": "é"}, None) == 0
    assert log.commit({"a": 2}, None) is None  # taken
    assert log.commit({"a": 2}, 0) == 1
    assert log.read() == (1, {"a": 2}) and log.read(0) == (0, {"a": "é"})
    assert log.folder.names() == ["000000000000.json", "000000000001.json"]  # no drafts left
