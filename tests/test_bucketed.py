"""Sessions and users of bucketed events: no shuffle, the same rows, hot users apart."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from clickmart.plans import bucketed, gold, silver
from clickmart.sources.clickstream import clickstream
from tests.conftest import SF_SMALL

AS_OF = "2024-02-06 00:00:00"


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stg(spark):
    return silver.stg_clickstream_events(clickstream(spark, SF_SMALL), AS_OF).persist()


@pytest.fixture()
def name(spark):
    made = f"stg_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def test_no_shuffle_between_events_sessions_and_users(spark, tmp_dir, stg, name, monkeypatch):
    monkeypatch.setattr(bucketed, "HOT_SHARE", 1)  # nobody is hot
    events = bucketed.write(stg, tmp_dir, name, 6)
    assert events.hot.count() == 0 and events.even.count() == stg.count()
    sessions = silver.int_user_sessions(events.even, AS_OF)
    users = gold.user_aggregates(sessions)
    for df in (sessions, users):
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    want = silver.int_user_sessions(stg, AS_OF)
    assert rows(events.sessions(AS_OF)) == rows(want)
    assert rows(events.users(AS_OF)) == rows(gold.user_aggregates(want))
    # one file a bucket, so any later job is as cheap
    files = events.even.inputFiles()
    assert len(files) <= 6 and all(re.search(r"_0000\d\.c", f) for f in files)


def test_hot_users_are_kept_apart(spark, tmp_dir, stg, name):
    """One user and the null user hold a third of the rows each."""
    third = stg.count() // 3
    extra = stg.limit(third).withColumn("user_id", F.lit("HOT")).unionByName(stg.limit(third).withColumn("user_id", F.lit(None).cast("string")))
    skewed = stg.unionByName(extra).persist()
    bucketed_events = None
    try:
        share, bucketed.HOT_SHARE = bucketed.HOT_SHARE, 20
        bucketed_events = bucketed.write(skewed, tmp_dir, name, 4)
    finally:
        bucketed.HOT_SHARE = share
    hot = {r.user_id for r in bucketed_events.hot.select("user_id").distinct().collect()}
    assert {"HOT", None} <= hot
    assert not hot & {r.user_id for r in bucketed_events.even.select("user_id").distinct().collect()}
    assert rows(bucketed_events.all()) == rows(skewed)
    want = silver.int_user_sessions(skewed, AS_OF)
    assert rows(bucketed_events.sessions(AS_OF)) == rows(want)
    assert rows(bucketed_events.users(AS_OF)) == rows(gold.user_aggregates(want))


def test_another_session_reads_the_buckets(spark, tmp_dir, stg, name):
    bucketed.write(stg, tmp_dir, name, 3)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    again = bucketed.read(spark, tmp_dir, name, stg.schema, 3)
    assert rows(again.all()) == rows(stg)
    assert "Exchange" not in plan(silver.int_user_sessions(again.even, AS_OF))
