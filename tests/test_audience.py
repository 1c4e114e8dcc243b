"""Distinct counts from stored day bitmaps equal exact counts, over any days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickmart.plans import audience
from clickmart.plans.silver import stg_clickstream_events
from clickmart.sources.clickstream import clickstream
from tests.conftest import SF_SMALL


def exact(stg, period):
    rows = stg.groupBy(period.alias("p")).agg(F.count_distinct("user_id").alias("u"), F.count_distinct("session_id").alias("s")).collect()
    return sorted((r.p, r.u, r.s) for r in rows)


def stored(df):
    return sorted((r["period"], r.users, r.sessions) for r in df.collect())


@pytest.fixture(scope="module")
def stg(spark):
    return stg_clickstream_events(clickstream(spark, SF_SMALL), "2024-02-06 00:00:00").select("event_date", "user_id", "session_id").persist()


def test_days_added_one_run_after_another(spark, tmp_dir, stg):
    days = [r.event_date for r in stg.select("event_date").distinct().orderBy("event_date").collect()]
    store = audience.Audience(spark, tmp_dir)
    assert store.days() == [] and store.counts().count() == 0
    cut = [days[:3], days[3:4], days[4:]]
    assert [store.add(stg, own) for own in cut] == [0, 1, 2]
    week, every = F.date_trunc("week", "event_date").cast("date"), F.lit("all")
    assert stored(store.counts()) == exact(stg, F.col("event_date"))
    assert stored(store.counts(week)) == exact(stg, week)
    assert stored(store.counts(every)) == exact(stg, every)
    some = store.counts(every, days[2], days[5])
    assert stored(some) == exact(stg.filter(F.col("event_date").between(days[2], days[5])), every)
    # ids got dense numbers, each once
    numbers = store._dictionary(store.log.read()[1]["dictionaries"])
    for what, column in audience.IDS.items():
        own = [r.number for r in numbers.filter(F.col("what") == what).collect()]
        assert sorted(own) == list(range(stg.select(column).distinct().count()))
    # weeks are read from the bitmaps alone
    plan = store.counts(week)._jdf.queryExecution().executedPlan().toString()
    assert "/bitmaps/" in plan and "dictionary" not in plan


def test_a_day_is_replaced(spark, tmp_dir):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "event_date date, user_id string, session_id string"
    first = spark.createDataFrame([(d1, "a", "s1"), (d1, "b", None), (d2, "a", "s1"), (d2, None, "s2"), (None, "z", "z")], schema)
    store = audience.Audience(spark, tmp_dir)
    store.add(first, [d1, d2, dt.date(2024, 1, 3)])
    assert stored(store.counts()) == [(d1, 2, 1), (d2, 1, 2)]  # the third day has no events
    store.add(spark.createDataFrame([(d2, "c", "s1"), (d2, "b", "s3")], schema), ["2024-01-02"])
    assert stored(store.counts()) == [(d1, 2, 1), (d2, 2, 2)]
    assert stored(store.counts(F.lit("all"))) == [("all", 3, 2)]
    assert store.days() == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_failed_run_changes_nothing(spark, tmp_dir, stg, monkeypatch):
    store = audience.Audience(spark, tmp_dir)
    days = [r.event_date for r in stg.select("event_date").distinct().orderBy("event_date").limit(2).collect()]
    store.add(stg, days[:1])
    before = stored(store.counts())
    with monkeypatch.context() as m:
        m.setattr(audience, "day_bitmaps", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add(stg, days[1:])
    assert stored(store.counts()) == before
    store.add(stg, days[1:])
    assert stored(store.counts()) == exact(stg.filter(F.col("event_date").isin(days)), F.col("event_date"))


def test_numbers_beyond_one_bitmap(spark):
    n = 3 * audience.BUCKET // 2
    day = dt.date(2024, 1, 1)
    seen = spark.range(n).select(F.lit(day).alias("event_date"), F.lit("users").alias("what"), F.col("id").cast("string").alias("id"))
    dictionary, following = audience.numbered(seen.select("what", "id"), {"users": 7})
    assert following == {"users": n + 7}
    bitmaps = audience.day_bitmaps(seen, dictionary)
    assert bitmaps.count() == 2
    row = audience.distinct_counts(bitmaps, F.col("event_date")).first()
    assert (row.users, row.sessions) == (n, 0)
