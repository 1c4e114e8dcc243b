"""Plan-shape checks: the properties the scale design relies on."""

from __future__ import annotations

import re

import pytest

from clickmart.operators.dedup import dedup_keep_last
from clickmart.operators.ranking import asc, desc, with_ntiles, with_ranks
from clickmart.plans.registry import QUERIES, run
from clickmart.schema import BRONZE_SCHEMA
from clickmart.session import materialise
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    p = plan(run("stg_clickstream_events", spark, SF_SMALL))
    # partial top-1 per event id runs below the exchange, final above it
    assert re.search(r"WindowGroupLimit .*Final", p) and re.search(r"WindowGroupLimit .*Partial", p)
    assert p.index("Final") < p.index("Exchange hashpartitioning(event_id") < p.rindex("Partial")


def test_scan_reads_only_needed_columns(spark):
    p = plan(run("stg_clickstream_events", spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string" in schemas
    assert all("value" not in s for s in schemas)  # events.value is never read


def test_keep_last_shuffles_no_null_ids(spark):
    df = spark.createDataFrame([], BRONZE_SCHEMA)
    p = plan(dedup_keep_last(df))
    # the branch of the NULL ids is a filter alone; the window has one exchange
    assert p.count("Exchange hashpartitioning(event_id") == 1 and "monotonically_increasing_id" not in p


def test_daily_metrics_expand_no_events(spark):
    p = plan(run("daily_event_metrics", spark, SF_SMALL))
    # the distinct counts expand rows that are already summed per day, user and session
    assert p.count("Expand") == 1
    below = p[p.index("Expand") :]
    assert "hashpartitioning(event_date" in below and "partial_count" in below


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_quadratic_or_sort_fallback_operators(spark, name):
    p = plan(run(name, spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, bad


def test_ranking_is_linear_in_the_scores(spark):
    """Ranks: one broadcast and one shuffled join each, the ranked table read once; tiles: no join."""
    df = spark.createDataFrame([(f"u{i}", i % 7, i % 5, i % 3) for i in range(50)], "id string, a int, b int, c int")
    df = materialise(df, "test")
    for n in (1, 2, 3):
        p = plan(with_ranks(df, [(f"r{k}", [desc(k)]) for k in "abc"[:n]]))
        assert p.count("FileScan parquet") == 1 + 2 * n and "Window" not in p
        p = plan(with_ntiles(df, [(f"t{k}", 5, [asc(k), asc("id")]) for k in "abc"[:n]]))
        assert p.count("FileScan parquet") == 1 and "Exchange" not in p and "Window" not in p


def test_ranked_marts_start_from_a_written_table(spark):
    p = plan(run("mart_user_behavior", spark, SF_SMALL))
    assert "events.parquet" not in p and "users-" in p
