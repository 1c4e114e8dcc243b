"""Distributed global rank / ntile / row_number equal the one-partition windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.operators.ranking import _sorted, asc, desc, global_ntile, global_rank, global_row_number


@pytest.fixture(scope="module")
def rank_ties(spark):
    random.seed(7)
    rows = []
    for i in range(3001):
        r = random.random()
        key = None if r < 0.1 else (7 if r < 0.55 else random.randint(0, 200))  # one key ~45%
        rows.append((f"u{i:05d}", key))
    return spark.createDataFrame(rows, "id string, key int").repartition(5)


@pytest.mark.parametrize("descending", [False, True])
def test_rank_ntile_rownumber_equal_builtin(spark, rank_ties, descending):
    k = desc("key") if descending else asc("key")
    order = [k, asc("id")]
    got = global_rank(rank_ties, [k], "r", partitions=6)
    got = global_ntile(got, 5, order, "nt", partitions=7)
    got = global_row_number(got, order, "rn", partitions=8)
    exp = rank_ties.select(
        "id",
        F.rank().over(Window.orderBy(k.sort())).alias("r2"),
        F.ntile(5).over(Window.orderBy(k.sort(), F.col("id"))).alias("nt2"),
        F.row_number().over(Window.orderBy(k.sort(), F.col("id"))).alias("rn2"),
    )
    j = got.join(exp, "id")
    assert j.count() == 3001
    bad = j.filter((F.col("r") != F.col("r2")) | (F.col("nt") != F.col("nt2")) | (F.col("rn") != F.col("rn2")))
    assert bad.count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23, 101])
def test_tiles_of_any_size(spark, n):
    df = spark.range(n).select(F.col("id").alias("i"))
    got = global_ntile(df, 5, [asc("i")], "t")
    exp = df.select("i", F.ntile(5).over(Window.orderBy("i")).alias("t2"))
    assert got.join(exp, "i").filter(F.col("t") != F.col("t2")).count() == 0
    assert got.count() == n


def test_key_types_and_columns(spark):
    """DESC on text and dates, a Column as key, a key that isn't unique."""
    df = spark.sql("SELECT id, concat('k', id % 4) AS s, date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS d FROM range(40)")
    got = global_rank(df, [desc("s")], "rs")
    got = global_rank(got, [desc("d"), asc("s")], "rd")
    got = global_rank(got, [asc(F.col("id") % 6)], "rc")
    got = global_ntile(got, 3, [desc(F.upper("s")), desc("id")], "t")
    exp = df.select(
        "id",
        F.rank().over(Window.orderBy(F.col("s").desc())).alias("rs2"),
        F.rank().over(Window.orderBy(F.col("d").desc(), "s")).alias("rd2"),
        F.rank().over(Window.orderBy(F.col("id") % 6)).alias("rc2"),
        F.ntile(3).over(Window.orderBy(F.col("s").desc(), F.col("id").desc())).alias("t2"),
    )
    j = got.join(exp, "id")
    assert j.count() == 40
    assert j.filter("rs != rs2 OR rd != rd2 OR rc != rc2 OR t != t2").count() == 0


def test_small_and_empty_inputs(spark):
    empty = spark.createDataFrame([], "id string, key int")
    assert global_ntile(empty, 5, [asc("key"), asc("id")], "t").count() == 0
    assert global_rank(empty, [asc("key")], "r").count() == 0
    tiny = spark.createDataFrame([("a", 1), ("b", None)], "id string, key int")
    nt = global_ntile(tiny, 5, [asc("key"), asc("id")], "t")
    out = {r.id: (r.t, r.r) for r in global_rank(nt, [asc("key")], "r").collect()}
    assert out == {"a": (1, 1), "b": (2, 2)}


def test_a_hot_key_is_cut(spark):
    # 90% of rows share one key; with 8 partitions none may hold them all
    df = spark.createDataFrame([(f"u{i:05d}", 0 if i % 10 else i) for i in range(4000)], "id string, key int")
    parts = _sorted(df, [asc("key").sort(), asc("id").sort()], 8).groupBy("_rk_part").count().collect()
    assert max(r["count"] for r in parts) < 0.5 * 4000 and len(parts) >= 6
