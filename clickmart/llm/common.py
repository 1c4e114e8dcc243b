"""Helpers shared by the operators of this sub-package."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.session import materialise

__all__ = ["find_package", "HOT_SHARE", "SPACES", "ascii_lower", "join_classes", "materialise", "most_frequent", "row_key", "text_or_empty", "without_rows"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: White space of the contracts: blank and the five controls 09-0D.
SPACES = " \t\n\v\f\r"

#: A class with more than one row in HOT_SHARE is hot; at most HOT_SHARE classes can be.
HOT_SHARE = 1000


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, wherever the session was started.

    On a cluster the package is shipped with the job (``--py-files`` or installed).
    """
    sc = spark.sparkContext
    path = sc.environment.get("PYTHONPATH", "")
    if sc.master.startswith("local") and ROOT not in path.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, path)))


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(column, upper, upper.lower())


def join_classes(rows: DataFrame, classes: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with their ``classes`` (one row per ``key``; ``size``: its rows).

    A hot class would put its rows into one task.  Classes with over ``total / HOT_SHARE``
    rows number at most ``HOT_SHARE``, so they are broadcast; the others are joined by shuffle.
    """
    hot = F.col(size) * HOT_SHARE > total
    few = F.broadcast(classes.filter(hot))
    many = classes.filter(~hot)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(many, key))


def without_rows(docs: DataFrame, dropped: DataFrame, most: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is in ``dropped`` (column ``key``).

    Up to ``most`` keys (8 bytes each) are broadcast, so that the texts stay where they are; more
    are joined by shuffle.
    """
    dropped = materialise(dropped.select("key").distinct(), "dropped").withColumnRenamed("key", "_llm_dropped")
    if dropped.count() <= most:
        dropped = F.broadcast(dropped)
    columns = docs.columns
    keyed = docs.withColumn("_llm_key", row_key())
    return keyed.join(dropped, F.col("_llm_key") == F.col("_llm_dropped"), "left_anti").select(*columns)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 64-bit hash of id and text, by which rows are told apart where ids may be null or repeat."""
    return F.xxhash64(F.col(id_col), text_or_empty(text_col))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows of ``counts`` (a column ``count``, at least 1) from the smallest count on that leaves
    at most ``most`` of them, by a histogram of the counts' logarithms: no sort, and no task sees
    more than its share."""
    counts = materialise(counts, "counts")
    level = F.floor(F.log2("count") * 8)
    found = dict(counts.groupBy(level.alias("level")).count().collect())  # at most 8 levels a doubling
    lowest, total = None, 0
    for at in sorted(found, reverse=True):
        total += found[at]
        if total > most:
            break
        lowest = at
    return counts.filter(level >= lowest) if lowest is not None else counts.limit(0)
