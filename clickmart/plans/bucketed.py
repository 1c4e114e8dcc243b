"""Staged events bucketed by user: one shuffle serves the sessions and the users.

Written in buckets of ``user_id``, the events of a user lie in one file, so grouping by
(session_id, user_id), and the sessions by user_id, needs no further shuffle, in this job or any
later one.  A bucket is read by one task, so a user with more than one row in HOT_SHARE (there
are at most HOT_SHARE of them; null ids are one) would fill it: the rows of those users are
written apart, spread, and grouped with partial aggregation and a shuffle of its results.

The tables are external, under the caller's folder; ``read`` makes them known to any session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import gold, silver

KEY = "user_id"
#: A user with more than one row in HOT_SHARE is kept apart.
HOT_SHARE = 1000


@dataclass(frozen=True)
class BucketedEvents:
    """Staged events in two tables: ``even`` (bucketed by user) and ``hot`` (the rest)."""

    even: DataFrame
    hot: DataFrame

    def all(self) -> DataFrame:
        return self.even.unionByName(self.hot)

    def sessions(self, as_of=None) -> DataFrame:
        """``silver.int_user_sessions``: a session belongs to one user, so to one of the tables."""
        return silver.int_user_sessions(self.even, as_of).unionByName(silver.int_user_sessions(self.hot, as_of))

    def users(self, as_of=None) -> DataFrame:
        """``gold.user_aggregates``, from the sessions as they come."""
        of = [gold.user_aggregates(silver.int_user_sessions(t, as_of)) for t in (self.even, self.hot)]
        return of[0].unionByName(of[1])


def hot_users(stg: DataFrame) -> DataFrame:
    """The ids (null as well) of users with over a share of 1 in HOT_SHARE of the rows: column ``hot_id``."""
    total = stg.count()
    counts = stg.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") * HOT_SHARE > total).select(F.col(KEY).alias("hot_id"))


def _table(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    """The bucketed table at ``path`` as a table of the session (metadata only)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}, session_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read(spark: SparkSession, path: str, name: str, schema: T.StructType, buckets: int) -> BucketedEvents:
    """The tables that ``write`` left under ``path``; ``name``: a table name that the session may take."""
    return BucketedEvents(_table(spark, name, f"{path}/even", schema, buckets), spark.read.schema(schema).parquet(f"{path}/hot"))


def write(stg: DataFrame, path: str, name: str, buckets: int | None = None) -> BucketedEvents:
    """Write staged events into a new folder.  They are read four times: write out first what is
    costly to derive.

    ``buckets`` should keep a bucket's file at a task's size; by default as many as the session
    has shuffle partitions.
    """
    spark = stg.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_users(stg))
    same = F.col(KEY).eqNullSafe(F.col("hot_id"))
    stg.join(hot, same, "left_semi").write.parquet(f"{path}/hot")
    even = stg.join(hot, same, "left_anti").repartition(buckets, KEY)  # a task is a bucket, so a bucket is a file
    even.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY, "session_id").option("path", f"{path}/even").saveAsTable(name)
    return read(spark, path, name, stg.schema, buckets)
