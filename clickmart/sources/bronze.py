"""Bronze table: Parquet with an explicit schema, partitioned by event date.

``bronze_scan`` is the explicit 17-column projection the staging model starts
from; with Parquet, Catalyst prunes columns and pushes filters into the scan,
and the ``event_date`` partition column lets date filters skip whole folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BRONZE_COLUMNS
from .compaction import BATCH_COLUMN, PARTITION_COLUMN, read_rows

__all__ = ["BATCH_COLUMN", "PARTITION_COLUMN", "bronze_scan", "read_bronze", "write_bronze"]


def bronze_scan(df: DataFrame) -> DataFrame:
    """The explicit projection of the 17 bronze columns."""
    return df.select(*BRONZE_COLUMNS)


def read_bronze(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """Read a bronze Parquet table written by :func:`write_bronze` or by the
    streaming ingest, compacted or not (no schema inference; the partition
    columns are dropped).

    ``since`` / ``until`` (dates, inclusive) become a filter on the
    ``event_date`` partition column: only files of those days are read.  The
    driver still lists all folders of the table.
    """
    return bronze_scan(read_rows(spark, path, since, until))


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append bronze rows partitioned by event date.

    No shuffle: each task sorts its own rows by date and writes one file per
    date it holds (a hash on the date alone would send a hot day to one task).
    """
    out = bronze_scan(df).withColumn(PARTITION_COLUMN, F.to_date("event_timestamp"))
    (
        out.sortWithinPartitions(PARTITION_COLUMN)
        .write.mode(mode)
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )
