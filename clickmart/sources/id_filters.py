"""Bloom filters over the event ids of a day, as rows of Spark's own bitmaps.

A filter of ``bits`` bits is a table (event_date, bucket, bitmap): bucket ``b`` holds the bits
32768 b and on.  An id sets HASHES bits, each at its own hash modulo the filter's size.  An id
whose bits aren't all set isn't in the day; one whose bits are may be.  Building is one
aggregation, looking up one join on (event_date, bucket), so neither the filter of a large day
nor the ids that are looked up need to fit in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 7
#: Bits for each id: about one id in a hundred that isn't there passes.
BITS_PER_ID = 10
#: Bits of one of Spark's bitmaps.
BUCKET = 8 * 4096
#: Bitmaps that one task builds, about: it sorts HASHES rows (about 85 bytes) for each of their ids.
BUCKETS_PER_TASK = 64


def size_of(ids: int, bits_per_id: int = BITS_PER_ID) -> int:
    """Bits of a filter for so many ids: whole buckets."""
    return max(1, -(-ids * bits_per_id // BUCKET)) * BUCKET


def _set_bits(rows: DataFrame, bits: Column) -> DataFrame:
    """A row per id and hash, with the ``bucket`` and ``bit`` that it sets."""
    each = rows.select("event_date", "event_id", bits.alias("bits"), F.explode(F.sequence(F.lit(0), F.lit(HASHES - 1))).alias("hash"))
    place = F.pmod(F.xxhash64("event_id", "hash"), F.col("bits"))
    bit = F.pmod(place, F.lit(BUCKET))
    return each.select("event_date", "event_id", F.floor((place - bit) / BUCKET).cast("int").alias("bucket"), bit.alias("bit"))


def _bits_of(sizes: dict) -> Column:
    """The filter's size by day, as an expression (a constant per day)."""
    return F.create_map(*(x for day, bits in sizes.items() for x in (F.lit(day).cast("date"), F.lit(bits).cast("long"))))[F.col("event_date")]


def build(rows: DataFrame, sizes: dict) -> DataFrame:
    """The filters of days: (event_date, bucket, bitmap).  ``sizes``: bits by day (as text).

    Building bitmaps sorts the rows, so they are dealt out by bucket first: a task's share follows
    the number of its bitmaps, not the size of the files it reads.
    """
    ids = rows.filter(F.col("event_id").isNotNull()).select("event_date", "event_id")
    tasks = max(1, -(-sum(sizes.values()) // (BUCKET * BUCKETS_PER_TASK)))
    return _set_bits(ids, _bits_of(sizes)).repartition(tasks, "event_date", "bucket").groupBy("event_date", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def possible(ids: DataFrame, filters: DataFrame, sizes: dict) -> DataFrame:
    """Those of the distinct ``ids`` (event_date, event_id) that may be in their day's filter."""
    ids = ids.filter(F.col("event_id").isNotNull()).select("event_date", "event_id").distinct()
    found = _set_bits(ids, _bits_of(sizes)).join(filters, ["event_date", "bucket"])
    byte = F.expr("CAST(conv(hex(substring(bitmap, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    is_set = F.expr("bit % 8").cast("int")
    hit = found.select("event_date", "event_id", F.getbit(byte, is_set).alias("hit"))
    return hit.groupBy("event_date", "event_id").agg(F.sum("hit").alias("hits")).filter(F.col("hits") == HASHES).select("event_date", "event_id")
