"""Parse, repair and stamp JSON events: one set of functions for batch and stream.

``parse_events`` turns a ``value`` column of JSON text into the 16 typed wire
columns.  ``from_json`` does not enforce non-null fields and turns broken text
into an all-NULL row, so the split into good rows and rejects is explicit here:
a row is rejected when the text does not parse, a required field is missing,
or the timestamp does not cast.  Rejects keep the raw text for replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pg import as_of_literal, utc_clock
from ..schema import QUANTITY_EVENT_TYPES, REQUIRED_COLUMNS, WIRE_COLUMNS, WIRE_SCHEMA

# a time of day with Z, an offset or a zone name after it
ZONED = r"(?i):\d{2}.*(z|utc|gmt|[+-]\d{1,2}(:?\d{2})*|[a-z_]+/[a-z_/]+)$"

RAW = "_raw"
REASON = "reject_reason"
CORRUPT = "_corrupt_record"
# the wire schema plus a slot that receives text that does not parse
PARSE_SCHEMA = T.StructType(WIRE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def to_wire_json(bronze: DataFrame) -> DataFrame:
    """Serialise bronze rows to the wire form: one JSON text per event."""
    cols = [
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp")
        if c == "event_timestamp"
        else F.col(c)
        for c in WIRE_COLUMNS
    ]
    return bronze.select(F.to_json(F.struct(*cols)).alias("value"))


def _parsed(df: DataFrame, value_col: str) -> DataFrame:
    text = F.col(value_col).cast("string")
    return df.select(
        text.alias(RAW),
        F.from_json(text, PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("d"),
    )


def event_clock(text: Column) -> Column:
    """Event time as a UTC wall clock: text with an offset is converted, text without one is taken
    as it is; NULL when it is no timestamp."""
    zoned = utc_clock(text.try_cast("timestamp"))
    return F.when(F.trim(text).rlike(ZONED), zoned).otherwise(text.try_cast("timestamp_ntz"))


def _reason() -> Column:
    d = F.col("d")
    # text that is not a JSON object: nothing parsed.  A wrong-typed field
    # alone only NULLs that field (the row is kept, as from_json does).
    nothing = d[CORRUPT].isNotNull()
    for c in REQUIRED_COLUMNS:
        nothing = nothing & d[c].isNull()
    expr = F.when(d.isNull() | nothing, F.lit("unparseable"))
    for c in REQUIRED_COLUMNS:
        expr = expr.when(d[c].isNull(), F.lit(f"missing {c}"))
    return expr.when(event_clock(d["event_timestamp"]).isNull(), F.lit("bad event_timestamp"))


def parse_with_reason(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw text, the parsed struct and the reject reason (NULL when good)."""
    return _parsed(df, value_col).withColumn(REASON, _reason())


def split_parsed(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed events, rejects) from :func:`parse_with_reason` output."""
    good = p.filter(F.col(REASON).isNull()).select(
        *[
            event_clock(F.col("d")[c]).alias(c) if c == "event_timestamp" else F.col("d")[c].alias(c)
            for c in WIRE_COLUMNS
        ]
    )
    rejects = p.filter(F.col(REASON).isNotNull()).select(F.col(RAW).alias("raw_value"), REASON)
    return good, rejects


def parse_events(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw messages into (typed events, rejects).

    Both outputs come from the same projection.  The stream sink writes the
    events from it and, only when it counted rejects, parses the batch again
    for them.
    """
    return split_parsed(parse_with_reason(df, value_col))


def repair_quantity(df: DataFrame) -> DataFrame:
    """Cart and purchase events with a NULL or non-positive quantity get 1;
    every other row keeps its quantity."""
    q = F.col("quantity")
    fix = F.col("event_type").isin(*QUANTITY_EVENT_TYPES) & (q.isNull() | (q <= 0))
    return df.withColumn("quantity", F.when(fix, F.lit(1)).otherwise(q).cast("int"))


def stamp_ingestion(df: DataFrame, as_of=None) -> DataFrame:
    """Add ``ingestion_timestamp``; ``None`` is the wall clock, which Spark
    evaluates once per query (once per micro-batch in a stream)."""
    return df.withColumn("ingestion_timestamp", as_of_literal(as_of))


def ingest(df: DataFrame, value_col: str = "value", as_of=None) -> tuple[DataFrame, DataFrame]:
    """Parse, repair and stamp: (bronze rows, rejects)."""
    return ingest_parsed(parse_with_reason(df, value_col), as_of)


def ingest_parsed(parsed: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    good, rejects = split_parsed(parsed)
    return stamp_ingestion(repair_quantity(good), as_of), rejects
