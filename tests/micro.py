"""Hand-written micro tables (FIXTURES.md section 3) in the bronze schema."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from clickmart.schema import BRONZE_SCHEMA

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def ev(
    event_id,
    ts,
    event_type="page_view",
    user="U1",
    session="S1",
    product="P1",
    price=Decimal("10.00"),
    quantity=None,
    device="Desktop",
    browser="Chrome",
    country="USA",
    ingested=None,
):
    return (
        event_id,
        ts,
        user,
        session,
        event_type,
        product,
        f"name {product}" if product else None,
        "cat",
        price,
        quantity,
        "https://shop.example.com",
        "https://google.com",
        device,
        browser,
        country,
        "City",
        ingested if ingested is not None else ts + dt.timedelta(seconds=5),
    )


def bronze_df(spark, rows):
    # micro tables break the declared NOT NULL contract on purpose
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in BRONZE_SCHEMA.fields])
    return spark.createDataFrame(rows, schema)


def minutes(m):
    return dt.timedelta(minutes=m)
