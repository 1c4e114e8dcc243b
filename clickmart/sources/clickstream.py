"""Bronze clickstream derived from the driver's ``events`` and ``part`` tables.

The reference only has a random simulator; our inputs are the driver tables,
mapped onto the 17 bronze columns by a fixed rule (``FIXTURES.md`` §2).  Every
event becomes one bronze row; every tenth event is delivered twice (a replay
with a later ingestion stamp and one more unit) so keep-first and keep-last
deduplication disagree, as they do after an at-least-once replay.

Scale notes: one scan of ``events`` (the copy is made with ``explode`` rather
than a second scan and a union), column pruning to five event columns and
three part columns, and an equi-join on the product key that Catalyst
broadcasts only when ``part`` is under the broadcast threshold and plans as a
shuffle join otherwise.  That join has only 100 distinct keys, which suits a
fixture whose ``part`` is broadcast; it is no pattern for large dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# --- fixed values of the derivation rule -----------------------------------
EVENT_TYPE_MAP = {
    "view": "page_view",
    "error": "page_view",
    "click": "add_to_cart",
    "purchase": "purchase",
    "signup": "remove_from_cart",
}
DEVICES = ["Desktop", "Mobile", "Tablet"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
COUNTRIES = ["Nigeria", "USA", "UK", "UAE", "Canada"]
PRICE_OFFSET = "24.99"
INGEST_DELAY_SECONDS = 5
REPLAY_DELAY_SECONDS = 60
# --- end of fixed values ----------------------------------------------------


# Only the columns the derivation reads; giving the schema skips footer
# inference on the driver and prunes the Parquet scan.
EVENTS_COLUMNS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING"
PART_COLUMNS = "p_partkey BIGINT, p_name STRING, p_type STRING"


def _pick(values: list[str], index: str) -> str:
    """SQL for ``values[index]`` with a 0-based integer expression."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), CAST({index} AS INT) + 1)"


def _type_map(c: str) -> str:
    branches = " ".join(f"WHEN '{src}' THEN '{dst}'" for src, dst in EVENT_TYPE_MAP.items())
    return f"CASE {c} {branches} END"


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events (17 columns, duplicates included) for one scale directory."""
    ev = read_table(spark, sf_dir, "events", EVENTS_COLUMNS).selectExpr(
        "event_id",
        "ts",
        "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
        # each driver user becomes one heavy and seven light shoppers
        "user_id * 8 + least(event_id % 13, 7) AS uid",
    )
    part = read_table(spark, sf_dir, "part", PART_COLUMNS)
    joined = ev.join(part, F.col("p_partkey") == F.col("k"), "inner")
    # copy 0 is the original delivery, copy 1 the replay of every tenth event
    quantity = (
        "CASE WHEN event_type NOT IN ('click', 'purchase') THEN NULL "
        "WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 0 "
        "ELSE CAST(event_id % 3 + 1 AS INT) END"
    )
    return joined.selectExpr(
        "*", "explode(IF(event_id % 10 = 0, array(0, 1), array(0))) AS copy_no"
    ).selectExpr(
        "concat('EVT_', CAST(event_id AS STRING)) AS event_id",
        "ts AS event_timestamp",
        "concat('USER_', CAST(uid AS STRING)) AS user_id",
        "concat('SESSION_', CAST(uid AS STRING), '_', CAST(CAST(ts AS DATE) AS STRING)) AS session_id",
        f"{_type_map('event_type')} AS event_type",
        "concat('P', CAST(k AS STRING)) AS product_id",
        "p_name AS product_name",
        "p_type AS product_category",
        f"CAST(CAST(k AS DECIMAL(10,2)) + CAST('{PRICE_OFFSET}' AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS product_price",
        f"CAST(({quantity}) + copy_no AS INT) AS quantity",
        "concat('https://shop.example.com/product/P', CAST(k AS STRING)) AS page_url",
        "'https://google.com' AS referrer_url",
        f"{_pick(DEVICES, 'event_id % 3')} AS device_type",
        f"{_pick(BROWSERS, 'event_id % 4')} AS browser",
        f"{_pick(COUNTRIES, 'uid % 5')} AS country",
        "concat('City_', CAST(uid % 20 AS STRING)) AS city",
        f"ts + make_dt_interval(0, 0, 0, {INGEST_DELAY_SECONDS} + copy_no * {REPLAY_DELAY_SECONDS}) AS ingestion_timestamp",
    )
