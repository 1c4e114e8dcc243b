"""Registered queries: a Spark builder and the matching oracle SQL per name.

Every builder reads the driver tables of one scale directory, derives the
bronze clickstream, and runs the model chain on the whole input.  Outputs are
made comparable across engines as the last step: DECIMAL becomes DOUBLE and
small integers become BIGINT (``canonical``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..operators import dedup
from ..operators.checks import ACCEPTED_VALUES, EXPRESSION_IS_TRUE, NOT_NULL, UNIQUE, UNIQUE_COMBINATION
from ..schema import DEFAULT_AS_OF, WIRE_COLUMNS
from ..session import materialise, shared_dir
from ..sources import compaction, events_json
from ..sources.bronze import bronze_scan, read_bronze
from ..sources.clickstream import clickstream
from ..streaming import landed
from . import audience, bucketed, gold, quality, reports, silver


def canonical(df: DataFrame) -> DataFrame:
    """DECIMAL -> DOUBLE, INT/SMALLINT/TINYINT -> BIGINT (comparison types),
    as one projection (or none when every column already has its type)."""
    exprs, changed = [], False
    for f in df.schema.fields:
        target = None
        if isinstance(f.dataType, T.DecimalType):
            target = "DOUBLE"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            target = "BIGINT"
        name = f"`{f.name}`"
        exprs.append(f"CAST({name} AS {target}) AS {name}" if target else name)
        changed = changed or target is not None
    return df.selectExpr(*exprs) if changed else df


@dataclass
class Models:
    """Lazily built model DataFrames for one scale directory."""

    spark: SparkSession
    sf_dir: str
    as_of: str = DEFAULT_AS_OF
    # queries that read several marts materialise silver once, as the
    # refresh job does, instead of re-deriving it in every branch
    materialize_silver: bool = False

    @cached_property
    def bronze(self) -> DataFrame:
        return clickstream(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> DataFrame:
        stg = silver.stg_clickstream_events(self.bronze, self.as_of)
        return materialise(stg, "stg") if self.materialize_silver else stg

    @cached_property
    def sessions(self) -> DataFrame:
        sessions = silver.int_user_sessions(self.stg, self.as_of)
        return materialise(sessions, "sessions") if self.materialize_silver else sessions

    @cached_property
    def users_frame(self) -> DataFrame:
        return gold.user_behavior_frame(self.sessions, self.as_of)

    @cached_property
    def users_table(self) -> DataFrame:
        """The user frame materialised once (input of the RFM tiles)."""
        return materialise(self.users_frame, "users")

    @cached_property
    def daily(self) -> DataFrame:
        return gold.mart_daily_metrics(self.stg, self.sessions, self.as_of, sort=False)

    @cached_property
    def funnel(self) -> DataFrame:
        return gold.mart_conversion_funnel(self.sessions, sort=False)

    @cached_property
    def products(self) -> DataFrame:
        return gold.mart_product_performance(self.stg, self.as_of, sort=False)

    @cached_property
    def users(self) -> DataFrame:
        return gold.mart_user_behavior(self.sessions, self.as_of, sort=False)

    def by_model(self, names: set[str]) -> dict[str, DataFrame]:
        """The named models; the others are not built."""
        own = {
            quality.BRONZE: "bronze",
            quality.STG: "stg",
            quality.DAILY: "daily",
            quality.FUNNEL: "funnel",
            quality.PRODUCTS: "products",
            quality.USERS: "users",
        }
        return {name: getattr(self, attribute) for name, attribute in own.items() if name in names}


@dataclass(frozen=True)
class Query:
    build: Callable[[Models], DataFrame]
    sql: str | None
    many_models: bool = False


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None, many_models: bool = False):
    def deco(fn: Callable[[Models], DataFrame]):
        QUERIES[name] = Query(fn, sql, many_models)
        return fn

    return deco


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = QUERIES[name]
    return canonical(q.build(Models(spark, sf_dir, materialize_silver=q.many_models)))


# ---------------------------------------------------------------------------
# sources and ingest
# ---------------------------------------------------------------------------
REPAIRED_Q = (
    "CASE WHEN event_type IN ('add_to_cart', 'purchase') AND (quantity IS NULL OR quantity <= 0) "
    "THEN 1 ELSE quantity END"
)


def _wire_out(quantity: str = "quantity") -> str:
    typed = {"product_price": "CAST(product_price AS DOUBLE) AS product_price", "quantity": f"CAST({quantity} AS BIGINT) AS quantity"}
    return ", ".join(typed.get(c, c) for c in WIRE_COLUMNS)


WIRE_OUT = _wire_out()


@register("bronze_scan", O.with_ctes(["bronze"], f"SELECT {O.BRONZE_OUT} FROM bronze"))
def _bronze_scan(m: Models) -> DataFrame:
    return bronze_scan(m.bronze)


@register("bronze_parse_json", O.with_ctes(["bronze"], f"SELECT {WIRE_OUT} FROM bronze"))
def _bronze_parse_json(m: Models) -> DataFrame:
    good, _ = events_json.parse_events(events_json.to_wire_json(m.bronze))
    return good


@register(
    "bronze_repair_quantity",
    O.with_ctes(["bronze"], f"SELECT {O.bronze_out(REPAIRED_Q)} FROM bronze"),
)
def _bronze_repair_quantity(m: Models) -> DataFrame:
    return events_json.repair_quantity(m.bronze)


@register(
    "bronze_ingest",
    O.with_ctes(
        ["bronze"],
        f"SELECT {_wire_out(REPAIRED_Q)}, {O.AS_OF} AS ingestion_timestamp FROM bronze",
    ),
)
def _bronze_ingest(m: Models) -> DataFrame:
    rows, _ = events_json.ingest(events_json.to_wire_json(m.bronze), as_of=m.as_of)
    return rows


# ---------------------------------------------------------------------------
# dedup
# ---------------------------------------------------------------------------
@register("dedup_keep_first", O.with_ctes(["dedup_first"], f"SELECT {O.BRONZE_OUT} FROM dedup_first"))
def _dedup_keep_first(m: Models) -> DataFrame:
    return dedup.dedup_keep_first(m.bronze)


@register("dedup_keep_last", O.with_ctes(["dedup_last"], f"SELECT {O.BRONZE_OUT} FROM dedup_last"))
def _dedup_keep_last(m: Models) -> DataFrame:
    return dedup.dedup_keep_last(m.bronze)


@register(
    "duplicate_event_ids",
    O.with_ctes(
        ["bronze"],
        "SELECT event_id, CAST(COUNT(*) AS BIGINT) AS copies FROM bronze GROUP BY event_id HAVING COUNT(*) > 1",
    ),
)
def _duplicate_event_ids(m: Models) -> DataFrame:
    return dedup.duplicate_event_ids(m.bronze)


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
STG_OUT = O.BRONZE_OUT + (
    ", event_date, event_hour, day_of_week, day_name, CAST(revenue AS DOUBLE) AS revenue, "
    "has_missing_quantity, dbt_updated_at"
)


@register("stg_clickstream_events", O.with_ctes(["stg"], f"SELECT {STG_OUT} FROM stg"))
def _stg(m: Models) -> DataFrame:
    return m.stg


@register(
    "event_calendar",
    O.with_ctes(["stg"], "SELECT event_id, event_timestamp, event_date, event_hour, day_of_week, day_name FROM stg"),
)
def _event_calendar(m: Models) -> DataFrame:
    return m.stg.select("event_id", "event_timestamp", "event_date", "event_hour", "day_of_week", "day_name")


@register(
    "missing_quantity_by_type",
    O.with_ctes(
        ["stg"],
        "SELECT event_type, CAST(COUNT(*) AS BIGINT) AS events, "
        "CAST(COUNT(*) FILTER (WHERE has_missing_quantity) AS BIGINT) AS missing_quantity "
        "FROM stg GROUP BY event_type",
    ),
)
def _missing_quantity(m: Models) -> DataFrame:
    return m.stg.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("has_missing_quantity").alias("missing_quantity")
    )


SESSION_OUT = (
    "session_id, user_id, session_start, session_end, session_duration_seconds, "
    "CAST(total_events AS BIGINT) AS total_events, CAST(unique_event_types AS BIGINT) AS unique_event_types, "
    "CAST(page_views AS BIGINT) AS page_views, CAST(add_to_carts AS BIGINT) AS add_to_carts, "
    "CAST(purchases AS BIGINT) AS purchases, primary_device, primary_browser, country, "
    "CAST(session_revenue AS DOUBLE) AS session_revenue, converted, added_to_cart, cart_abandoned, dbt_updated_at"
)


@register("int_user_sessions", O.with_ctes(["sessions"], f"SELECT {SESSION_OUT} FROM sessions"))
def _sessions(m: Models) -> DataFrame:
    return m.sessions


@register(
    "session_modes",
    O.with_ctes(["sessions"], "SELECT session_id, user_id, primary_device, primary_browser, country FROM sessions"),
)
def _session_modes(m: Models) -> DataFrame:
    return silver.session_aggregates(m.stg).select(
        "session_id", "user_id", "primary_device", "primary_browser", "country"
    )


@register(
    "session_durations",
    O.with_ctes(
        ["sessions"],
        "SELECT session_id, user_id, session_start, session_end, session_duration_seconds FROM sessions",
    ),
)
def _session_durations(m: Models) -> DataFrame:
    return m.sessions.select("session_id", "user_id", "session_start", "session_end", "session_duration_seconds")


# ---------------------------------------------------------------------------
# gold: daily, funnel
# ---------------------------------------------------------------------------
@register(
    "daily_event_metrics",
    O.with_ctes(
        ["day_event_totals"],
        "SELECT event_date, CAST(total_events AS BIGINT) AS total_events, CAST(unique_users AS BIGINT) AS unique_users, "
        "CAST(total_sessions AS BIGINT) AS total_sessions, CAST(page_views AS BIGINT) AS page_views, "
        "CAST(add_to_carts AS BIGINT) AS add_to_carts, CAST(purchases AS BIGINT) AS purchases, "
        "CAST(total_revenue AS DOUBLE) AS total_revenue, avg_order_value, "
        "CAST(products_sold AS BIGINT) AS products_sold, CAST(units_sold AS BIGINT) AS units_sold FROM day_event_totals",
    ),
)
def _daily_events(m: Models) -> DataFrame:
    return gold.daily_event_metrics(m.stg)


@register(
    "session_daily_metrics",
    O.with_ctes(
        ["daily_sessions"],
        "SELECT event_date, CAST(converted_sessions AS BIGINT) AS converted_sessions, "
        "CAST(abandoned_carts AS BIGINT) AS abandoned_carts, avg_session_duration_seconds FROM daily_sessions",
    ),
)
def _daily_sessions(m: Models) -> DataFrame:
    return gold.session_daily_metrics(m.sessions)


RATE_COLS = [
    "cart_rate",
    "checkout_rate",
    "overall_conversion_rate",
    "cart_abandonment_rate",
    "revenue_per_user",
    "avg_pages_per_user",
]


@register("daily_rates", O.with_ctes(["daily"], f"SELECT event_date, {', '.join(RATE_COLS)} FROM daily"))
def _daily_rates(m: Models) -> DataFrame:
    return m.daily.select("event_date", *RATE_COLS)


@register("mart_daily_metrics", O.with_ctes(["daily"], "SELECT * FROM daily ORDER BY event_date DESC"))
def _mart_daily(m: Models) -> DataFrame:
    return gold.mart_daily_metrics(m.stg, m.sessions, m.as_of)


@register("mart_conversion_funnel", O.with_ctes(["funnel"], "SELECT * FROM funnel ORDER BY stage_order"))
def _mart_funnel(m: Models) -> DataFrame:
    return gold.mart_conversion_funnel(m.sessions)


# ---------------------------------------------------------------------------
# gold: products
# ---------------------------------------------------------------------------
PRODUCT_KEY_SQL = "product_id, product_name, product_category, product_price"


@register("mart_product_performance", O.with_ctes(["products"], "SELECT * FROM products ORDER BY total_revenue DESC"))
def _mart_products(m: Models) -> DataFrame:
    return gold.mart_product_performance(m.stg, m.as_of)


@register(
    "product_revenue_rank",
    O.with_ctes(["products"], f"SELECT {PRODUCT_KEY_SQL}, total_revenue, revenue_rank FROM products"),
)
def _product_revenue_rank(m: Models) -> DataFrame:
    return gold.product_revenue_rank(materialise(gold.product_metrics(m.stg), "products"))


@register(
    "product_units_rank",
    O.with_ctes(["products"], f"SELECT {PRODUCT_KEY_SQL}, units_sold, units_rank FROM products"),
)
def _product_units_rank(m: Models) -> DataFrame:
    return gold.product_units_rank(materialise(gold.product_metrics(m.stg), "products"))


@register(
    "top_products",
    O.with_ctes(
        ["products"],
        f"SELECT * FROM products ORDER BY total_revenue DESC NULLS FIRST, product_id ASC NULLS LAST, "
        f"product_name ASC NULLS LAST, product_category ASC NULLS LAST, product_price ASC NULLS LAST LIMIT 10",
    ),
)
def _top_products(m: Models) -> DataFrame:
    return gold.top_products(m.products, 10)


# ---------------------------------------------------------------------------
# gold: users
# ---------------------------------------------------------------------------
USER_AGG_COLS = (
    "user_id, total_sessions, first_session_date, last_session_date, days_active, total_events, "
    "total_page_views, total_add_to_carts, total_purchases, lifetime_revenue, avg_revenue_per_session, "
    "highest_order_value, avg_session_duration_seconds, avg_events_per_session, converted_sessions, "
    "abandoned_sessions, preferred_device, preferred_browser, country"
)
USER_AGG_OUT = USER_AGG_COLS.replace(
    "lifetime_revenue,", "CAST(lifetime_revenue AS DOUBLE) AS lifetime_revenue,"
).replace("highest_order_value,", "CAST(highest_order_value AS DOUBLE) AS highest_order_value,")


@register("bucketed_user_aggregates", O.with_ctes(["users_base"], f"SELECT {USER_AGG_OUT} FROM users_base"), many_models=True)
def _bucketed_user_aggregates(m: Models) -> DataFrame:
    """The user aggregates from staged events in buckets of the user."""
    own = uuid.uuid4().hex
    return bucketed.write(m.stg, f"{shared_dir(m.spark)}/bucketed-{own}", f"stg_{own}").users(m.as_of)


@register("user_aggregates", O.with_ctes(["users_base"], f"SELECT {USER_AGG_OUT} FROM users_base"))
def _user_aggregates(m: Models) -> DataFrame:
    return gold.user_aggregates(m.sessions)


@register(
    "user_activity_days",
    O.with_ctes(
        ["users_base"],
        "SELECT user_id, first_session_date, last_session_date, days_active, days_since_last_session FROM users_base",
    ),
)
def _user_activity_days(m: Models) -> DataFrame:
    return m.users_frame.select(
        "user_id", "first_session_date", "last_session_date", "days_active", "days_since_last_session"
    )


def _user_cols(name: str, cols: str, src: str = "users_enriched") -> None:
    names = [c.strip() for c in cols.split(",")]
    sql_cols = ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c in ("lifetime_revenue", "highest_order_value") else c for c in names
    )

    @register(name, O.with_ctes([src], f"SELECT {sql_cols} FROM {src}"))
    def _q(m: Models) -> DataFrame:
        return m.users_frame.select(*names)


_user_cols("frequency_segments", "user_id, total_sessions, frequency_segment")
_user_cols("monetary_segments", "user_id, lifetime_revenue, monetary_segment")
_user_cols("recency_segments", "user_id, days_since_last_session, recency_segment")
_user_cols("engagement_levels", "user_id, avg_events_per_session, engagement_level")
_user_cols(
    "lifecycle_stages",
    "user_id, total_purchases, abandoned_sessions, total_page_views, days_since_last_session, lifecycle_stage",
)
_user_cols("propensity_scores", "user_id, purchase_propensity_score")
_user_cols("avg_order_values", "user_id, user_conversion_rate, user_abandonment_rate, avg_order_value")


@register("rfm_scores", O.with_ctes(["rfm"], "SELECT * FROM rfm"))
def _rfm(m: Models) -> DataFrame:
    return gold.rfm_scores(m.users_table)


@register("rfm_scores_documented", O.with_ctes(["rfm_documented"], "SELECT * FROM rfm_documented"))
def _rfm_doc(m: Models) -> DataFrame:
    return gold.rfm_scores(m.users_table, gold.RECENCY_DOCUMENTED)


@register(
    "customer_tiers",
    O.with_ctes(["users"], "SELECT user_id, rfm_segment, customer_score, customer_tier FROM users"),
)
def _customer_tiers(m: Models) -> DataFrame:
    return m.users.select("user_id", "rfm_segment", "customer_score", "customer_tier")


@register(
    "mart_user_behavior",
    O.with_ctes(["users"], "SELECT * FROM users ORDER BY customer_score DESC, lifetime_revenue DESC"),
)
def _mart_users(m: Models) -> DataFrame:
    return gold.mart_user_behavior(m.sessions, m.as_of)


@register(
    "mart_user_behavior_documented",
    O.with_ctes(["users_documented"], "SELECT * FROM users_documented"),
)
def _mart_users_doc(m: Models) -> DataFrame:
    return gold.mart_user_behavior(m.sessions, m.as_of, gold.RECENCY_DOCUMENTED, sort=False)


@register(
    "hot_leads",
    O.with_ctes(
        ["users_enriched"],
        "SELECT user_id, purchase_propensity_score, abandoned_sessions, days_since_last_session, lifecycle_stage "
        "FROM users_enriched WHERE lifecycle_stage = 'Hot Lead (Recent Cart Abandonment)' "
        "ORDER BY purchase_propensity_score DESC NULLS FIRST, user_id ASC NULLS LAST",
    ),
)
def _hot_leads(m: Models) -> DataFrame:
    return gold.hot_leads(m.users_frame).select(
        "user_id", "purchase_propensity_score", "abandoned_sessions", "days_since_last_session", "lifecycle_stage"
    )


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------
@register(
    "kpi_summary",
    O.with_ctes(
        ["stg", "sessions"],
        f"""
        SELECT CAST(e.total_events AS BIGINT) AS total_events, CAST(e.page_views AS BIGINT) AS page_views,
          CAST(e.add_to_carts AS BIGINT) AS add_to_carts, CAST(e.purchases AS BIGINT) AS purchases,
          CAST(e.total_revenue AS DOUBLE) AS total_revenue, CAST(e.unique_users AS BIGINT) AS unique_users,
          CAST(e.total_sessions AS BIGINT) AS total_sessions, CAST(e.abandoned_carts AS BIGINT) AS abandoned_carts,
          {O.pct('e.purchases', 'e.page_views')} AS conversion_rate,
          {O.pct('e.add_to_carts', 'e.page_views')} AS cart_rate,
          {O.pct('e.purchases', 'e.add_to_carts')} AS checkout_rate,
          {O.pct('e.abandoned_carts', 'e.total_sessions')} AS cart_abandonment_rate,
          {O.money_ratio('e.total_revenue', 'e.purchases')} AS average_order_value,
          {O.money_ratio('e.total_revenue', 'e.unique_users')} AS revenue_per_user
        FROM (SELECT COUNT(*) AS total_events,
                     COUNT(*) FILTER (WHERE event_type = 'page_view') AS page_views,
                     COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_carts,
                     COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
                     SUM(revenue) AS total_revenue,
                     COUNT(DISTINCT user_id) AS unique_users,
                     COUNT(DISTINCT session_id) AS total_sessions,
                     (SELECT COUNT(*) FILTER (WHERE cart_abandoned) FROM sessions) AS abandoned_carts
              FROM stg) e
        """,
    ),
)
def _kpi(m: Models) -> DataFrame:
    return reports.kpi_summary(m.sessions)


@register(
    "events_per_minute",
    O.with_ctes(
        ["bronze"],
        "SELECT date_trunc('minute', event_timestamp) AS minute_start, "
        "date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS minute_end, "
        "CAST(COUNT(*) AS BIGINT) AS events FROM bronze GROUP BY 1, 2",
    ),
)
def _events_per_minute(m: Models) -> DataFrame:
    return reports.events_per_minute(m.bronze)


def _compacted(m: Models) -> str:
    """The bronze rows streamed in two batches, all days but the last compacted; the table's path."""
    path = f"{shared_dir(m.spark)}/streamed-{uuid.uuid4().hex}"
    rows = bronze_scan(m.bronze).withColumn(compaction.PARTITION_COLUMN, F.to_date("event_timestamp"))
    # a batch's writer sorts the rows of each task by day, and a split of the compact source holds many
    tasks = -(-rows.count() // compaction.ROWS_PER_FILE)
    rows = rows.repartition(max(1, tasks), F.xxhash64(*rows.columns))
    later = F.crc32(F.coalesce("event_id", F.lit(""))) % 2 == 1
    compaction.write_batch(rows.filter(~later), path, 0)
    compaction.write_batch(rows.filter(later), path, 1)
    last = rows.agg(F.max(compaction.PARTITION_COLUMN)).first()[0]
    compaction.compact(m.spark, path, last, through=1)
    return path


@register("bronze_after_compaction", O.with_ctes(["bronze"], f"SELECT {O.BRONZE_OUT} FROM bronze"))
def _bronze_after_compaction(m: Models) -> DataFrame:
    """Every bronze row once, from compacted files and batch folders."""
    return read_bronze(m.spark, _compacted(m))


@register(
    "landed_ids",
    O.with_ctes(
        ["bronze"],
        "SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date, event_id FROM bronze "
        "WHERE event_id IS NOT NULL AND CAST(event_timestamp AS DATE) < (SELECT MAX(CAST(event_timestamp AS DATE)) FROM bronze)",
    ),
)
def _landed_ids(m: Models) -> DataFrame:
    """What a replay of all events finds in the compacted days, by their id filters."""
    path = _compacted(m)
    events = bronze_scan(m.bronze).withColumn(compaction.PARTITION_COLUMN, F.to_date("event_timestamp"))
    days = landed.late_days(events, compaction.manifest_log(m.spark, path).read()[1]["days"])
    return landed.landed_ids(events, path, 2, days)


@register(
    "weekly_audience",
    O.with_ctes(
        ["stg"],
        "SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, "
        "CAST(COUNT(DISTINCT user_id) AS BIGINT) AS users, CAST(COUNT(DISTINCT session_id) AS BIGINT) AS sessions "
        "FROM stg GROUP BY 1",
    ),
)
def _weekly_audience(m: Models) -> DataFrame:
    # a row per week, written: merging bitmaps sorts rows of 4 KB, which no reader should repeat
    return materialise(audience.weekly_audience(m.stg), "weekly")


@register(
    "ingest_latency",
    O.with_ctes(
        ["bronze"],
        "SELECT CAST(event_timestamp AS DATE) AS event_date, CAST(COUNT(*) AS BIGINT) AS events, "
        "CAST(SUM(date_diff('microsecond', event_timestamp, ingestion_timestamp)) AS DOUBLE) "
        "/ NULLIF(COUNT(*), 0) / 1e6 AS avg_latency_seconds, "
        "CAST(MAX(date_diff('microsecond', event_timestamp, ingestion_timestamp)) AS DOUBLE) / 1e6 AS max_latency_seconds "
        "FROM bronze GROUP BY 1",
    ),
)
def _ingest_latency(m: Models) -> DataFrame:
    return reports.ingest_latency(m.bronze)


@register(
    "live_metrics",
    O.with_ctes(
        ["bronze"],
        f"""
        SELECT date_trunc('minute', event_timestamp) AS window_start,
          date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
          CAST(COUNT(*) AS BIGINT) AS events,
          CAST(COUNT(*) FILTER (WHERE event_type = 'page_view') AS BIGINT) AS page_views,
          CAST(COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS add_to_carts,
          CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
          {O.pct("COUNT(*) FILTER (WHERE event_type = 'purchase')", "COUNT(*) FILTER (WHERE event_type = 'page_view')")}
            AS conversion_rate
        FROM bronze GROUP BY 1, 2
        """,
    ),
)
def _live_metrics(m: Models) -> DataFrame:
    """The stream's windowed metric applied to the whole bronze table."""
    from ..streaming.live import live_metrics

    return live_metrics(m.bronze, "1 minute")


# ---------------------------------------------------------------------------
# checks
# ---------------------------------------------------------------------------
_CHECK_SRC = {
    quality.BRONZE: "bronze",
    quality.STG: "stg",
    quality.DAILY: "daily",
    quality.FUNNEL: "funnel",
    quality.PRODUCTS: "products",
    quality.USERS: "users",
}


def _check_sql(c) -> str:
    src = _CHECK_SRC[c.model]
    head = f"SELECT '{c.kind}' AS test_name, '{c.model}' AS model, '{c.column_name}' AS column_name, "
    col = c.columns[0]
    if c.kind == NOT_NULL:
        return head + f"CAST(COUNT(*) AS BIGINT) AS failures FROM {src} WHERE {col} IS NULL"
    if c.kind == EXPRESSION_IS_TRUE:
        return head + f"CAST(COUNT(*) AS BIGINT) AS failures FROM {src} WHERE NOT ({col} {c.arg})"
    if c.kind == UNIQUE:
        inner = f"SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1"
    elif c.kind == ACCEPTED_VALUES:
        vals = ", ".join(f"'{v}'" for v in c.arg)
        inner = f"SELECT {col} FROM {src} GROUP BY {col} HAVING {col} NOT IN ({vals})"
    elif c.kind == UNIQUE_COMBINATION:
        cols = ", ".join(c.columns)
        inner = f"SELECT {cols} FROM {src} GROUP BY {cols} HAVING COUNT(*) > 1"
    else:
        raise ValueError(c.kind)
    return head + f"CAST(COUNT(*) AS BIGINT) AS failures FROM ({inner}) v"


def _register_checks(name: str, kinds: list[str] | None) -> None:
    checks = quality.checks_of(kinds)
    deps = sorted({_CHECK_SRC[c.model] for c in checks})
    sql = O.with_ctes(deps, "\nUNION ALL\n".join(_check_sql(c) for c in checks))

    many = len({c.model for c in checks}) > 1

    @register(name, sql, many_models=many)
    def _q(m: Models) -> DataFrame:
        return quality.check_summary(m.by_model({c.model for c in checks}), checks)


_register_checks("check_not_null", [NOT_NULL])
_register_checks("check_unique", [UNIQUE])
_register_checks("check_accepted_values", [ACCEPTED_VALUES])
_register_checks("check_expression", [EXPRESSION_IS_TRUE])
_register_checks("check_unique_combination", [UNIQUE_COMBINATION])
_register_checks("check_summary", None)
