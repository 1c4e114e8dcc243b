"""Gold marts: daily KPIs, conversion funnel, product performance, user behaviour.

Each mart is a function of its upstream DataFrames (the lineage edge of a
model reference) and returns a lazy DataFrame; ``plans.refresh`` writes them.
Every aggregate here supports partial (map-side) aggregation, so a hot day,
product or user costs one row per map task before the shuffle.  The ranks and
tiles run through ``operators.ranking`` instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pg
from ..functions import segments as seg
from ..operators.ranking import asc, desc, global_rank, with_ntiles, with_ranks
from ..session import materialise
from ..schema import ADD_TO_CART, FUNNEL_STAGES, HOT_LEAD, NTILE_BUCKETS, PAGE_VIEW, PURCHASE

SECONDS_EXACT = "decimal(38,6)"  # seconds carry microseconds: exact as decimal


# --------------------------------------------------------------------------
# daily KPIs
# --------------------------------------------------------------------------
def daily_event_metrics(stg: DataFrame) -> DataFrame:
    """One row per event day.

    The events are first summed per day, user and session, which partial
    aggregation does inside the map tasks; the distinct counts expand those
    rows only.  Sold products are counted apart, from the purchases.
    """
    etype = F.col("event_type")
    rev = F.col("revenue")
    visits = stg.groupBy("event_date", "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("events"),
        pg.count_where(etype == PAGE_VIEW).alias("views"),
        pg.count_where(etype == ADD_TO_CART).alias("carts"),
        pg.count_where(etype == PURCHASE).alias("buys"),
        F.sum(rev).alias("revenue"),
        pg.sum_where(rev > 0, rev).alias("paid"),
        F.count_if(rev > 0).alias("orders"),
        pg.sum_where(etype == PURCHASE, "quantity").alias("units"),
    )
    days = visits.groupBy("event_date").agg(
        F.sum("events").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.sum("views").alias("page_views"),
        F.sum("carts").alias("add_to_carts"),
        F.sum("buys").alias("purchases"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("paid").cast("double") / F.nullif(F.sum("orders"), F.lit(0)).cast("double")).alias("avg_order_value"),
        F.sum("units").alias("units_sold"),
    )
    sold = stg.filter(etype == PURCHASE).groupBy("event_date", "product_id").agg(F.count(F.lit(1)).alias("n"))
    sold = sold.groupBy("event_date").agg(F.count("product_id").alias("products_sold"))
    out = days.join(sold.withColumnRenamed("event_date", "_day"), F.col("event_date").eqNullSafe(F.col("_day")), "left")
    return out.select(
        "event_date",
        "total_events",
        "unique_users",
        "total_sessions",
        "page_views",
        "add_to_carts",
        "purchases",
        "total_revenue",
        "avg_order_value",
        F.coalesce("products_sold", F.lit(0)).alias("products_sold"),
        "units_sold",
    )


def session_daily_metrics(sessions: DataFrame) -> DataFrame:
    """Session outcomes by the day the session *started*."""
    return sessions.groupBy(F.to_date("session_start").alias("event_date")).agg(
        pg.count_where(F.col("converted")).alias("converted_sessions"),
        pg.count_where(F.col("cart_abandoned")).alias("abandoned_carts"),
        pg.exact_avg("session_duration_seconds", SECONDS_EXACT).alias("avg_session_duration_seconds"),
    )


def daily_rates(daily: DataFrame) -> DataFrame:
    """The rate columns of the daily mart, from the joined daily metrics."""
    return daily.select(
        "*",
        pg.pct("add_to_carts", "page_views").alias("cart_rate"),
        pg.pct("purchases", "add_to_carts").alias("checkout_rate"),
        pg.pct("purchases", "page_views").alias("overall_conversion_rate"),
        pg.pct("abandoned_carts", "total_sessions").alias("cart_abandonment_rate"),
        pg.money_ratio("total_revenue", "unique_users").alias("revenue_per_user"),
        pg.ratio("page_views", "unique_users").alias("avg_pages_per_user"),
    )


def mart_daily_metrics(stg: DataFrame, sessions: DataFrame, as_of=None, sort: bool = True) -> DataFrame:
    """One row per event day.  Days on which no session started keep NULL
    session metrics (left join).  Both sides have one row per day; Catalyst
    broadcasts the smaller one when its measured size allows."""
    e = daily_event_metrics(stg)
    s = session_daily_metrics(sessions)
    out = daily_rates(e.join(s, "event_date", "left")).withColumn("dbt_updated_at", pg.as_of_literal(as_of))
    return out.orderBy(F.col("event_date").desc_nulls_first()) if sort else out


# --------------------------------------------------------------------------
# conversion funnel
# --------------------------------------------------------------------------
def funnel_counts(sessions: DataFrame) -> DataFrame:
    """``COUNT(DISTINCT session_id) [FILTER (...)]`` four times, as one row.

    First one row per session id (a partial-aggregated shuffle on the id),
    then plain counts: the distinct counts without four Expand copies.
    """
    per_session = (
        sessions.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.max((F.col("page_views") > 0).cast("int")).alias("v"),
            F.max((F.col("add_to_carts") > 0).cast("int")).alias("c"),
            F.max((F.col("purchases") > 0).cast("int")).alias("p"),
        )
    )
    return per_session.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(F.col("v") == 1).alias("sessions_with_views"),
        F.count_if(F.col("c") == 1).alias("sessions_with_carts"),
        F.count_if(F.col("p") == 1).alias("sessions_with_purchases"),
    )


def mart_conversion_funnel(sessions: DataFrame, sort: bool = True) -> DataFrame:
    """Four stages from one aggregate row via ``stack`` (the input is read
    once, unlike four unioned selects)."""
    f = funnel_counts(sessions)
    t, v, c, p = (F.col(x) for x in ("total_sessions", "sessions_with_views", "sessions_with_carts", "sessions_with_purchases"))
    full = F.lit(100.0).cast("double")

    def stage(i, count, dropped, from_prev, from_start):
        return [
            F.lit(FUNNEL_STAGES[i]),
            F.lit(i + 1).cast("bigint"),
            count.cast("bigint"),
            dropped.cast("bigint"),
            from_prev.cast("double"),
            from_start.cast("double"),
        ]

    rows = (
        stage(0, t, F.lit(0), full, full)
        + stage(1, v, t - v, pg.pct(v, t), pg.pct(v, t))
        + stage(2, c, v - c, pg.pct(c, v), pg.pct(c, t))
        + stage(3, p, c - p, pg.pct(p, c), pg.pct(p, t))
    )
    out = f.select(
        F.stack(F.lit(4), *rows).alias(
            "funnel_stage",
            "stage_order",
            "sessions",
            "users_dropped",
            "conversion_rate_from_previous",
            "conversion_rate_from_start",
        )
    ).select(
        "funnel_stage",
        "stage_order",
        "sessions",
        F.col("sessions").alias("users_remaining"),
        "users_dropped",
        "conversion_rate_from_previous",
        "conversion_rate_from_start",
    )
    return out.orderBy("stage_order") if sort else out


# --------------------------------------------------------------------------
# product performance
# --------------------------------------------------------------------------
PRODUCT_KEYS = ["product_id", "product_name", "product_category", "product_price"]


def product_metrics(stg: DataFrame) -> DataFrame:
    """Per product version, only products with at least one purchase (HAVING)."""
    etype = F.col("event_type")
    views = pg.count_where(etype == PAGE_VIEW)
    carts = pg.count_where(etype == ADD_TO_CART)
    buys = pg.count_where(etype == PURCHASE)
    g = stg.groupBy(*PRODUCT_KEYS).agg(
        views.alias("total_views"),
        carts.alias("total_adds_to_cart"),
        buys.alias("total_purchases"),
        pg.sum_where(etype == PURCHASE, "quantity").alias("units_sold"),
        F.sum("revenue").alias("total_revenue"),
    )
    return g.filter(F.col("total_purchases") > 0).select(
        *PRODUCT_KEYS,
        "total_views",
        "total_adds_to_cart",
        "total_purchases",
        "units_sold",
        "total_revenue",
        pg.pct("total_adds_to_cart", "total_views").alias("view_to_cart_rate"),
        pg.pct("total_purchases", "total_adds_to_cart").alias("cart_to_purchase_rate"),
    )


def product_revenue_rank(products: DataFrame) -> DataFrame:
    """``RANK() OVER (ORDER BY SUM(revenue) DESC)``, NULLs first: product key,
    revenue and rank."""
    narrow = products.select(*PRODUCT_KEYS, "total_revenue")
    return global_rank(narrow, [desc("total_revenue")], "revenue_rank")


def product_units_rank(products: DataFrame) -> DataFrame:
    narrow = products.select(*PRODUCT_KEYS, "units_sold")
    return global_rank(narrow, [desc("units_sold")], "units_rank")


def with_product_ranks(products: DataFrame) -> DataFrame:
    """Both ranks, from one sort of the distinct revenues and units."""
    return with_ranks(products, [("revenue_rank", [desc("total_revenue")]), ("units_rank", [desc("units_sold")])])


def mart_product_performance(stg: DataFrame, as_of=None, sort: bool = True) -> DataFrame:
    # the ranks read the product table several times: materialise it once
    ranked = with_product_ranks(materialise(product_metrics(stg), "products"))
    out = ranked.withColumn("dbt_updated_at", pg.as_of_literal(as_of))
    # the key as last sort column: equal revenues can be cut between tasks
    keys = [F.col(c).asc_nulls_last() for c in PRODUCT_KEYS]
    return out.orderBy(F.col("total_revenue").desc_nulls_first(), *keys) if sort else out


def top_products(products_mart: DataFrame, k: int = 10) -> DataFrame:
    """Top-k products by revenue (a bounded ``TakeOrdered``), ties by key."""
    return products_mart.orderBy(
        F.col("total_revenue").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in PRODUCT_KEYS]
    ).limit(k)


# --------------------------------------------------------------------------
# user behaviour
# --------------------------------------------------------------------------
def user_aggregates(sessions: DataFrame) -> DataFrame:
    start = F.col("session_start")
    return sessions.groupBy("user_id").agg(
        # COUNT(DISTINCT session_id): the session grain is (session_id,
        # user_id), so within one user every non-NULL session id is distinct
        F.count("session_id").alias("total_sessions"),
        F.min(start).alias("first_session_date"),
        F.max(start).alias("last_session_date"),
        (pg.interval_days(F.min(start), F.max(start)) + 1).alias("days_active"),
        F.sum("total_events").alias("total_events"),
        F.sum("page_views").alias("total_page_views"),
        F.sum("add_to_carts").alias("total_add_to_carts"),
        F.sum("purchases").alias("total_purchases"),
        F.sum("session_revenue").alias("lifetime_revenue"),
        pg.exact_avg("session_revenue").alias("avg_revenue_per_session"),
        F.max("session_revenue").alias("highest_order_value"),
        pg.exact_avg("session_duration_seconds", SECONDS_EXACT).alias("avg_session_duration_seconds"),
        pg.exact_avg("total_events").alias("avg_events_per_session"),
        pg.count_where(F.col("converted")).alias("converted_sessions"),
        pg.count_where(F.col("cart_abandoned")).alias("abandoned_sessions"),
        F.mode("primary_device", deterministic=True).alias("preferred_device"),
        F.mode("primary_browser", deterministic=True).alias("preferred_browser"),
        F.mode("country", deterministic=True).alias("country"),
    )


def user_segments_base(users: DataFrame, as_of=None) -> DataFrame:
    purchases = F.col("total_purchases")
    aov = F.when(purchases > 0, pg.money_ratio("lifetime_revenue", purchases)).otherwise(F.lit(0.0))
    return users.select(
        "*",
        pg.pct("converted_sessions", "total_sessions").alias("user_conversion_rate"),
        pg.pct("abandoned_sessions", "total_sessions").alias("user_abandonment_rate"),
        aov.alias("avg_order_value"),
        pg.interval_days("last_session_date", pg.as_of_literal(as_of)).alias("days_since_last_session"),
        seg.frequency_segment().alias("frequency_segment"),
        seg.monetary_segment().alias("monetary_segment"),
    )


def user_segments(base: DataFrame) -> DataFrame:
    """Segments that use columns computed in the previous block."""
    return base.select(
        "*",
        seg.recency_segment().alias("recency_segment"),
        seg.engagement_level().alias("engagement_level"),
        seg.lifecycle_stage().alias("lifecycle_stage"),
        seg.purchase_propensity_score().alias("purchase_propensity_score"),
    )


RECENCY_AS_CODED = "as_coded"  # NTILE over days ASC: the most recent get 1
RECENCY_DOCUMENTED = "documented"  # 5 = most recent, as the README states


def rfm_orders(recency: str = RECENCY_AS_CODED):
    """The three NTILE(5) orders; ties are broken by user_id."""
    tie = asc("user_id")
    if recency == RECENCY_AS_CODED:
        r_order = [asc("days_since_last_session"), tie]
    elif recency == RECENCY_DOCUMENTED:
        r_order = [desc("days_since_last_session"), tie]
    else:
        raise ValueError(f"unknown recency order {recency!r}")
    k = NTILE_BUCKETS
    return [
        ("recency_score", k, r_order),
        ("frequency_score", k, [asc("total_sessions"), tie]),
        ("monetary_score", k, [asc("lifetime_revenue"), tie]),
    ]


def with_rfm_scores(users: DataFrame, recency: str = RECENCY_AS_CODED) -> DataFrame:
    """Append the three scores to the (unique-user) table.  The reference
    joins an NTILE result over the same rows back by user_id; here the scores
    land on the same rows, through ``ranking.with_ntiles``."""
    return with_ntiles(users, rfm_orders(recency))


def rfm_scores(users: DataFrame, recency: str = RECENCY_AS_CODED) -> DataFrame:
    """(user_id, recency_score, frequency_score, monetary_score)."""
    narrow = users.select("user_id", "days_since_last_session", "total_sessions", "lifetime_revenue")
    return with_rfm_scores(narrow, recency).select("user_id", "recency_score", "frequency_score", "monetary_score")


def with_customer_tier(scored: DataFrame) -> DataFrame:
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_segment", seg.rfm_segment()).withColumn("customer_score", score).withColumn(
        "customer_tier", seg.customer_tier()
    )


def user_behavior_frame(sessions: DataFrame, as_of=None) -> DataFrame:
    """Aggregates and all segments, before RFM scoring."""
    return user_segments(user_segments_base(user_aggregates(sessions), as_of))


def mart_user_behavior(sessions: DataFrame, as_of=None, recency: str = RECENCY_AS_CODED, sort: bool = True) -> DataFrame:
    """The reference joins the segments to an NTILE result over themselves by
    user_id; user_id is unique here, so the scores are appended in place."""
    # the three tiles read the user table several times: materialise it once
    users = materialise(user_behavior_frame(sessions, as_of), "users")
    out = with_customer_tier(with_rfm_scores(users, recency))
    out = out.withColumn("dbt_updated_at", pg.as_of_literal(as_of))
    if sort:
        # the id as last sort column: users of equal score and revenue can be cut between tasks
        by = [F.col("customer_score").desc_nulls_first(), F.col("lifetime_revenue").desc_nulls_first()]
        out = out.orderBy(*by, F.col("user_id").asc_nulls_last())
    return out


def hot_leads(users: DataFrame) -> DataFrame:
    """All recent cart abandoners, by purchase propensity."""
    by = [F.col("purchase_propensity_score").desc_nulls_first(), F.col("user_id").asc_nulls_last()]
    return users.filter(F.col("lifecycle_stage") == HOT_LEAD).orderBy(*by)
