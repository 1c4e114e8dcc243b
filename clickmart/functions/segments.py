"""Ordered CASE chains of the user mart: segments, lifecycle, tiers, scores.

Each function takes column names (or columns) and returns one expression, so
the chains run inside whole-stage codegen.  Branch order matters and follows
the models: the first matching threshold wins, and a NULL input falls through
to the last branch (SQL ``CASE`` treats an unknown comparison as false).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    ACTIVE_MAX_DAYS,
    CUSTOMER_TIERS,
    ENGAGEMENT_LEVELS,
    ENGAGEMENT_MIN_EVENTS,
    FREQUENCY_MIN_SESSIONS,
    FREQUENCY_SEGMENTS,
    LIFECYCLE_STAGES,
    LOYAL_MIN_PURCHASES,
    MONETARY_MIN_REVENUE,
    MONETARY_SEGMENTS,
    PROPENSITY_CAP,
    PROPENSITY_RECENT_BONUS,
    PROPENSITY_WEIGHTS,
    RECENCY_MAX_DAYS,
    RECENCY_SEGMENTS,
    RECENT_MAX_DAYS,
    TIER_MIN_SCORE,
)
from .pg import col


def _chain(branches: list[tuple[Column, str]], otherwise: str) -> Column:
    expr = None
    for cond, label in branches:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def _at_least(x: Column, limits: list, labels: list[str]) -> Column:
    return _chain([(x >= lim, lab) for lim, lab in zip(limits, labels)], labels[-1])


def frequency_segment(total_sessions="total_sessions") -> Column:
    return _at_least(col(total_sessions), FREQUENCY_MIN_SESSIONS, FREQUENCY_SEGMENTS)


def monetary_segment(lifetime_revenue="lifetime_revenue") -> Column:
    r = col(lifetime_revenue)
    branches = [(r >= lim, lab) for lim, lab in zip(MONETARY_MIN_REVENUE, MONETARY_SEGMENTS)]
    micro, non_buyer = MONETARY_SEGMENTS[-2:]
    return _chain(branches + [(r > 0, micro)], non_buyer)


def recency_segment(days="days_since_last_session") -> Column:
    d = col(days)
    branches = [(d <= lim, lab) for lim, lab in zip(RECENCY_MAX_DAYS, RECENCY_SEGMENTS)]
    return _chain(branches, RECENCY_SEGMENTS[-1])


def engagement_level(avg_events="avg_events_per_session") -> Column:
    return _at_least(col(avg_events), ENGAGEMENT_MIN_EVENTS, ENGAGEMENT_LEVELS)


def lifecycle_stage(
    purchases="total_purchases",
    abandoned="abandoned_sessions",
    page_views="total_page_views",
    days="days_since_last_session",
) -> Column:
    p, ab, pv, d = col(purchases), col(abandoned), col(page_views), col(days)
    loyal, active, churned, hot, cold, browser, inactive = LIFECYCLE_STAGES
    return _chain(
        [
            ((p >= LOYAL_MIN_PURCHASES) & (d <= ACTIVE_MAX_DAYS), loyal),
            ((p >= 1) & (d <= ACTIVE_MAX_DAYS), active),
            ((p >= 1) & (d > ACTIVE_MAX_DAYS), churned),
            ((ab > 0) & (d <= RECENT_MAX_DAYS), hot),
            ((ab > 0) & (d > RECENT_MAX_DAYS), cold),
            ((pv > 0) & (d <= RECENT_MAX_DAYS), browser),
        ],
        inactive,
    )


def purchase_propensity_score(
    page_views="total_page_views",
    carts="total_add_to_carts",
    purchases="total_purchases",
    days="days_since_last_session",
) -> Column:
    """``LEAST(100, ROUND(views*1 + carts*5 + purchases*20 + recent bonus, 0))``.

    All terms are integer counts, so the sum is exact in BIGINT and the
    rounding is the identity.
    """
    w = PROPENSITY_WEIGHTS
    bonus = F.when(col(days) <= RECENT_MAX_DAYS, F.lit(PROPENSITY_RECENT_BONUS)).otherwise(F.lit(0))
    raw = col(page_views) * w["page_view"] + col(carts) * w["add_to_cart"] + col(purchases) * w["purchase"] + bonus
    return F.least(F.lit(PROPENSITY_CAP).cast("bigint"), raw.cast("bigint"))


def customer_tier(score="customer_score") -> Column:
    return _at_least(col(score), TIER_MIN_SCORE, CUSTOMER_TIERS)


def rfm_segment(r="recency_score", f="frequency_score", m="monetary_score") -> Column:
    """``CONCAT(r, '-', f, '-', m)``; PostgreSQL's CONCAT skips NULLs."""
    parts = [F.coalesce(col(x).cast("string"), F.lit("")) for x in (r, f, m)]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])
