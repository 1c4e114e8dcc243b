"""Event schemas and the fixed vocabularies of the clickstream models."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire form of one event: 16 fields, one JSON object per message.  The
# nullability flags document the contract; ``from_json`` does not enforce
# them, so ``sources.events_json.parse_events`` routes rows that break them to
# a rejects output instead.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_timestamp", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("session_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("product_category", T.StringType(), True),
        T.StructField("product_price", T.DecimalType(10, 2), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("page_url", T.StringType(), True),
        T.StructField("referrer_url", T.StringType(), True),
        T.StructField("device_type", T.StringType(), True),
        T.StructField("browser", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
    ]
)

# Bronze table: the wire fields with a typed timestamp plus the ingestion
# stamp.  Timestamps are zone-less, as in the bronze DDL.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType(), f.nullable)
        if f.name == "event_timestamp"
        else f
        for f in WIRE_SCHEMA.fields
    ]
    + [T.StructField("ingestion_timestamp", T.TimestampNTZType(), True)]
)

BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]
WIRE_COLUMNS = [f.name for f in WIRE_SCHEMA.fields]
REQUIRED_COLUMNS = [f.name for f in WIRE_SCHEMA.fields if not f.nullable]

# --- fixed values (must equal the reference models) -------------------------
PAGE_VIEW = "page_view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
VALID_EVENT_TYPES = ["page_view", "add_to_cart", "purchase"]
QUANTITY_EVENT_TYPES = ["add_to_cart", "purchase"]

FREQUENCY_SEGMENTS = [
    "Power User (10+ sessions)",
    "Regular User (5-9 sessions)",
    "Casual User (2-4 sessions)",
    "One-Time Visitor (1 session)",
]
MONETARY_SEGMENTS = [
    "High Value (₦825k+)",
    "Medium Value (₦330k-₦825k)",
    "Low Value (₦82.5k-₦330k)",
    "Micro Value (<₦82.5k)",
    "Non-Buyer",
]
RECENCY_SEGMENTS = [
    "Active (Today/Yesterday)",
    "Recent (This Week)",
    "Warm (This Month)",
    "Cold (30+ days ago)",
]
ENGAGEMENT_LEVELS = [
    "Highly Engaged",
    "Moderately Engaged",
    "Low Engagement",
    "Very Low Engagement",
]
LIFECYCLE_STAGES = [
    "Loyal Customer",
    "Active Buyer",
    "Churned Buyer",
    "Hot Lead (Recent Cart Abandonment)",
    "Cold Lead",
    "Active Browser",
    "Inactive",
]
CUSTOMER_TIERS = ["Champion", "Loyal", "Potential", "At Risk", "Lost"]
FUNNEL_STAGES = [
    "Stage 1: Visited Site",
    "Stage 2: Viewed Products",
    "Stage 3: Added to Cart",
    "Stage 4: Completed Purchase",
]

# thresholds, highest first, each paired with the label list above
FREQUENCY_MIN_SESSIONS = [10, 5, 2]  # >= ; else the last label
MONETARY_MIN_REVENUE = [500, 200, 50]  # >= ; then > 0 ; else "Non-Buyer"
RECENCY_MAX_DAYS = [1, 7, 30]  # <= ; else the last label (also NULL)
ENGAGEMENT_MIN_EVENTS = [10, 5, 2]  # >= average events per session
TIER_MIN_SCORE = [13, 10, 7, 5]  # >= recency + frequency + monetary score
LOYAL_MIN_PURCHASES = 3
ACTIVE_MAX_DAYS = 30  # lifecycle: buyers active within 30 days
RECENT_MAX_DAYS = 7  # lifecycle leads/browsers and the propensity bonus
PROPENSITY_WEIGHTS = {"page_view": 1, "add_to_cart": 5, "purchase": 20}
PROPENSITY_RECENT_BONUS = 10
PROPENSITY_CAP = 100
NTILE_BUCKETS = 5
# --- end of fixed values -----------------------------------------------------

HOT_LEAD = LIFECYCLE_STAGES[3]

# Reference time used by every registered query, so results are reproducible.
DEFAULT_AS_OF = "2024-02-06 00:00:00"
