"""The 24 checks declared on the bronze source, the staging model and the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..operators.checks import (
    ACCEPTED_VALUES,
    EXPRESSION_IS_TRUE,
    NOT_NULL,
    UNIQUE,
    UNIQUE_COMBINATION,
    Check,
    model_check_counts,
    violations,
)
from ..schema import CUSTOMER_TIERS, VALID_EVENT_TYPES

BRONZE = "clickstream_events"
STG = "stg_clickstream_events"
DAILY = "mart_daily_metrics"
FUNNEL = "mart_conversion_funnel"
PRODUCTS = "mart_product_performance"
USERS = "mart_user_behavior"

# --- fixed values: the declared checks --------------------------------------
SUITE: list[Check] = [
    Check(UNIQUE, BRONZE, ("event_id",)),
    Check(NOT_NULL, BRONZE, ("event_id",)),
    Check(NOT_NULL, BRONZE, ("event_timestamp",)),
    Check(NOT_NULL, BRONZE, ("user_id",)),
    Check(ACCEPTED_VALUES, BRONZE, ("event_type",), tuple(VALID_EVENT_TYPES)),
    Check(UNIQUE, STG, ("event_id",)),
    Check(NOT_NULL, STG, ("event_id",)),
    Check(EXPRESSION_IS_TRUE, STG, ("revenue",), ">= 0"),
    Check(UNIQUE, DAILY, ("event_date",)),
    Check(NOT_NULL, DAILY, ("event_date",)),
    Check(EXPRESSION_IS_TRUE, DAILY, ("total_revenue",), ">= 0"),
    Check(EXPRESSION_IS_TRUE, DAILY, ("overall_conversion_rate",), "between 0 and 100"),
    Check(UNIQUE_COMBINATION, FUNNEL, ("funnel_stage", "stage_order")),
    Check(UNIQUE, PRODUCTS, ("product_id",)),
    Check(NOT_NULL, PRODUCTS, ("product_id",)),
    Check(EXPRESSION_IS_TRUE, PRODUCTS, ("total_revenue",), "> 0"),
    Check(UNIQUE, USERS, ("user_id",)),
    Check(NOT_NULL, USERS, ("user_id",)),
    Check(NOT_NULL, USERS, ("total_sessions",)),
    Check(EXPRESSION_IS_TRUE, USERS, ("total_sessions",), "> 0"),
    Check(EXPRESSION_IS_TRUE, USERS, ("lifetime_revenue",), ">= 0"),
    Check(EXPRESSION_IS_TRUE, USERS, ("customer_score",), "between 3 and 15"),
    Check(EXPRESSION_IS_TRUE, USERS, ("purchase_propensity_score",), "between 0 and 100"),
    Check(ACCEPTED_VALUES, USERS, ("customer_tier",), tuple(CUSTOMER_TIERS)),
]
# --- end of fixed values ------------------------------------------------------


def checks_of(kinds: list[str] | None = None, models: list[str] | None = None) -> list[Check]:
    return [c for c in SUITE if (kinds is None or c.kind in kinds) and (models is None or c.model in models)]


def check_summary(models: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """(test_name, model, column_name, failures) for each check.

    All checks of one model share one scan and one shuffle
    (``operators.checks.model_check_counts``); the parts are one row per
    check.
    """
    checks = SUITE if checks is None else checks
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        mine = [c for c in checks if c.model == model]
        parts.append(model_check_counts(models[model], mine))
    return reduce(DataFrame.unionByName, parts)


def failing_rows(models: dict[str, DataFrame], checks: list[Check] | None = None) -> dict[str, DataFrame]:
    """Violations of every check, by check name (stored on failure)."""
    checks = SUITE if checks is None else checks
    return {c.name: violations(models[c.model], c) for c in checks}


def store_failures(models: dict[str, DataFrame], out_dir: str, checks: list[Check] | None = None) -> dict[str, int]:
    """Write the violations of each check under ``out_dir/<check name>``
    (overwrite) and return the failure counts.

    All checks of a model are counted in one pass; only a failing check reads
    the model again, for its rows.  A passing one writes an empty table.
    """
    checks = SUITE if checks is None else checks
    found = {(r.test_name, r.model, r.column_name): r.failures for r in check_summary(models, checks).collect()}
    counts = {c.name: found[c.kind, c.model, c.column_name] for c in checks}
    for name, rows in failing_rows(models, checks).items():
        (rows if counts[name] else rows.limit(0)).write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return counts
