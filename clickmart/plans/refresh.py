"""Refresh job: rebuild silver and everything downstream, then check it.

All tables of a run are written into a new version (``plans.snapshots``): the silver models once,
so that every mart starts from materialised rows (a lost executor re-reads files instead of
recomputing the event lineage), then the marts, then the failing rows of each check.  One commit
makes them visible together; a run that fails changes nothing for readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import gold, quality, silver
from .snapshots import Rebuild, Snapshots

SESSIONS = "int_user_sessions"
SILVER, GOLD, RESULTS = "silver", "gold", "test_results"


def build(new: Rebuild, bronze: DataFrame, as_of=None, run_checks: bool = True) -> None:
    """Write silver, the four marts and the checks' failing rows into a new version."""
    stg = new.write(f"{SILVER}/{quality.STG}", silver.stg_clickstream_events(bronze, as_of))
    sessions = new.write(f"{SILVER}/{SESSIONS}", silver.int_user_sessions(stg, as_of))
    marts = {
        quality.DAILY: lambda: gold.mart_daily_metrics(stg, sessions, as_of),
        quality.FUNNEL: lambda: gold.mart_conversion_funnel(sessions),
        quality.PRODUCTS: lambda: gold.mart_product_performance(stg, as_of),
        quality.USERS: lambda: gold.mart_user_behavior(sessions, as_of),
    }
    written = {name: new.write(f"{GOLD}/{name}", mart()) for name, mart in marts.items()}
    if run_checks:
        models = {quality.BRONZE: bronze, quality.STG: stg, **written}
        new.notes["failures"] = quality.store_failures(models, new.folder(RESULTS))
        for name, rows in quality.failing_rows(models).items():
            new.add(f"{RESULTS}/{name}", rows.schema)


def refresh(
    spark: SparkSession,
    bronze: DataFrame,
    out_dir: str,
    as_of=None,
    run_checks: bool = True,
) -> dict[str, object]:
    """Rebuild everything under ``out_dir``; the silver views of the session show the new version."""
    versions = Snapshots(spark, out_dir)
    with versions.rebuild() as new:
        build(new, bronze, as_of, run_checks)
    made = versions.pin(new.version)
    silver.register_views(made.read(f"{SILVER}/{quality.STG}"), made.read(f"{SILVER}/{SESSIONS}"))
    names = (quality.DAILY, quality.FUNNEL, quality.PRODUCTS, quality.USERS)
    result: dict[str, object] = {"version": made.version, "paths": {name: made.path(f"{GOLD}/{name}") for name in names}}
    if run_checks:
        result["failures"] = new.notes["failures"]
    return result
