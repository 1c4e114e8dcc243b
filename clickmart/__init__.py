"""clickmart: clickstream analytics on Spark.

Stream ingest into a bronze table, deduplication, sessions, four gold marts,
declarative data-quality checks and live metrics, written with the DataFrame,
Spark SQL and Structured Streaming APIs.

    sources/     driver tables -> bronze, bronze scans, JSON parse/repair/stamp
    functions/   PostgreSQL-semantics scalar helpers, segment CASE chains
    operators/   dedup, global rank/ntile/row_number, data checks
    plans/       silver and gold models, reports, check suite, refresh, cleanup
    streaming/   stream ingest sink, live metrics, stream dedup, progress log
"""

__version__ = "0.1.0"
