"""ledgerlake: a Spark-native retail trusted-reporting layer.

Typed CSV ingest of two sales facts and eleven dimensions, a star/snowflake
join layer that keeps or drops orphan rows, cleaning rules, keep-latest
deduplication, reporting views with revenue/cost/profit, and a reusable
profiling / data-quality / reconciliation suite -- all DataFrame jobs.
"""

__all__ = ["session", "schemas"]
