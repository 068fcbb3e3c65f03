"""Spark-native ingestion and data-quality checks for daily count series.

    from tallycheck import build_session, check_coverage, check_duplicates, check_schema

    spark = build_session()
    bronze = spark.table("bronze.pageviews")
    cov = check_coverage(bronze, ["Minecraft", "Cyberpunk_2077"], "20260101", "20260131")
    cov.result.show(); cov.failing.show()      # lazy DataFrames

End-to-end runs: ``run_ingest`` (landed attempts -> Bronze) and
``run_bronze_dq`` (checks -> audit table -> gate).
"""

from tallycheck.operators import check_coverage, check_duplicates, check_schema
from tallycheck.plans import DQConfig, ingest, run_bronze_dq, run_checks, run_ingest
from tallycheck.session import build_session, checkpoint_dir

__all__ = [
    "DQConfig",
    "build_session",
    "check_coverage",
    "check_duplicates",
    "check_schema",
    "checkpoint_dir",
    "ingest",
    "run_bronze_dq",
    "run_checks",
    "run_ingest",
]
