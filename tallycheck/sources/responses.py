"""Landed fetch attempts.

The HTTP client is outside the engine: whatever fetches pages lands one
record per attempt (JSON lines or parquet) with RESPONSE_SCHEMA. Reading
with the explicit schema skips inference; missing optional columns
(window, page) are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycheck.schemas import RESPONSE_SCHEMA


def read_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def responses_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Small in-memory responses (tests, fixtures)."""
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)
