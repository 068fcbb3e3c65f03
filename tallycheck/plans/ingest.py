"""The ingest run: landed attempts -> one response per request -> records -> Bronze.

One plan: classify and keep the latest success per request (aggregated
map-side), parse and explode its items, add the run's lineage columns,
append. The driver holds no data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.operators.fetch import REQUEST_KEYS, latest_success
from tallycheck.operators.flatten import flatten_responses, quarantine_items
from tallycheck.sources.bronze import RUN_COLUMN, with_lineage, write_bronze, write_by_run


def ingest(
    responses: DataFrame,
    run_id: str,
    ingested_at: dt.datetime | None = None,
    keys: Sequence[str] = REQUEST_KEYS,
) -> DataFrame:
    """Bronze rows (BRONZE_SCHEMA) from landed attempts."""
    return with_lineage(flatten_responses(latest_success(responses, keys)), run_id, ingested_at)


def quarantined(winners: DataFrame, run_id: str) -> DataFrame:
    """Items of the winning bodies that did not fit, with their request and the run id."""
    return quarantine_items(winners).withColumn(RUN_COLUMN, F.lit(run_id))


def run_ingest(
    responses: DataFrame,
    bronze_table: str,
    run_id: str,
    ingested_at: dt.datetime | None = None,
    keys: Sequence[str] = REQUEST_KEYS,
    quarantine_table: str | None = None,
    **write_options,
) -> None:
    """Ingest and write; see :func:`~tallycheck.sources.bronze.write_bronze` options.

    With ``quarantine_table`` every item that did not fit the schema is
    recorded there, by run (a table partitioned by run id; a re-run replaces
    its own). The winning bodies then serve two writes and are kept on
    executor disks in between; lost ones are computed again.
    """
    winners = latest_success(responses, keys)
    if quarantine_table:
        winners = winners.persist(StorageLevel.DISK_ONLY)
    try:
        write_bronze(with_lineage(flatten_responses(winners), run_id, ingested_at), bronze_table, run_id=run_id, **write_options)
        if quarantine_table:
            write_by_run(quarantined(winners, run_id), quarantine_table, run_id)
    finally:
        if quarantine_table:
            winners.unpersist()
