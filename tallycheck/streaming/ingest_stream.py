"""Streaming ingest: landed attempt files -> Bronze, one micro-batch at a time.

``readStream`` picks up new landed files (JSON lines or parquet, read with
RESPONSE_SCHEMA). Each micro-batch runs the batch ingest plan and appends
to Bronze with run id ``<prefix>-<batch id>``. The write replaces that run's
partition, so a restart that replays a batch, after its write committed or
midway, leaves exactly the batch's rows. The cost follows the batch, not the
table. The stream's checkpoint lives under the cluster's shared
``spark.checkpoint.dir`` unless given.

Within a batch, the latest success per request wins. Bronze is append-only,
so a request fetched again in a later batch is appended again; the duplicate
check reports it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallycheck.operators.fetch import REQUEST_KEYS
from tallycheck.plans.ingest import run_ingest
from tallycheck.schemas import RESPONSE_SCHEMA
from tallycheck.session import checkpoint_dir


def landed_stream(spark: SparkSession, landing_path: str, fmt: str = "json",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RESPONSE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_path)


def start_ingest_stream(
    spark: SparkSession,
    landing_path: str,
    bronze_table: str,
    run_id_prefix: str,
    fmt: str = "json",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    keys: Sequence[str] = REQUEST_KEYS,
    max_files_per_trigger: int | None = None,
    **write_options,
) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what has landed and stops."""
    location = checkpoint_location or (
        f"{checkpoint_dir(spark).rstrip('/')}/streams/{bronze_table.replace('.', '_')}"
    )
    write_options.setdefault("if_run_exists", "replace")

    def batch(df: DataFrame, batch_id: int) -> None:
        run_id = f"{run_id_prefix}-{batch_id}"
        run_ingest(df, bronze_table, run_id, dt.datetime.now(dt.timezone.utc), keys, **write_options)
        # The batch writes through the stream's own session; drop the
        # caller's cached file listing so its readers see the new files.
        spark.catalog.refreshTable(bronze_table)

    writer = (
        landed_stream(spark, landing_path, fmt, max_files_per_trigger)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", location)
        .queryName(f"ingest_{bronze_table.replace('.', '_')}")
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
