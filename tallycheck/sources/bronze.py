"""Bronze table: scan, lineage columns and the append sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.schemas import BRONZE_SCHEMA, RECORD_COLUMNS


def timestamp_literal(value: dt.datetime | None) -> Column:
    """A TIMESTAMP literal; naive values are taken as UTC, None means now (UTC)."""
    if value is None:
        value = dt.datetime.now(dt.timezone.utc)
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")


def with_lineage(records: DataFrame, run_id: str, ingested_at: dt.datetime | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records plus ``_ingested_at`` and ``_ingestion_job_run_id``, in BRONZE_SCHEMA order, then the columns ``keep``.

    Both values are fixed once per run on the driver, so every row of a run
    carries the same stamp and id (SQL ``uuid()`` would differ per row, and
    ``now()`` per query, so two writes of one run would disagree).
    """
    if not run_id:
        raise ValueError("run_id is required")
    return records.select(
        *[F.col(c).cast(BRONZE_SCHEMA[c].dataType) for c in RECORD_COLUMNS],
        timestamp_literal(ingested_at).alias("_ingested_at"),
        F.lit(run_id).alias("_ingestion_job_run_id"),
        *keep,
    )


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


RUN_COLUMN = "_ingestion_job_run_id"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def write_bronze(
    bronze_rows: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    if_run_exists: str = "append",
    run_id: str | None = None,
) -> None:
    """Write Bronze rows to ``table``.

    ``if_run_exists`` decides what a re-run of the same run id does:

    * ``"append"`` (default): append again, as the reference's sink would.
    * ``"replace"`` (needs ``run_id``): afterwards the table holds exactly
      these rows for the run, whatever was there before: all of them, a part
      of them from a write cut off midway, or more. Also when there are fewer
      rows than before, or none. The table is partitioned by the run id
      first; the run's partitions are overwritten and every other run is
      untouched, without looking at the table's rows.

    ``partition_by`` (e.g. ``("timestamp",)`` or ``("_ingestion_job_run_id",)``)
    lays files out for pruning at scale; rows are rebalanced on it first.
    Spark retries lost tasks; the commit protocol only publishes finished
    task output.
    """
    if if_run_exists not in ("append", "replace"):
        raise ValueError("if_run_exists must be 'append' or 'replace'")
    spark = bronze_rows.sparkSession
    replace = if_run_exists == "replace"
    if replace:
        if not run_id:
            raise ValueError("if_run_exists='replace' needs the run_id of the rows")
        partition_by = (RUN_COLUMN, *(c for c in partition_by if c != RUN_COLUMN))
    out = bronze_rows.select(*BRONZE_SCHEMA.names)
    if partition_by:
        # Without this every task would write one file per partition value it
        # holds. REBALANCE groups rows by the partition columns, and AQE splits
        # a hot value (say one day with a third of the rows) into sized
        # pieces and merges small ones, so files come out evenly sized.
        out = out.hint("rebalance", *partition_by)
    if replace:
        write_by_run(out, table, run_id, fmt, partition_by)
        return
    writer = out.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def write_by_run(
    rows: DataFrame,
    table: str,
    run_id: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (RUN_COLUMN,),
    run_column: str = RUN_COLUMN,
) -> None:
    """Make ``rows`` (all of one run) the run's only rows in ``table``, partitioned by ``run_column`` first."""
    spark = rows.sparkSession
    if not table_exists(spark, table):
        rows.write.mode("append").format(fmt).partitionBy(*partition_by).saveAsTable(table)
        return
    found = partition_columns(spark, table)
    if found[:1] != [run_column]:
        raise ValueError(f"{table} must be partitioned by {run_column} first to replace a run, not by {found}")
    # The run id is a static partition value, so the overwrite clears
    # everything below it first, also when there are no rows.
    spec = ", ".join([f"`{run_column}` = :run_id", *(f"`{c}`" for c in found[1:])])
    data = [c for c in spark.table(table).columns if c not in found]
    with _static_overwrite(spark):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {{rows}}",
            args={"run_id": run_id},
            rows=rows.select(*data, *found[1:]),
        )


class _static_overwrite:
    """Context: an overwrite clears all that its static partition values name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.key = "spark.sql.sources.partitionOverwriteMode"

    def __enter__(self):
        self.old = self.spark.conf.get(self.key)
        self.spark.conf.set(self.key, "static")

    def __exit__(self, *exc):
        self.spark.conf.set(self.key, self.old)
        return False


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
