"""DQ runs that read only what was written since the last run, from a persisted tally of keys.

The tally has one row per (ingestion run, business key) with its rows, so it merges by addition: coverage and duplicates over all runs are sums over
the tally, which holds no more rows than distinct keys per run. It is partitioned by ingestion run, as Bronze is. ``refresh_tally`` lists the
files of Bronze (names, sizes and times, no contents), and reads again only the runs whose files are new or differ from those that the tally
was made from; runs that left Bronze leave the tally. A refresh that stops midway is taken up by the next one: a run's rows and the mark of its files are
one partition of one table, replaced as a whole.

A run is known by its number of files, their bytes and the latest time, so a replaced run is counted anew. The result equals a DQ run from scratch.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.constants import BUSINESS_KEYS
from tallycheck.operators.coverage import key_counts
from tallycheck.operators.gate import enforce_gate
from tallycheck.plans.dq_run import DQConfig, run_checks
from tallycheck.sources.audit import read_audit, write_audit
from tallycheck.sources.bronze import RUN_COLUMN, partition_columns, table_exists, write_by_run

#: What the files of a run were when it was counted.
VERSION_COLUMN = "_version"
#: Rows of a key in a run.
ROWS_COLUMN = "_rows"
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def table_location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    if found is None:
        raise ValueError(f"{table} has no location; an incremental run needs a table of files")
    return found["data_type"]


def run_versions(spark: SparkSession, table: str) -> DataFrame:
    """(run, version) of every ingestion run in ``table`` (partitioned by run first), from a listing of its files."""
    if partition_columns(spark, table)[:1] != [RUN_COLUMN]:
        raise ValueError(f"{table} must be partitioned by {RUN_COLUMN} first")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.*").load(table_location(spark, table))
    run = F.regexp_extract("path", f"/{RUN_COLUMN}=([^/]*)/", 1)
    per_run = files.select(run.alias("run"), "modificationTime", "length").filter("run <> ''").groupBy("run")
    mark = F.concat_ws("/", F.count(F.lit(1)).cast("string"), F.sum("length").cast("string"), F.unix_micros(F.max("modificationTime")).cast("string"))
    return per_run.agg(mark.alias("version"))


def _known(spark: SparkSession, tally_table: str) -> dict[str, str]:
    if not table_exists(spark, tally_table):
        return {}
    spark.catalog.refreshTable(tally_table)
    # one mark per run; a run without rows keeps its mark on a row of its own, with no key
    rows = spark.table(tally_table).filter(F.col(ROWS_COLUMN) == 0).select(RUN_COLUMN, VERSION_COLUMN)
    return {r[0]: r[1] for r in rows.toLocalIterator()}


def tally_rows(bronze: DataFrame, version: str, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """The tally of one run's rows: keys, rows, version; and one row with 0 rows that carries the mark."""
    counted = key_counts(bronze, keys).select(*keys, F.col("count").alias(ROWS_COLUMN))
    mark = bronze.sparkSession.range(0, 1, 1, 1).select(*[F.lit(None).cast(bronze.schema[k].dataType).alias(k) for k in keys], F.lit(0).cast("long").alias(ROWS_COLUMN))
    return counted.unionByName(mark).withColumn(VERSION_COLUMN, F.lit(version))


def refresh_tally(spark: SparkSession, bronze_table: str, tally_table: str, keys: Sequence[str] = BUSINESS_KEYS) -> list[str]:
    """Bring the tally up to date; returns the runs that were read. Run ids and marks pass through the driver, never rows."""
    spark.catalog.refreshTable(bronze_table)
    known = _known(spark, tally_table)
    current = {unquote(r["run"]): r["version"] for r in run_versions(spark, bronze_table).toLocalIterator() if r["run"] != _HIVE_NULL}
    changed = sorted(run for run, version in current.items() if known.get(run) != version)
    bronze = spark.table(bronze_table)
    for run in changed:
        rows = tally_rows(bronze.filter(F.col(RUN_COLUMN) == run), current[run], keys)
        write_by_run(rows.withColumn(RUN_COLUMN, F.lit(run)), tally_table, run)
        spark.catalog.refreshTable(tally_table)
    for run in sorted(set(known) - set(current)):
        write_by_run(spark.createDataFrame([], spark.table(tally_table).schema), tally_table, run)
        spark.catalog.refreshTable(tally_table)
    return changed


def tallied_keys(spark: SparkSession, tally_table: str, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """Business keys with ``_rows``, one row per key and run; the sum over runs is Bronze's count."""
    return spark.table(tally_table).filter(F.col(ROWS_COLUMN) > 0).select(*keys, ROWS_COLUMN)


def incremental_checks(
    spark: SparkSession,
    bronze_table: str,
    tally_table: str,
    run_id: str,
    checked_at: dt.datetime | None = None,
    config: DQConfig | None = None,
) -> DataFrame:
    """The audit rows of :func:`~tallycheck.plans.dq_run.run_checks`, with keys counted from a refreshed tally and the schema from Bronze."""
    cfg = config or DQConfig()
    refresh_tally(spark, bronze_table, tally_table, cfg.keys)
    counted = tallied_keys(spark, tally_table, cfg.keys)
    return run_checks(spark, spark.table(bronze_table), bronze_table, run_id, checked_at, cfg, counted=counted)


def run_incremental_dq(
    spark: SparkSession,
    bronze_table: str,
    audit_table: str,
    tally_table: str,
    config: DQConfig | None = None,
    run_id: str | None = None,
    checked_at: dt.datetime | None = None,
    fmt: str = "parquet",
) -> str:
    """Like :func:`~tallycheck.plans.dq_run.run_bronze_dq`, reading only runs that are new or changed since the last one."""
    run_id = run_id or str(uuid.uuid4())
    checked_at = checked_at or dt.datetime.now(dt.timezone.utc)
    write_audit(incremental_checks(spark, bronze_table, tally_table, run_id, checked_at, config), audit_table, fmt)
    enforce_gate(read_audit(spark, audit_table, checked_at), run_id)
    return run_id
