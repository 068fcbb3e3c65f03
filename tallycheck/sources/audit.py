"""Audit table: definition and the append sink (written before the gate).

A table may be partitioned by ``run_date``, the UTC day of ``checked_at``. The day of the latest run is then taken from the catalog's
partition list, and the report and the gate read the files of one day, however long the history is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.schemas import AUDIT_COLUMNS, AUDIT_REQUIRED, AUDIT_SCHEMA, ddl
from tallycheck.sources.bronze import timestamp_literal

#: Partition column of an audit table partitioned by day.
RUN_DATE = "run_date"


def create_audit_table(spark: SparkSession, table: str, fmt: str = "parquet", by_day: bool = False) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the nine audit columns and, ``by_day``, the partition column ``run_date``."""
    columns, parts = ddl(AUDIT_SCHEMA), ""
    if by_day:
        columns, parts = f"{columns}, {RUN_DATE} DATE", f" PARTITIONED BY ({RUN_DATE})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{parts}")


def is_by_day(spark: SparkSession, table: str) -> bool:
    return any(c.name == RUN_DATE and c.isPartition for c in spark.catalog.listColumns(table))


def utc_day(timestamp: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(timestamp) / 86_400).cast("int"))


def guard_not_null(results: DataFrame) -> DataFrame:
    """Fail the write job if a required column is NULL.

    A parquet table does not enforce NOT NULL, so each required value is
    wrapped in ``coalesce(value, raise_error(...))``: the check runs inside
    the write itself, with no extra pass over the data.
    """
    cols = []
    for name in AUDIT_COLUMNS:
        c = F.col(name).cast(AUDIT_SCHEMA[name].dataType)
        if name in AUDIT_REQUIRED:
            c = F.coalesce(c, F.raise_error(F.lit(f"audit column {name} must not be NULL")))
        cols.append(c.alias(name))
    return results.select(*cols)


def write_audit(results: DataFrame, table: str, fmt: str = "parquet", by_day: bool = False) -> None:
    """Append check results. A run yields a handful of rows: one file. ``by_day`` counts when the table is created; one that exists keeps its form."""
    spark = results.sparkSession
    create_audit_table(spark, table, fmt, by_day)
    rows = guard_not_null(results).coalesce(1)
    if not is_by_day(spark, table):
        rows.write.mode("append").format(fmt).saveAsTable(table)
        return
    rows.withColumn(RUN_DATE, utc_day(F.col("checked_at"))).write.mode("append").format(fmt).partitionBy(RUN_DATE).saveAsTable(table)


def read_audit(spark: SparkSession, table: str, checked_at: dt.datetime | None = None) -> DataFrame:
    """The nine audit columns; with ``checked_at``, of a table partitioned by day only that day's rows are read."""
    rows = spark.table(table)
    if checked_at is not None and is_by_day(spark, table):
        rows = rows.filter(F.col(RUN_DATE) == utc_day(timestamp_literal(checked_at)))
    return rows.select(*AUDIT_COLUMNS)


def read_latest_day(spark: SparkSession, table: str) -> DataFrame:
    """The rows that can hold the latest run: of a table partitioned by day those of its last day, of any other all.

    The day comes from the catalog (a row per day); no older file is opened. Without partitions there are no rows.
    """
    if not is_by_day(spark, table):
        return read_audit(spark, table)
    days = spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", f"^{RUN_DATE}=([0-9-]+)$", 1).alias("day"))
    last = days.agg(F.max(F.nullif("day", F.lit("")))).first()[0]
    return spark.table(table).filter(F.col(RUN_DATE) == F.lit(last).cast("date")).select(*AUDIT_COLUMNS)
