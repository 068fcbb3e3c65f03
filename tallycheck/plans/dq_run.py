"""The Bronze DQ run: three checks -> nine-column audit rows -> append -> gate.

``run_checks`` builds all result rows as one lazy plan. Coverage and the
duplicate check are answered by one union-aggregate of Bronze keys with the
weighted expected grid (``run_tally``): Bronze is scanned once and crosses
one exchange, with hash aggregates only, for both checks. The schema check reads only metadata. Writing the audit rows
is the single action; the gate then reads back at most one row.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck import constants as K
from tallycheck.functions.status import severity_of, status_from_count
from tallycheck.operators.coverage import key_presence, run_tally, titles_frame
from tallycheck.operators.gate import enforce_gate
from tallycheck.operators.schema_drift import schema_compare
from tallycheck.schemas import AUDIT_COLUMNS
from tallycheck.sources.audit import read_audit, write_audit
from tallycheck.sources.bronze import timestamp_literal, write_by_run


@dataclass(frozen=True)
class DQConfig:
    """What a DQ run checks. ``titles`` may be a list or a one-column DataFrame."""

    titles: Sequence[str | None] | DataFrame = K.DEFAULT_TITLES
    start_date: str = K.DEFAULT_START
    end_date: str = K.DEFAULT_END
    expected_schema: Mapping[str, str] = field(default_factory=lambda: dict(K.EXPECTED_BRONZE_SCHEMA))
    keys: tuple[str, str] = K.BUSINESS_KEYS
    layer: str = K.LAYER_BRONZE
    # check name -> severity of a failing check ("WARN" default, or "FAIL")
    policy: Mapping[str, str] = field(default_factory=dict)


def _check_struct(
    check_name: str, status: Column, expected: Column, actual: Column, details: Column
) -> Column:
    return F.struct(
        F.lit(check_name).alias("check_name"),
        status.alias("check_status"),
        expected.cast("string").alias("expected_value"),
        actual.cast("string").alias("actual_value"),
        details.alias("details"),
    )


def _audit_row(
    tally: DataFrame,
    run_id: str,
    layer: str,
    table_name: str,
    check_name: str | Column,
    status: Column,
    expected_value: Column,
    actual_value: Column,
    details: Column,
    checked_at: Column,
) -> DataFrame:
    return tally.select(
        F.lit(run_id).alias("check_run_id"),
        F.lit(layer).alias("layer"),
        F.lit(table_name).alias("table_name"),
        (F.lit(check_name) if isinstance(check_name, str) else check_name).alias("check_name"),
        status.alias("check_status"),
        expected_value.cast("string").alias("expected_value"),
        actual_value.cast("string").alias("actual_value"),
        details.alias("details"),
        checked_at.alias("checked_at"),
    )


def run_checks(
    spark: SparkSession,
    bronze: DataFrame,
    table_name: str,
    run_id: str,
    checked_at: dt.datetime | None = None,
    config: DQConfig | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Audit rows (AUDIT_SCHEMA order) for coverage, duplicates and schema.

    ``counted`` (the keys and ``_rows``) stands for Bronze's rows in the first two, where keys are
    already counted; a key may have several such rows.
    """
    cfg = config or DQConfig()
    keys = cfg.keys
    at = timestamp_literal(checked_at)

    titles = titles_frame(spark, cfg.titles, keys[0])
    rows, weight = (bronze, None) if counted is None else (counted, "_rows")
    tally = run_tally(rows, titles, cfg.start_date, cfg.end_date, keys, weight)

    # Coverage: expected_value = grid size, actual_value = missing count.
    # Duplicates: expected "0", actual = number of repeated keys.
    # Both rows come out of the one tally row, so its plan runs once.
    missing, dups = F.col("missing_count"), F.col("duplicate_count")
    two_rows = F.array(
        _check_struct(
            K.CHECK_COVERAGE,
            status_from_count(missing, severity_of(K.CHECK_COVERAGE, cfg.policy)),
            F.col("expected_count"),
            missing,
            F.concat(F.lit(K.COVERAGE_DETAILS_PREFIX), missing.cast("string")),
        ),
        _check_struct(
            K.CHECK_DUPLICATES,
            status_from_count(dups, severity_of(K.CHECK_DUPLICATES, cfg.policy)),
            F.lit(K.DUPLICATE_EXPECTED_VALUE),
            dups,
            F.concat(F.lit(K.DUPLICATE_DETAILS_PREFIX), dups.cast("string")),
        ),
    )
    checks = tally.select(F.inline(two_rows))
    count_rows = _audit_row(
        checks, run_id, cfg.layer, table_name, F.col("check_name"), F.col("check_status"),
        F.col("expected_value"), F.col("actual_value"), F.col("details"), at,
    )

    # Schema: "Expected schema" / MATCH or MISMATCH, messages joined.
    sch = schema_compare(spark, bronze, cfg.expected_schema, table_name)
    n = F.size("mismatches")
    sch_row = _audit_row(
        sch, run_id, cfg.layer, table_name, K.CHECK_SCHEMA,
        status_from_count(n, severity_of(K.CHECK_SCHEMA, cfg.policy)),
        F.lit(K.SCHEMA_EXPECTED_VALUE),
        F.when(n == 0, F.lit(K.SCHEMA_MATCH)).otherwise(F.lit(K.SCHEMA_MISMATCH)),
        F.when(n == 0, F.lit(K.SCHEMA_OK_DETAILS)).otherwise(F.array_join("mismatches", K.MISMATCH_SEPARATOR)), at,
    )

    return count_rows.unionByName(sch_row).select(*AUDIT_COLUMNS)


def failing_keys(spark: SparkSession, bronze: DataFrame, run_id: str, config: DQConfig | None = None) -> DataFrame:
    """Every missing and every repeated key: ``check_run_id, check_name``, the keys, ``expected`` (how often the title is listed) and ``rows``.

    One union-aggregate, as for the counts; nothing is capped.
    """
    cfg = config or DQConfig()
    titles = titles_frame(spark, cfg.titles, cfg.keys[0])
    found = key_presence(bronze, titles, cfg.start_date, cfg.end_date, cfg.keys)
    checks = F.array_compact(
        F.array(
            F.when((F.col("_expected") > 0) & (F.col("_rows") == 0), F.lit(K.CHECK_COVERAGE)),
            F.when(F.col("_rows") > 1, F.lit(K.CHECK_DUPLICATES)),
        )
    )
    return found.select(
        F.lit(run_id).alias("check_run_id"),
        F.explode(checks).alias("check_name"),
        *cfg.keys,
        F.col("_expected").alias("expected"),
        F.col("_rows").alias("rows"),
    )


def run_bronze_dq(
    spark: SparkSession,
    bronze_table: str,
    audit_table: str,
    config: DQConfig | None = None,
    run_id: str | None = None,
    checked_at: dt.datetime | None = None,
    fmt: str = "parquet",
    failing_table: str | None = None,
    audit_by_day: bool = False,
) -> str:
    """Check a Bronze table, append the results, then apply the gate.

    With ``failing_table`` every missing and repeated key is written there
    too (partitioned by run id; a repeated run id replaces its own), before
    the gate. ``audit_by_day`` partitions a new audit table by run day. Returns the run id. Raises :class:`~tallycheck.operators.gate.GateError`
    after the write when a check failed hard, so the failed run is recorded.
    """
    run_id = run_id or str(uuid.uuid4())
    checked_at = checked_at or dt.datetime.now(dt.timezone.utc)
    results = run_checks(spark, spark.table(bronze_table), bronze_table, run_id, checked_at, config)
    write_audit(results, audit_table, fmt, audit_by_day)
    if failing_table:
        rows = failing_keys(spark, spark.table(bronze_table), run_id, config)
        write_by_run(rows, failing_table, run_id, fmt, ("check_run_id",), "check_run_id")
    enforce_gate(read_audit(spark, audit_table, checked_at), run_id)
    return run_id
