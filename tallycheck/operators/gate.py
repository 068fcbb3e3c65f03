"""The gate: a hard FAIL stops the run, after its results were recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.constants import CHECK_ORDER, FAIL, FAILED_CHECKS_SEPARATOR, GATE_MESSAGE


class GateError(ValueError):
    """Raised when a run has at least one FAIL result."""


def gate_failures(audit: DataFrame) -> DataFrame:
    """Per run with a FAIL: ``check_run_id, failed_checks`` joined with ``", "``.

    Known checks come in run order (coverage, duplicates, schema), others
    after them by name. ``collect_set`` keeps one entry per check, so a
    group's buffer is bounded by the check list even if a run id was
    appended twice.
    """
    known = F.array(*[F.lit(c) for c in CHECK_ORDER])
    rank = F.array_position(known, F.col("check_name"))
    order = F.when(rank > 0, rank).otherwise(F.lit(len(CHECK_ORDER) + 1))
    entry = F.struct(order.alias("o"), F.col("check_name").alias("n"))
    return (
        audit.filter(F.col("check_status") == FAIL)
        .groupBy("check_run_id")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_set(entry)), lambda e: e["n"]),
                FAILED_CHECKS_SEPARATOR,
            ).alias("failed_checks")
        )
    )


def enforce_gate(audit: DataFrame, run_id: str) -> None:
    """Raise :class:`GateError` if the run has a FAIL; WARN passes.

    Collects at most one row (the run's failed check names).
    """
    rows = gate_failures(audit.filter(F.col("check_run_id") == run_id)).collect()
    if rows and rows[0]["failed_checks"]:
        raise GateError(GATE_MESSAGE.format(checks=rows[0]["failed_checks"], run_id=run_id))
