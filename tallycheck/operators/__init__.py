"""DataFrame-in, DataFrame-out operators."""

from tallycheck.operators.coverage import (
    CheckOutput,
    actual_keys,
    check_coverage,
    coverage_result,
    coverage_tally,
    expected_grid,
    in_range,
    key_counts,
    key_presence,
    missing_by_article,
    missing_coverage,
    run_tally,
    titles_frame,
    weighted_grid,
)
from tallycheck.operators.duplicates import (
    check_duplicates,
    duplicate_keys,
    duplicate_result,
    duplicate_tally,
)
from tallycheck.operators.fetch import (
    classify_attempts,
    fetch_outcome,
    fetch_summary,
    latest_success,
    request_plan,
)
from tallycheck.operators.flatten import flatten_responses, quarantine, quarantine_items
from tallycheck.operators.gate import GateError, enforce_gate, gate_failures
from tallycheck.operators.report import latest_run, latest_run_id, latest_run_sql
from tallycheck.operators.schema_drift import (
    check_schema,
    column_rows,
    expected_rows,
    schema_mismatches,
    schema_result,
    schema_tally,
)
from tallycheck.operators.windows import merged_windows, read_windows, rejected_windows, requested_grid, requested_tally, window_plan

__all__ = [
    "CheckOutput",
    "actual_keys",
    "check_coverage",
    "coverage_result",
    "coverage_tally",
    "expected_grid",
    "in_range",
    "key_counts",
    "key_presence",
    "missing_by_article",
    "missing_coverage",
    "run_tally",
    "titles_frame",
    "weighted_grid",
    "check_duplicates",
    "duplicate_keys",
    "duplicate_result",
    "duplicate_tally",
    "classify_attempts",
    "fetch_outcome",
    "fetch_summary",
    "latest_success",
    "request_plan",
    "flatten_responses",
    "quarantine",
    "quarantine_items",
    "GateError",
    "enforce_gate",
    "gate_failures",
    "latest_run",
    "latest_run_id",
    "latest_run_sql",
    "check_schema",
    "column_rows",
    "expected_rows",
    "schema_mismatches",
    "schema_result",
    "schema_tally",
    "merged_windows",
    "read_windows",
    "rejected_windows",
    "requested_grid",
    "requested_tally",
    "window_plan",
]
