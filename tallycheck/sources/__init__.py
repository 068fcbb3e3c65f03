"""Sources and sinks: landed responses, Bronze, audit, test-table bindings."""

from tallycheck.sources.audit import create_audit_table, guard_not_null, read_audit, read_latest_day, write_audit
from tallycheck.sources.bronze import (
    read_bronze,
    table_exists,
    timestamp_literal,
    with_lineage,
    write_bronze,
)
from tallycheck.sources.responses import read_responses, responses_frame

__all__ = [
    "create_audit_table",
    "guard_not_null",
    "read_audit",
    "read_latest_day",
    "write_audit",
    "read_bronze",
    "table_exists",
    "timestamp_literal",
    "with_lineage",
    "write_bronze",
    "read_responses",
    "responses_frame",
]
