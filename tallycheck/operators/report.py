"""Latest-run report over the audit table.

``by="checked_at"`` picks the run with the latest check time; of runs checked
at the same time, the one with the greatest id, so reruns agree. ``by=
"check_run_id"`` keeps the literal rule of taking the greatest run id; run
ids are random UUIDs, so that is *a* run, not the latest one. The run id is
found by a one-row aggregate used as a scalar subquery, so the audit table
is filtered in the same plan and nothing goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.schemas import REPORT_COLUMNS


def latest_run_id(audit: DataFrame, by: str = "checked_at") -> DataFrame:
    """One-row, one-column frame with the chosen run id."""
    if by == "checked_at":
        latest = F.max(F.struct("checked_at", "check_run_id"))
        return audit.agg(latest["check_run_id"].alias("check_run_id"))
    if by == "check_run_id":
        return audit.agg(F.max("check_run_id").alias("check_run_id"))
    raise ValueError(f"by must be 'checked_at' or 'check_run_id', got {by!r}")


def latest_run(audit: DataFrame, by: str = "checked_at") -> DataFrame:
    """Rows of the latest run, seven report columns, ordered by check name."""
    run_id = latest_run_id(audit, by).scalar()
    return (
        audit.filter(F.col("check_run_id") == run_id)
        .select(*REPORT_COLUMNS)
        .orderBy("check_name")
    )


def latest_run_sql(table: str, by: str = "checked_at") -> str:
    """The same report as SQL text over a named table."""
    cols = ", ".join(REPORT_COLUMNS)
    if by == "checked_at":
        pick = f"SELECT max(struct(checked_at, check_run_id)).check_run_id FROM {table}"
    elif by == "check_run_id":
        pick = f"SELECT MAX(check_run_id) FROM {table}"
    else:
        raise ValueError(f"by must be 'checked_at' or 'check_run_id', got {by!r}")
    return f"SELECT {cols} FROM {table} WHERE check_run_id = ({pick}) ORDER BY check_name"
