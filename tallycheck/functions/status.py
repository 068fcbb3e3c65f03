"""Status decisions shared by the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck.constants import FAIL, PASS, WARN


def status_from_count(count: Column | str, severity: str = WARN) -> Column:
    """PASS when no problem was counted, else ``severity`` (WARN or FAIL)."""
    if severity not in (WARN, FAIL):
        raise ValueError(f"severity must be {WARN} or {FAIL}, got {severity!r}")
    c = F.col(count) if isinstance(count, str) else count
    return F.when(c == 0, F.lit(PASS)).otherwise(F.lit(severity))


def severity_of(check_name: str, policy: dict[str, str] | None) -> str:
    """Severity of a failing check under an optional policy map; default WARN."""
    return (policy or {}).get(check_name, WARN)
