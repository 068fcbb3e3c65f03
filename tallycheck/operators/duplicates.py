"""Repeated business keys.

The check counts keys, not rows: one key present three times is one
duplicate with ``count`` 3. Null keys group together and are reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycheck.constants import BUSINESS_KEYS, CHECK_DUPLICATES, WARN
from tallycheck.functions.status import status_from_count
from tallycheck.operators.coverage import CheckOutput, key_counts


def duplicate_keys(counts: DataFrame) -> DataFrame:
    """Keys of a ``key_counts`` tally seen more than once (HAVING count > 1)."""
    return counts.filter(F.col("count") > 1)


def duplicate_tally(dups: DataFrame) -> DataFrame:
    """One row: ``duplicate_count`` = number of repeated keys."""
    return dups.agg(F.count(F.lit(1)).alias("duplicate_count"))


def duplicate_result(dups: DataFrame, severity: str = WARN) -> DataFrame:
    """``check_name, status, duplicate_count``."""
    return duplicate_tally(dups).select(
        F.lit(CHECK_DUPLICATES).alias("check_name"),
        status_from_count("duplicate_count", severity).alias("status"),
        F.col("duplicate_count"),
    )


def check_duplicates(
    df: DataFrame,
    keys: Sequence[str] = BUSINESS_KEYS,
    counts: DataFrame | None = None,
    severity: str = WARN,
) -> CheckOutput:
    """Duplicate check over the whole table (or a shared tally)."""
    if counts is None:
        counts = key_counts(df, keys)
    dups = duplicate_keys(counts)
    return CheckOutput(result=duplicate_result(dups, severity), failing=dups)
