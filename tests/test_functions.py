"""Column functions: date bounds, stamps, day counts, statuses."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycheck.functions import (
    check_bound,
    check_range,
    day_stamp,
    severity_of,
    stamp_range,
    status_from_count,
)


def test_check_bound_is_strict():
    assert check_bound("20260131") == dt.date(2026, 1, 31)
    for bad in ("2026011", "202601011", "2026-01-01", "20261301", "20260230", "", None, 20260101):
        with pytest.raises(ValueError):
            check_bound(bad)


def test_ranges():
    assert stamp_range("20260101", "20260131") == ("2026010100", "2026013100")
    with pytest.raises(ValueError):
        check_range("20260102", "20260101")


def test_day_stamp_of_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 23, 59, 59),)], "ts timestamp_ntz")
    assert df.select(day_stamp("ts")).collect()[0][0] == "2024013000"


def test_status_rules(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "n long")
    assert [r[0] for r in df.select(status_from_count("n")).collect()] == ["PASS", "WARN", "WARN"]
    assert [r[0] for r in df.select(status_from_count(F.col("n"), "FAIL")).collect()] == ["PASS", "FAIL", "FAIL"]
    with pytest.raises(ValueError):
        status_from_count("n", "ERROR")
    assert severity_of("schema_check", {"schema_check": "FAIL"}) == "FAIL"
    assert severity_of("duplicate_check", None) == "WARN"
