"""Incremental DQ runs against runs from scratch."""

import datetime as dt
import random
import uuid

import pytest

from tallycheck.plans import DQConfig, run_checks
from tallycheck.plans.incremental import incremental_checks, refresh_tally, run_incremental_dq, tallied_keys
from tallycheck.sources.bronze import RUN_COLUMN, with_lineage, write_bronze

AT = dt.datetime(2026, 1, 31, tzinfo=dt.timezone.utc)
CONFIG = DQConfig(titles=["A", "B", "C", "A"], start_date="20260101", end_date="20260105")


@pytest.fixture
def bronze(spark):
    class Bronze:
        table, tally = f"bronze_{uuid.uuid4().hex[:8]}", f"tally_{uuid.uuid4().hex[:8]}"

        def append(self, run, keys):
            rows = [("p", a, "daily", t, 1) for a, t in keys]
            frame = spark.createDataFrame(rows, "project string, article string, granularity string, timestamp string, views long")
            write_bronze(with_lineage(frame, run, AT), self.table, if_run_exists="replace", run_id=run)
            spark.catalog.refreshTable(self.table)

        def both(self):
            scratch = run_checks(spark, spark.table(self.table), self.table, "r", AT, CONFIG)
            tallied = incremental_checks(spark, self.table, self.tally, "r", AT, CONFIG)
            return sorted(map(tuple, scratch.collect()), key=repr), sorted(map(tuple, tallied.collect()), key=repr)

    return Bronze()


def some(seed, n=30):
    rng = random.Random(seed)
    return [(rng.choice("ABBBD"), f"202601{rng.randint(1, 7):02d}00") for _ in range(n)] + [(None, "2026010100"), ("A", None)]


def test_three_appends_equal_a_run_from_scratch(spark, bronze):
    read = []
    for k in range(3):
        bronze.append(f"run {k}/é=%", some(k))
        read.append(refresh_tally(spark, bronze.table, bronze.tally))
        scratch, tallied = bronze.both()
        assert tallied == scratch
    assert read == [[f"run {k}/é=%"] for k in range(3)]
    assert refresh_tally(spark, bronze.table, bronze.tally) == []


def test_a_replaced_run_is_counted_anew(spark, bronze):
    bronze.append("one", some(1))
    bronze.append("two", some(2))
    bronze.both()
    bronze.append("one", some(3, 12))
    assert refresh_tally(spark, bronze.table, bronze.tally) == ["one"]
    scratch, tallied = bronze.both()
    assert tallied == scratch
    # a run that is empty now
    bronze.append("two", [])
    scratch, tallied = bronze.both()
    assert tallied == scratch


def test_a_refresh_that_stopped_midway_is_taken_up(spark, bronze, monkeypatch):
    from tallycheck.plans import incremental

    for k in range(3):
        bronze.append(f"r{k}", some(k))
    write, done = incremental.write_by_run, []

    def failing(rows, table, run, *args):
        if len(done) == 1:
            raise RuntimeError("stopped")
        done.append(run)
        write(rows, table, run, *args)

    monkeypatch.setattr(incremental, "write_by_run", failing)
    with pytest.raises(RuntimeError):
        refresh_tally(spark, bronze.table, bronze.tally)
    monkeypatch.undo()
    assert refresh_tally(spark, bronze.table, bronze.tally) == ["r1", "r2"]
    scratch, tallied = bronze.both()
    assert tallied == scratch


def test_only_the_changed_run_is_read(spark, bronze):
    bronze.append("old", some(1))
    refresh_tally(spark, bronze.table, bronze.tally)
    plan = spark.table(bronze.table).filter(f"{RUN_COLUMN} = 'old'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_job_run_id" in plan
    keys = tallied_keys(spark, bronze.tally)
    assert keys.groupBy().sum("_rows").first()[0] == 32 and keys.count() < 32


def test_audit_rows_and_tables_without_runs(spark, bronze):
    bronze.append("one", some(5))
    audit = f"audit_{uuid.uuid4().hex[:8]}"
    run = run_incremental_dq(spark, bronze.table, audit, bronze.tally, CONFIG, checked_at=AT)
    assert spark.table(audit).filter(f"check_run_id = '{run}'").count() == 3
    flat = f"flat_{uuid.uuid4().hex[:8]}"
    spark.table(bronze.table).write.saveAsTable(flat)
    with pytest.raises(ValueError):
        refresh_tally(spark, flat, bronze.tally)
