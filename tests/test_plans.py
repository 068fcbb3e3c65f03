"""Physical-plan properties that matter at scale, pinned as tests.

* no Cartesian product or nested-loop join anywhere;
* no broadcast decided before runtime (only AQE broadcasts, from measured sizes);
* every aggregate over keys combines map-side (partial aggregate before the exchange);
* a DQ run scans Bronze once and sends it through one exchange, with no join;
* scans read only the columns they need.
"""

import datetime as dt
import re
import uuid

import pytest

import __spark_entry__ as E
from tallycheck.operators.coverage import titles_frame
from tallycheck.operators.fetch import latest_success
from tallycheck.plans import DQConfig, run_checks
from tallycheck.sources import bindings as B
from tallycheck.sources.bronze import with_lineage, write_bronze

SF = "/root/testdata/sf0.001"


def plan_of(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_no_pairwise_join_and_no_static_broadcast(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert bad not in plan, f"{name}: {bad}"


def _exchange_inputs(plan):
    """Text of each Exchange's first child line (what feeds the shuffle)."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            out.append(lines[i + 1])
    return out


@pytest.mark.parametrize(
    "name", ["key_counts", "actual_keys", "duplicate_keys", "latest_success", "fetch_outcome",
             "audit_history", "duplicate_keys_lineitem"]
)
def test_key_aggregates_combine_map_side(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    feeds = _exchange_inputs(plan)
    assert feeds, name
    for feed in feeds:
        # a map-side aggregate feeds the shuffle (``partial_`` functions, or
        # none at all for a distinct)
        assert re.search(r"(Hash|Sort|ObjectHash)Aggregate\(keys?=", feed), (
            f"{name}: shuffle not fed by a map-side aggregate: {feed}")
        assert "partial_" in feed or "functions=[]" in feed, feed


def test_dq_run_scans_and_shuffles_bronze_once(spark):
    table = f"bronze_plan_{uuid.uuid4().hex[:8]}"
    events = B.read_table(spark, SF, "events")
    write_bronze(with_lineage(B.records_from_events(events), "r", dt.datetime(2026, 1, 31)), table)
    cfg = DQConfig(titles=["user_1", "user_2", "user_3"], start_date="20240101", end_date="20240131")
    plan = plan_of(run_checks(spark, spark.table(table), table, "r", None, cfg))
    assert plan.count("FileScan parquet") == 1
    union_shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "_side" in line]
    assert len(union_shuffles) == 1
    # the schema check is a projection over one row: no join, no exchange of its own
    assert "Join" not in plan
    assert sum("Exchange" in line for line in plan.split("\n")) == 3  # titles, keys, the one-row tally


def test_scans_are_pruned(spark):
    plan = plan_of(E.queries()["missing_coverage"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas <= {"struct<user_id:bigint>", "struct<ts:timestamp_ntz,user_id:bigint>"}, schemas
    plan = plan_of(E.queries()["request_plan"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_latest_success_parses_each_body_once(spark):
    events = B.read_table(spark, SF, "events")
    B.landed_attempts(events).write.mode("overwrite").saveAsTable("landed_once")
    plan = plan_of(latest_success(spark.table("landed_once")))
    # one variant parse, and one of the bodies that it rejects, in the scan stage's filter
    condition = plan[plan.index("+- Filter") : plan.index("+- FileScan")]
    assert condition.count("parseJson(") == 1 and condition.count("from_json(") == 1, condition
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and all(k in shuffles[0] for k in ("title", "start_date", "end_date", "page"))


def test_grid_days_are_generated_per_title(spark):
    from tallycheck.operators.coverage import expected_grid

    plan = plan_of(expected_grid(titles_frame(spark, ["a"]), "20260101", "20260131"))
    assert "Generate explode(sequence(" in plan or "Generate explode(" in plan
