"""

Every query reads the driver's parquet tables (mostly ``events``) through
the bindings in ``tallycheck.sources.bindings`` and runs over whole tables.
"""

from __future__ import annotations

import datetime as dt
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycheck.operators import (  # noqa: E402
    actual_keys,
    classify_attempts,
    expected_grid,
    fetch_outcome,
    fetch_summary,
    flatten_responses,
    gate_failures,
    key_counts,
    latest_run,
    latest_run_sql,
    latest_success,
    missing_by_article,
    missing_coverage,
    quarantine,
    quarantine_items,
    request_plan,
)
from tallycheck.operators.coverage import check_coverage  # noqa: E402
from tallycheck.operators.duplicates import check_duplicates  # noqa: E402
from tallycheck.operators.ranges import bitmap_tally, missing_ranges  # noqa: E402
from tallycheck.operators.windows import merged_windows, rejected_windows, requested_tally, window_plan  # noqa: E402
from tallycheck.operators.type_drift import check_json_schema, observed_schema, type_profile  # noqa: E402
from tallycheck.plans import DQConfig, failing_keys, ingest, run_checks  # noqa: E402
from tallycheck.sources import bindings as B  # noqa: E402
from tallycheck.sources.bronze import with_lineage  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_ID = "run_1"
RUN_AT = dt.datetime(2026, 1, 31, tzinfo=dt.timezone.utc)
START, END = B.BINDING_START, B.BINDING_END
PROPS_SCHEMA = {"k": "string", "missing": "bigint"}
DRIFT_SCHEMA = {
    "id": "bigint",
    "amount": "double",
    "label": "string",
    "ratio": "bigint",
    "flag": "boolean",
    "pos": "struct<x:smallint,y:double>",
    "vals": "array<decimal(12,2)>",
    "gone": "string",
}


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.read_table(spark, sf_dir, "events")


def _records(spark, sf_dir):
    return B.records_from_events(_events(spark, sf_dir))


def _titles(records: DataFrame) -> DataFrame:
    return records.select("article").distinct()


def _grid(spark, sf_dir):
    return expected_grid(_titles(_records(spark, sf_dir)), START, END)


def _missing(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return check_coverage(recs, _titles(recs), START, END).failing


def _attempts(spark, sf_dir):
    return B.attempts_from_events(_events(spark, sf_dir))


def _history(spark, sf_dir):
    return B.audit_history(_events(spark, sf_dir))


def q_request_plan(spark, sf_dir):
    pages = B.read_table(spark, sf_dir, "pages")
    return request_plan(pages, title_col="url", start_date=START, end_date=END, keep=["page_id"])


def q_classified_attempts(spark, sf_dir):
    return classify_attempts(_attempts(spark, sf_dir)).select("title", "attempt_no", "reason", "fetched")


def q_latest_success(spark, sf_dir):
    return latest_success(_attempts(spark, sf_dir), keys=("title",))


def q_fetch_outcome(spark, sf_dir):
    return fetch_outcome(_attempts(spark, sf_dir), keys=("title",))


def q_fetch_summary(spark, sf_dir):
    return fetch_summary(fetch_outcome(_attempts(spark, sf_dir), keys=("title",)))


def q_records(spark, sf_dir):
    return _records(spark, sf_dir)


def q_flatten_responses(spark, sf_dir):
    return flatten_responses(B.landed_pages(_events(spark, sf_dir)))


def q_flatten_mistyped(spark, sf_dir):
    return flatten_responses(B.landed_pages_mistyped(_events(spark, sf_dir)))


def q_quarantine_pages(spark, sf_dir):
    return quarantine(B.landed_pages_mistyped(_events(spark, sf_dir))).select("title", "page")


def q_ingest_rows(spark, sf_dir):
    return ingest(B.landed_attempts(_events(spark, sf_dir)), RUN_ID, RUN_AT)


def q_bronze_rows(spark, sf_dir):
    return with_lineage(_records(spark, sf_dir), RUN_ID, RUN_AT)


def q_expected_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


def q_actual_keys(spark, sf_dir):
    return actual_keys(_records(spark, sf_dir))


def q_key_counts(spark, sf_dir):
    return key_counts(_records(spark, sf_dir))


def q_missing_coverage(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return missing_coverage(expected_grid(_titles(recs), START, END), key_counts(recs))


def q_missing_by_article(spark, sf_dir):
    return missing_by_article(_missing(spark, sf_dir))


def q_missing_ranges(spark, sf_dir):
    return missing_ranges(_missing(spark, sf_dir))


def q_coverage_bitmap(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return bitmap_tally(recs, _titles(recs), START, END)


def q_rejected_windows(spark, sf_dir):
    return rejected_windows(B.requests_from_events(_events(spark, sf_dir)))


def q_window_plan(spark, sf_dir):
    return window_plan(merged_windows(B.requests_from_events(_events(spark, sf_dir))))


def q_window_coverage(spark, sf_dir):
    windows = merged_windows(B.requests_from_events(_events(spark, sf_dir)))
    return requested_tally(_records(spark, sf_dir), windows)


def q_coverage_result(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return check_coverage(recs, _titles(recs), START, END).result


def q_duplicate_keys(spark, sf_dir):
    return check_duplicates(_records(spark, sf_dir)).failing


def q_duplicate_result(spark, sf_dir):
    return check_duplicates(_records(spark, sf_dir)).result


def q_duplicate_keys_lineitem(spark, sf_dir):
    lineitem = B.read_table(spark, sf_dir, "lineitem")
    return check_duplicates(lineitem, keys=("l_orderkey", "l_linenumber")).failing


def _props_check(spark, sf_dir):
    # types seen in all rows of a JSON column against what they should be
    return check_json_schema(_events(spark, sf_dir), "props", PROPS_SCHEMA, "events.props")


def q_props_mismatches(spark, sf_dir):
    return _props_check(spark, sf_dir).failing


def q_props_schema_result(spark, sf_dir):
    return _props_check(spark, sf_dir).result


def _drift_check(spark, sf_dir):
    return check_json_schema(B.drifting_props(_events(spark, sf_dir)), "props", DRIFT_SCHEMA, "events.drift")


def q_drift_mismatches(spark, sf_dir):
    return _drift_check(spark, sf_dir).failing


def q_drift_result(spark, sf_dir):
    return _drift_check(spark, sf_dir).result


def q_drift_schema(spark, sf_dir):
    return observed_schema(spark, type_profile(B.drifting_props(_events(spark, sf_dir)), "props", DRIFT_SCHEMA))


def q_dq_results(spark, sf_dir):
    # A Bronze whose columns come from the file as they are: views not cast,
    # and a column too many.
    events = _events(spark, sf_dir)
    recs = B.records_from_events(events, carry=("value", "event_type"))
    extra = [F.lit(RUN_AT).cast("timestamp").alias("_ingested_at"), F.lit(RUN_ID).alias("_ingestion_job_run_id")]
    bronze = recs.withColumn("views", F.col("value")).drop("value").select("*", *extra)
    cfg = DQConfig(titles=_titles(recs), start_date=START, end_date=END)
    return run_checks(spark, bronze, "events", RUN_ID, RUN_AT, cfg)


def q_failing_keys(spark, sf_dir):
    recs = _records(spark, sf_dir)
    cfg = DQConfig(titles=_titles(recs), start_date=START, end_date=END)
    return failing_keys(spark, recs, RUN_ID, cfg)


def q_quarantine_items(spark, sf_dir):
    pages = B.landed_pages_mistyped(_events(spark, sf_dir))
    return quarantine_items(pages).groupBy("title").agg(F.count("item_no").alias("items"))


def q_audit_history(spark, sf_dir):
    return _history(spark, sf_dir)


def q_gate_failures(spark, sf_dir):
    return gate_failures(_history(spark, sf_dir))


def q_latest_run_by_time(spark, sf_dir):
    return latest_run(_history(spark, sf_dir), by="checked_at")


def q_latest_run_by_id(spark, sf_dir):
    return latest_run(_history(spark, sf_dir), by="check_run_id")


def q_latest_run_sql(spark, sf_dir):
    # The report as SQL text over a table name, as it runs in a notebook.
    # spark.sql resolves the view when called, so a later replacement of the
    # view does not change this DataFrame.
    _history(spark, sf_dir).createOrReplaceTempView("tallycheck_audit_history")
    return spark.sql(latest_run_sql("tallycheck_audit_history", by="check_run_id"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "request_plan": q_request_plan,
    "classified_attempts": q_classified_attempts,
    "latest_success": q_latest_success,
    "fetch_outcome": q_fetch_outcome,
    "fetch_summary": q_fetch_summary,
    "records": q_records,
    "flatten_responses": q_flatten_responses,
    "flatten_mistyped": q_flatten_mistyped,
    "quarantine_pages": q_quarantine_pages,
    "quarantine_items": q_quarantine_items,
    "ingest_rows": q_ingest_rows,
    "bronze_rows": q_bronze_rows,
    "expected_grid": q_expected_grid,
    "actual_keys": q_actual_keys,
    "key_counts": q_key_counts,
    "missing_coverage": q_missing_coverage,
    "missing_by_article": q_missing_by_article,
    "missing_ranges": q_missing_ranges,
    "coverage_bitmap": q_coverage_bitmap,
    "rejected_windows": q_rejected_windows,
    "window_plan": q_window_plan,
    "window_coverage": q_window_coverage,
    "coverage_result": q_coverage_result,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_result": q_duplicate_result,
    "duplicate_keys_lineitem": q_duplicate_keys_lineitem,
    "props_mismatches": q_props_mismatches,
    "props_schema_result": q_props_schema_result,
    "drift_mismatches": q_drift_mismatches,
    "drift_result": q_drift_result,
    "drift_schema": q_drift_schema,
    "dq_results": q_dq_results,
    "failing_keys": q_failing_keys,
    "audit_history": q_audit_history,
    "gate_failures": q_gate_failures,
    "latest_run_by_time": q_latest_run_by_time,
    "latest_run_by_id": q_latest_run_by_id,
    "latest_run_sql": q_latest_run_sql,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the nine-column DQ results of a run over sf0.001 events."""
    return q_dq_results(spark, SMOKE_DIR)


def _llm():
    """The optional subpackage's queries and SQL, and the pipeline's, if they are installed."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}
    if importlib.util.find_spec("tallycheck.llm") and importlib.util.find_spec("tallycheck.llm.queries"):
        from tallycheck.llm import queries as llm

        found |= llm.QUERIES
        sql |= llm.ORACLE_SQL
        if importlib.util.find_spec("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

_R = (
    "select 'test.project' as project, 'user_' || user_id as article, 'daily' as granularity, "
    "strftime(ts, '%Y%m%d00') as \"timestamp\", cast(floor(value) as bigint) as views from events"
)
_D = (
    "select strftime(x, '%Y%m%d00') as \"timestamp\" from generate_series("
    "timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day) g(x)"
)
_G = "select a.article, d.\"timestamp\" from (select distinct article from R) a cross join D d"
_M = "select e.* from G e anti join R r on e.article = r.article and e.\"timestamp\" = r.\"timestamp\""
_U = 'select article, "timestamp", count(*) as "count" from R group by 1, 2 having count(*) > 1'
_OK = (
    "(error is null and (status_code is null or status_code not between 400 and 599) "
    "and json_valid(body) and json_type(body) = 'OBJECT')"
)
_A = (
    "select 'user_' || user_id as title, event_id as attempt_no, "
    "case when event_type = 'error' or user_id % 7 = 0 then 500 else 200 end as status_code, "
    "case event_id % 8 when 1 then props || ' oops}' when 2 then props || ',' || props "
    "when 3 then '[' || props || ']' when 4 then ' ' || chr(10) || props || chr(9) || ' ' "
    "when 5 then props || '}' else props end as body, cast(null as varchar) as error from events"
)
_AC = (
    f"select *, case when error is not null then 'request_error' "
    "when status_code between 400 and 599 then 'http_error' "
    "when not coalesce(json_valid(body), false) then 'invalid_json' "
    "when json_type(body) = 'NULL' then 'null_body' "
    "when json_type(body) <> 'OBJECT' then 'not_object' end as reason from A"
)
_H = (
    "select md5(cast(day as varchar)) as check_run_id, 'bronze' as layer, 'events' as table_name, "
    "'check_' || event_type as check_name, "
    "case when n < 60 then 'PASS' when n < 80 then 'WARN' else 'FAIL' end as check_status, "
    "'60' as expected_value, cast(n as varchar) as actual_value, "
    "'events of type ' || event_type || ' on ' || cast(day as varchar) as details, "
    "cast(day as timestamp) as checked_at "
    "from (select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2)"
)
_Q = (
    "select event_id, 'user_' || user_id as title, "
    "case when event_id % 17 = 0 then strftime(ts, '%Y-%m-%d') when event_id % 29 = 0 then '20240231' else strftime(ts, '%Y%m%d') end as start_date, "
    "case when event_id % 23 <> 0 then strftime(cast(ts as date) + case when event_id % 19 = 0 then -3 else cast(event_id % 5 as integer) end, '%Y%m%d') end as end_date "
    "from events"
)
_QP = (
    "select *, case when regexp_full_match(start_date, '[0-9]{8}') then cast(try_strptime(start_date, '%Y%m%d') as date) end as lo, "
    "case when regexp_full_match(end_date, '[0-9]{8}') then cast(try_strptime(end_date, '%Y%m%d') as date) end as hi from Q"
)
# every requested day once, whatever the windows
_W = "select distinct title, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from QP where lo <= hi"
_CTES = {"Q": _Q, "QP": _QP, "W": _W, "R": _R, "D": _D, "G": _G, "M": _M, "U": _U, "A": _A, "AC": _AC, "H": _H}
_DEPS = {"QP": ["Q"], "W": ["QP"], "G": ["R", "D"], "M": ["G", "R"], "U": ["R"], "AC": ["A"]}
_RUN_AT_SQL = "timestamp '2026-01-31 00:00:00'"
_URL_PREFIX = "https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article/en.wikipedia.org/all-access/user/"
# The texts of bindings.drifting_props.
_N2 = "cast(cast(value as decimal(12,2)) as varchar)"
_FLOOR = "cast(cast(floor(value) as bigint) as varchar)"
_BODY = (
    f"""'{{"id":' || event_id || ',"amount":' || case event_id % 4 when 0 then {_FLOOR} when 1 then {_N2} || 'e0' else {_N2} end || """
    f"""',"label":' || case when event_id % 5 = 0 then cast(user_id as varchar) else '"' || event_type || '"' end || ',"ratio":' || {_N2} || """
    """case event_id % 3 when 0 then ',"flag":true' when 1 then ',"flag":null' else '' end || """
    f"""',"pos":{{"x":' || user_id || ',"y":' || case when event_id % 7 = 0 then '"n/a"' else {_N2} end || ',"z":1}}' || """
    f"""',"vals":[' || {_N2} || ',' || {_FLOOR} || case when event_id % 11 = 0 then ',false' else '' end || ']' || """
    """case when event_id % 13 = 0 then ',"new_' || event_id % 3 || '":0' else '' end"""
)
_DRIFTING = f"(select case when event_id % 97 = 0 then 'gateway timeout' when event_id % 89 = 0 then {_BODY} else {_BODY} || '}}' end as props from events)"
_DRIFT_DECLARED = (
    "(0, 'id', null, 'bigint'), (1, 'amount', null, 'double'), (2, 'label', null, 'string'), (3, 'ratio', null, 'bigint'), (4, 'flag', null, 'boolean'), "
    "(5, 'pos', null, 'struct<x:smallint,y:double>'), (6, 'pos.x', 'pos', 'smallint'), (7, 'pos.y', 'pos', 'double'), "
    "(8, 'vals', null, 'array<decimal(12,2)>'), (9, 'vals[]', 'vals', 'decimal(12,2)'), (10, 'gone', null, 'string')"
)


def _json_profile(rows: str) -> str:
    """CTEs up to ``prof``: per path and family of a JSON column, its rows and the least type."""
    return (
        f"src as {rows}, ok as (select props from src where json_type(case when json_valid(props) then props end) = 'OBJECT'), "
        """top as (select k as path, json_extract(props, '$."' || k || '"') as v from (select props, unnest(json_keys(props)) as k from ok)), """
        """sub as (select 'pos.' || k as path, json_extract(v, '$."' || k || '"') as v from (select v, unnest(json_keys(v)) as k from top """
        "where path = 'pos' and json_type(v) = 'OBJECT')), "
        "el as (select 'vals[]' as path, unnest(json_extract(v, '$[*]')) as v from top where path = 'vals' and json_type(v) = 'ARRAY'), "
        "vals as (select path, v, json_type(v) as t, ltrim(cast(v as varchar), '-') as s from (select * from top union all select * from sub union all select * from el)), "
        "prof as (select path, family, count(*) as rows, "
        "case when family <> 'number' then family when bool_and(t <> 'DOUBLE') then 'bigint' when bool_or(exponent) then 'double' "
        "else 'decimal(' || (max(length(split_part(s, '.', 1))) + max(length(split_part(s, '.', 2)))) || ',' || max(length(split_part(s, '.', 2))) || ')' end as data_type, "
        "max(length(split_part(s, '.', 1))) as before, max(length(split_part(s, '.', 2))) as after, max(try_cast(s as bigint)) as hi from "
        "(select *, path = 'amount' as exponent, case t when 'NULL' then 'null' when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' "
        "when 'OBJECT' then 'object' else 'number' end as family from vals) group by 1, 2)"
    )


def _json_failing(rows: str, declared: str) -> str:
    """CTEs up to ``bad``: what is wrong with a JSON column."""
    fits = (
        "(family = 'null' or family = want or want = 'double' and family = 'number' or want = 'bigint' and data_type = 'bigint' "
        "or want = 'smallint' and data_type = 'bigint' and hi <= 32767 or want = 'decimal(12,2)' and family = 'number' and before <= 10 and after <= 2 "
        "or want like 'struct%' and family = 'object' or want like 'array%' and family = 'array')"
    )
    return (
        f"with {_json_profile(rows)}, want(ordinal, path, parent, want) as (values {declared}), "
        "bad as (select 0 as section, ordinal, path, 'Type mismatch on ' || path || ': expected ' || want || ', got ' || data_type as mismatch, rows "
        f"from prof join want using (path) where not {fits} "
        "union all select 0, ordinal, path, 'Missing column: ' || path, 0 from want w where path not in (select path from prof) and path not like '%[]' "
        "and (parent is null or exists (select 1 from prof p where p.path = w.parent and family in ('object', 'array'))) "
        "union all select 1, null, path, 'Unexpected column: ' || path, sum(rows) from prof where path not in (select path from want) group by path "
        "union all select 2, null, null, 'Unparsable rows: ' || count(*), count(*) from src where props is not null and "
        "coalesce(json_type(case when json_valid(props) then props end), '') <> 'OBJECT' having count(*) > 0)"
    )


_BAD_ROWS = "select section, ordinal, path, mismatch, cast(rows as bigint) as rows from bad"


def _bad_result(table: str) -> str:
    listed = "string_agg(mismatch, '; ' order by ordinal, mismatch) filter (where section = 0)"
    return (
        f"select '{table}' as table_name, 'schema_check' as check_name, case when count(*) = 0 then 'PASS' else 'WARN' end as status, "
        "count(*) as mismatch_count, cast(coalesce(sum(rows) filter (where section = 2), 0) as bigint) as unparsable_rows, "
        f"nullif(concat_ws('; ', {listed}, case when count(*) filter (where section = 1) > 0 then 'Unexpected columns: ' || count(*) filter (where section = 1) end, "
        "case when sum(rows) filter (where section = 2) > 0 then 'Unparsable rows: ' || cast(sum(rows) filter (where section = 2) as bigint) end), '') as details from bad"
    )


_PROPS_SQL = _json_failing("(select props from events)", "(0, 'k', null, 'string'), (1, 'missing', null, 'bigint')")
_DRIFT_SQL = _json_failing(_DRIFTING, _DRIFT_DECLARED)
# What the file says of the two columns that dq_results takes as they are.
_DRIFT = (
    "(select 1 as o, 'Type mismatch on views: expected bigint, got ' || lower(column_type) as m from (describe events) "
    "where column_name = 'value' and column_type <> 'BIGINT' "
    "union all select 2, 'Unexpected column: ' || column_name from (describe events) where column_name = 'event_type')"
)


def _with(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ", ".join(f"{n} as ({_CTES[n]})" for n in order) + " " + body


def oracle_sql() -> dict[str, str]:
    return {**_own_sql(), **_llm()[1]}


def _own_sql() -> dict[str, str]:
    lineage = f"{_RUN_AT_SQL} as _ingested_at, '{RUN_ID}' as _ingestion_job_run_id"
    return {
        "request_plan": (
            f"select page_id, '{_URL_PREFIX}' || url_encode(url) || '/daily/{START}/{END}' "
            "as request_url from pages"
        ),
        "classified_attempts": _with(
            "select title, attempt_no, reason, reason is null as fetched from AC", "AC"
        ),
        "latest_success": _with(
            "select title, max(attempt_no) as attempt_no, arg_max(body, attempt_no) as body "
            "from AC where reason is null group by title",
            "AC",
        ),
        "fetch_outcome": _with(
            "select title, case when bool_or(reason is null) then 'FETCHED' else 'FAILED' end "
            "as outcome, count(*) as attempts from AC group by title",
            "AC",
        ),
        "fetch_summary": _with(
            "select count(*) as requested, count(*) filter (where ok) as fetched from "
            "(select title, bool_or(reason is null) as ok from AC group by title)",
            "AC",
        ),
        "records": _with("select * from R", "R"),
        "flatten_responses": _with("select * from R", "R"),
        "flatten_mistyped": (
            "select 'test.project' as project, 'user_' || user_id as article, 'daily' as granularity, "
            "strftime(ts, '%Y%m%d00') as \"timestamp\", "
            "case when event_type = 'error' then null else cast(floor(value) as bigint) end as views "
            "from events where event_id % 50 <> 0"
        ),
        "quarantine_pages": (
            "select distinct 'batch_' || event_id // 100 as title, event_id // 100 as page "
            "from events where event_type = 'error' or event_id % 50 = 0"
        ),
        "quarantine_items": (
            "select 'batch_' || event_id // 100 as title, count(*) as items "
            "from events where event_type = 'error' or event_id % 50 = 0 group by 1"
        ),
        "ingest_rows": _with(f"select *, {lineage} from R", "R"),
        "bronze_rows": _with(f"select *, {lineage} from R", "R"),
        "expected_grid": _with("select * from G", "G"),
        "actual_keys": _with('select distinct article, "timestamp" from R', "R"),
        "key_counts": _with(
            'select article, "timestamp", count(*) as "count" from R group by 1, 2', "R"
        ),
        "missing_coverage": _with("select * from M", "M"),
        "missing_by_article": _with(
            "select article, string_agg(\"timestamp\", '; ' order by \"timestamp\") as details "
            "from (select distinct article, \"timestamp\" from M) group by 1",
            "M",
        ),
        "rejected_windows": _with(
            "select event_id, title, start_date, end_date, case when lo is null then 'start_date is not a YYYYMMDD day' "
            "when hi is null then 'end_date is not a YYYYMMDD day' else 'start_date is after end_date' end as reason "
            "from QP where lo is null or hi is null or lo > hi",
            "QP",
        ),
        "window_plan": _with(
            "select title, strftime(min(day), '%Y%m%d') as start_date, strftime(max(day), '%Y%m%d') as end_date, "
            f"'{_URL_PREFIX}' || title || '/daily/' || strftime(min(day), '%Y%m%d') || '/' || strftime(max(day), '%Y%m%d') as request_url "
            "from (select title, day, day - cast(row_number() over (partition by title order by day) as integer) as run from W) group by title, run",
            "W",
        ),
        "window_coverage": _with(
            "select count(w.title) as expected_count, count(*) filter (w.title is not null and r.article is null) as missing_count, "
            "count(*) filter (w.title is null) as unrequested_count from W w full join "
            "(select distinct article, \"timestamp\" as s from R) r on w.title = r.article and strftime(w.day, '%Y%m%d00') = r.s",
            "W",
            "R",
        ),
        "missing_ranges": _with(
            "select article, strftime(min(d), '%Y%m%d00') as first_day, strftime(max(d), '%Y%m%d00') as last_day, count(*) as days from "
            "(select article, d, d - cast(row_number() over (partition by article order by d) as integer) as run from "
            "(select distinct article, cast(strptime(\"timestamp\", '%Y%m%d00') as date) as d from M)) group by article, run",
            "M",
        ),
        "coverage_bitmap": _with("select (select count(*) from G) as expected_count, count(*) as missing_count from M", "M"),
        "coverage_result": _with(
            "select 'source_coverage' as check_name, "
            "case when count(*) = 0 then 'PASS' else 'WARN' end as status, "
            "count(*) as missing_count from M",
            "M",
        ),
        "duplicate_keys": _with("select * from U", "U"),
        "duplicate_result": _with(
            "select 'duplicate_check' as check_name, "
            "case when count(*) = 0 then 'PASS' else 'WARN' end as status, "
            "count(*) as duplicate_count from U",
            "U",
        ),
        "duplicate_keys_lineitem": (
            'select l_orderkey, l_linenumber, count(*) as "count" from lineitem '
            "group by 1, 2 having count(*) > 1"
        ),
        "props_mismatches": f"{_PROPS_SQL} {_BAD_ROWS}",
        "props_schema_result": f"{_PROPS_SQL} {_bad_result('events.props')}",
        "drift_mismatches": f"{_DRIFT_SQL} {_BAD_ROWS}",
        "drift_result": f"{_DRIFT_SQL} {_bad_result('events.drift')}",
        "drift_schema": (
            f"with {_json_profile(_DRIFTING)} select path, case when count(*) = 1 then max(data_type) else 'variant' end as data_type, cast(sum(rows) as bigint) as rows "
            "from prof where family <> 'null' group by path"
        ),
        "failing_keys": _with(
            f"select '{RUN_ID}' as check_run_id, 'source_coverage' as check_name, article, \"timestamp\", "
            "cast(1 as bigint) as expected, cast(0 as bigint) as \"rows\" from M "
            f"union all select '{RUN_ID}', 'duplicate_check', article, \"timestamp\", "
            "cast((select count(*) from G g where g.article = U.article and g.\"timestamp\" = U.\"timestamp\") as bigint), \"count\" from U",
            "M",
            "U",
        ),
        "dq_results": _with(
            f"select '{RUN_ID}' as check_run_id, 'bronze' as layer, 'events' as table_name, "
            "'source_coverage' as check_name, "
            "case when count(*) = 0 then 'PASS' else 'WARN' end as check_status, "
            "cast((select count(*) from G) as varchar) as expected_value, "
            "cast(count(*) as varchar) as actual_value, "
            "'Missing article/date combinations: ' || count(*) as details, "
            f"{_RUN_AT_SQL} as checked_at from M "
            f"union all select '{RUN_ID}', 'bronze', 'events', 'duplicate_check', "
            "case when count(*) = 0 then 'PASS' else 'WARN' end, '0', cast(count(*) as varchar), "
            f"'Duplicate article/timestamp combinations: ' || count(*), {_RUN_AT_SQL} from U "
            f"union all select '{RUN_ID}', 'bronze', 'events', 'schema_check', "
            "case when count(*) = 0 then 'PASS' else 'WARN' end, 'Expected schema', "
            "case when count(*) = 0 then 'MATCH' else 'MISMATCH' end, "
            f"coalesce(string_agg(m, '; ' order by o), 'Schema matches expected schema.'), {_RUN_AT_SQL} from {_DRIFT}",
            "M",
            "U",
        ),
        "audit_history": _with("select * from H", "H"),
        "gate_failures": _with(
            "select check_run_id, string_agg(check_name, ', ' order by check_name) as failed_checks "
            "from H where check_status = 'FAIL' group by 1",
            "H",
        ),
        "latest_run_by_time": _with(
            "select check_run_id, check_name, check_status, expected_value, actual_value, details, "
            "checked_at from H where check_run_id = (select arg_max(check_run_id, checked_at) from H) "
            "order by check_name",
            "H",
        ),
        "latest_run_by_id": _with(
            "select check_run_id, check_name, check_status, expected_value, actual_value, details, "
            "checked_at from H where check_run_id = (select max(check_run_id) from H) "
            "order by check_name",
            "H",
        ),
        "latest_run_sql": _with(
            "select check_run_id, check_name, check_status, expected_value, actual_value, details, "
            "checked_at from H where check_run_id = (select max(check_run_id) from H) "
            "order by check_name",
            "H",
        ),
    }
