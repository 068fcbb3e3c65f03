"""Fetch attempts: outcome rules, one response per request, request URLs."""

import json
from urllib.parse import quote

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallycheck.operators.fetch import (
    classify_attempts,
    fetch_outcome,
    fetch_summary,
    latest_success,
    request_plan,
)
from tallycheck.sources.responses import responses_frame
from tests.conftest import rows

ZELDA = {
    "items": [
        {
            "project": "en.wikipedia",
            "article": "The_Legend_of_Zelda",
            "granularity": "daily",
            "timestamp": "2022010100",
        }
    ]
}


def attempt(title, no, status, body, error=None, start="20220101", end="20220131", page=None):
    return (title, start, end, page, no, status, body, error)


def test_success_body_passes_through_unchanged(spark):
    body = json.dumps(ZELDA)
    df = responses_frame(spark, [attempt("The_Legend_of_Zelda", 1, 200, body)])
    out = latest_success(df).collect()
    assert len(out) == 1
    assert json.loads(out[0]["body"]) == ZELDA
    assert out[0]["body"] == body
    assert out[0]["attempt_no"] == 1


def test_failure_gives_no_response_and_one_attempt(spark):
    df = responses_frame(spark, [attempt("The_Legend_of_Zelda", 1, None, None, "API request failed")])
    assert latest_success(df).count() == 0
    oc = fetch_outcome(df).collect()
    assert [(r["outcome"], r["attempts"]) for r in oc] == [("FAILED", 1)]


def test_attempt_rules(spark):
    ok1, ok2 = '{"items":[{"views":1}]}', '{"items":[{"views":2}]}'
    df = responses_frame(
        spark,
        [
            # success then failure: success kept
            attempt("a", 1, 200, ok1),
            attempt("a", 2, 500, None),
            # success then success: later kept
            attempt("b", 1, 200, ok1),
            attempt("b", 2, 200, ok2),
            # failures only
            attempt("c", 1, 404, "{}"),
            attempt("c", 2, None, None, "timeout"),
        ],
    )
    got = {r["title"]: (r["attempt_no"], r["body"]) for r in latest_success(df).collect()}
    assert got == {"a": (1, ok1), "b": (2, ok2)}
    outcomes = {r["title"]: (r["outcome"], r["attempts"]) for r in fetch_outcome(df).collect()}
    assert outcomes == {"a": ("FETCHED", 2), "b": ("FETCHED", 2), "c": ("FAILED", 2)}
    summary = fetch_summary(fetch_outcome(df)).collect()[0]
    assert (summary["requested"], summary["fetched"]) == (3, 2)


def test_request_key_includes_window(spark):
    ok = '{"items":[]}'
    df = responses_frame(
        spark,
        [attempt("a", 1, 200, ok, start="20260101", end="20260131"),
         attempt("a", 1, 200, ok, start="20260201", end="20260228")],
    )
    assert latest_success(df).count() == 2


def test_classification_of_bodies_and_statuses(spark):
    cases = [
        ("s200", 200, '{"items":[]}', None, None),
        ("empty_obj", 200, "{}", None, None),
        ("items_null", 200, '{"items":null}', None, None),
        ("item_null", 200, '{"items":[null]}', None, None),
        ("json_null", 200, "null", None, "null_body"),
        ("array", 200, "[1]", None, "not_object"),
        ("junk", 200, "nope", None, "invalid_json"),
        ("empty", 200, "", None, "invalid_json"),
        ("sqlnull", 200, None, None, "invalid_json"),
        ("s404", 404, "{}", None, "http_error"),
        ("s500", 500, "{}", None, "http_error"),
        ("err", None, None, "API request failed", "request_error"),
        ("ws_obj", 200, ' \n {"items":[]}', None, None),
        # as Python's json module reads text
        ("single_quotes", 200, "{'items':[]}", None, "invalid_json"),
        ("trailing_comma", 200, '{"items":[],}', None, "invalid_json"),
        ("truncated", 200, '{"items":[]', None, "invalid_json"),
        ("ctrl_char", 200, '{"a":"\u0001"}', None, "invalid_json"),
        ("repeated_key", 200, '{"a":1,"a":2}', None, None),
        ("nan", 200, '{"a":NaN}', None, None),
        ("type_problem", 200, '{"items":[{"views":"x"}]}', None, None),
        ("string", 200, '"str"', None, "not_object"),
        ("number", 200, "3", None, "not_object"),
        # text after the object is rejected, whatever it is
        ("trailing_text", 200, '{"items":[]} xyz', None, "invalid_json"),
        ("trailing_ws", 200, '{"items":[]}\n\t ', None, None),
        ("two_objects", 200, '{"items":[]} {"a":1}', None, "invalid_json"),
        ("comma_object", 200, '{"items":[]},{"a":1}', None, "invalid_json"),
        ("extra_brace", 200, '{"items":[]}}', None, "invalid_json"),
        ("text_and_brace", 200, '{"items":[]} oops}', None, "invalid_json"),
        ("closed_early", 200, '{"items":[]}],[{}', None, "invalid_json"),
        ("bracket_end", 200, '{"items":[]}]', None, "invalid_json"),
        ("repeated_then_text", 200, '{"a":1,"a":2} {}', None, "invalid_json"),
        ("vertical_tab", 200, '\x0b{"items":[]}', None, "invalid_json"),
    ]
    df = responses_frame(spark, [attempt(t, 1, s, b, e) for t, s, b, e, _ in cases])
    got = {r["title"]: (r["reason"], r["fetched"]) for r in classify_attempts(df).collect()}
    for title, _, _, _, reason in cases:
        assert got[title] == (reason, reason is None), title
    # the filter of latest_success agrees with the classification
    assert {r["title"] for r in latest_success(df).collect()} == {t for t, *_, reason in cases if reason is None}


def test_missing_and_equal_attempt_numbers(spark):
    one, two = '{"items":[{"views":1}]}', '{"items":[{"views":2}]}'
    df = responses_frame(
        spark,
        [
            attempt("only_null", None, 200, one),
            attempt("null_and_number", None, 200, two),
            attempt("null_and_number", 0, 200, one),
            attempt("tie", 3, 200, one),
            attempt("tie", 3, 200, two),
        ],
    )
    want = {"only_null": (None, one), "null_and_number": (0, one), "tie": (3, two)}
    for parts in (1, 4):
        got = {r["title"]: (r["attempt_no"], r["body"]) for r in latest_success(df.repartition(parts)).collect()}
        assert got == want
    assert {r["title"]: r["outcome"] for r in fetch_outcome(df).collect()} == dict.fromkeys(want, "FETCHED")


FIXED_TITLES = [
    "The_Witcher_3:_Wild_Hunt",
    "Fortnite_(video_game)",
    "a b/c*~+!",
    "é日",
    "100%_Orange_Juice",
    "x%7Ey",
]


def _encode_all(spark, titles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id int, title string")
    plan = request_plan(df, start_date="20260101", end_date="20260131", keep=["id"])
    return {r["id"]: r["request_url"] for r in plan.collect()}


def _expected_url(title):
    return (
        "https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article/en.wikipedia.org/"
        f"all-access/user/{quote(title, safe='')}/daily/20260101/20260131"
    )


def test_request_url_matches_python_quote(spark):
    got = _encode_all(spark, FIXED_TITLES)
    for i, t in enumerate(FIXED_TITLES):
        assert got[i] == _expected_url(t), t


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=20), min_size=1, max_size=60))
def test_percent_encoding_property(spark, titles):
    # surrogates cannot be UTF-8 encoded by either side; skip them
    titles = [t for t in titles if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)]
    if not titles:
        return
    got = _encode_all(spark, titles)
    for i, t in enumerate(titles):
        assert got[i] == _expected_url(t), repr(t)


def test_request_plan_columns(spark):
    df = spark.createDataFrame([("Minecraft",)], "title string")
    out = request_plan(df, start_date=F.lit("20260101"), end_date=F.lit("20260102"))
    assert out.columns == ["request_url"]
    assert rows(out) == [(_expected_url("Minecraft").replace("20260131", "20260102"),)]
