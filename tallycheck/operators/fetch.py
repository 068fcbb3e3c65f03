"""Fetch attempts: request planning, outcome classification, one response per request.

HTTP is not done here: responses land as rows (title, window, page,
attempt_no, status_code, body, error) and Spark classifies and deduplicates
them. Every aggregate here is per request key and combines map-side, so a
title with a third of all attempts still leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck.functions.text import request_url
from tallycheck.operators.flatten import JSON_OPTIONS

REQUEST_KEYS = ("title", "start_date", "end_date", "page")

# Failure reasons, in the order they are tested.
REASON_REQUEST_ERROR = "request_error"
REASON_HTTP_ERROR = "http_error"
REASON_INVALID_JSON = "invalid_json"
REASON_NULL_BODY = "null_body"
REASON_NOT_OBJECT = "not_object"

FETCHED = "FETCHED"
FAILED = "FAILED"


def present_keys(df: DataFrame, keys: Sequence[str] = REQUEST_KEYS) -> list[str]:
    """Request key columns that exist in ``df`` (page and window are optional)."""
    return [k for k in keys if k in df.columns]


def transport_failure(status_code: str = "status_code", error: str = "error") -> Column:
    """Failure known without reading the body: a request error or a 4xx/5xx."""
    return F.when(F.col(error).isNotNull(), F.lit(REASON_REQUEST_ERROR)).when(
        F.col(status_code).between(400, 599), F.lit(REASON_HTTP_ERROR)
    )


def valid_json(body: str = "body") -> Column:
    """Whether a body is one JSON text as Python's json module reads it, nothing after it.

    The body is wrapped as ``[body, "hash of body"]``. Only if the body is one
    complete value is the second element the hash: text after the value, a
    second value or a closing bracket puts something else there or breaks
    the array. The variant parse settles almost every body; it rejects
    repeated keys and NaN/Infinity, which json accepts, so bodies that it
    rejects get a second, schema-free parse. The parse stands once in the
    expression, so a filter on it parses a body once.
    """
    text = F.col(body)
    mark = F.md5(text)
    wrapped = F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))
    settled = F.try_variant_get(F.try_parse_json(wrapped), "$[1]", "string") == mark
    second = F.get(F.from_json(wrapped, "array<string>", JSON_OPTIONS), F.lit(1)) == mark
    return F.coalesce(settled, F.lit(False)) | F.coalesce(second, F.lit(False))


def object_shaped(body: str = "body") -> Column:
    """A valid JSON text is an object exactly when its first non-blank character is ``{``."""
    return F.ltrim(F.col(body), F.lit(" \t\n\r")).startswith("{")


def is_fetched() -> Column:
    """Whether an attempt delivered a JSON object; the cheap tests come first."""
    tail = F.rtrim(F.col("body"), F.lit(" \t\n\r")).endswith("}")
    return transport_failure().isNull() & F.coalesce(object_shaped() & tail, F.lit(False)) & valid_json()


def body_failure(body: str = "body") -> Column:
    """Failure of a delivered body, or NULL when it is a JSON object."""
    text = F.col(body)
    return (
        F.when(text.isNull() | ~valid_json(body), F.lit(REASON_INVALID_JSON))
        .when(F.trim(text, F.lit(" \t\n\r")) == "null", F.lit(REASON_NULL_BODY))
        .when(~object_shaped(body), F.lit(REASON_NOT_OBJECT))
    )


def classify_attempts(responses: DataFrame) -> DataFrame:
    """Attempts with ``reason`` (NULL when fetched) and ``fetched`` added.

    A body is parsed only when the transport succeeded.
    """
    return responses.withColumn("reason", F.coalesce(transport_failure(), body_failure())).withColumn(
        "fetched", F.col("reason").isNull()
    )


def latest_success(responses: DataFrame, keys: Sequence[str] = REQUEST_KEYS) -> DataFrame:
    """One body per request: the successful attempt with the highest number.

    A later success replaces an earlier one; a later failure does not. A NULL
    attempt number is below every other; of attempts with equal numbers the
    greatest body wins, so reruns agree. Requests without any success are
    absent. The buffer holds a string, so Spark plans a sort-based aggregate.
    That sort spills to disk when it must, and the partial step before the
    shuffle leaves one row per request per map task, however many attempts a
    request has.
    """
    ks = present_keys(responses, keys)
    ok = responses.filter(is_fetched())
    best = ok.groupBy(*ks).agg(F.max(F.struct("attempt_no", "body")).alias("_best"))
    return best.select(*ks, "_best.attempt_no", "_best.body")


def fetch_outcome(responses: DataFrame, keys: Sequence[str] = REQUEST_KEYS) -> DataFrame:
    """Per request: FETCHED if any attempt succeeded, else FAILED; attempt count."""
    ks = present_keys(responses, keys)
    return (
        classify_attempts(responses)
        .groupBy(*ks)
        .agg(F.bool_or("fetched").alias("_ok"), F.count(F.lit(1)).alias("attempts"))
        .select(
            *ks,
            F.when(F.col("_ok"), F.lit(FETCHED)).otherwise(F.lit(FAILED)).alias("outcome"),
            "attempts",
        )
    )


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    """One row: requested and fetched request counts."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("outcome") == FETCHED).alias("fetched"),
    )


def request_plan(
    requests: DataFrame,
    title_col: str = "title",
    start_date: str | Column = "start_date",
    end_date: str | Column = "end_date",
    keep: Sequence[str] = (),
    **url_parts: str,
) -> DataFrame:
    """Request URL per title row; ``keep`` carries id columns along."""

    def as_col(x: str | Column) -> Column:
        if isinstance(x, Column):
            return x
        return F.col(x) if x in requests.columns else F.lit(x)

    return requests.select(
        *keep,
        request_url(F.col(title_col), as_col(start_date), as_col(end_date), **url_parts).alias(
            "request_url"
        ),
    )
