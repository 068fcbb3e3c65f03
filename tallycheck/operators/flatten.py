"""Nested responses to flat records.

A body is read as an array of item texts, and each item on its own with the
item schema: an absent field is NULL, extra fields are dropped, and a value
that does not fit its type (``views`` as ``"7"``, ``"x"`` or ``1.0``) becomes
NULL while the item's other fields stay. An element that is not an object
gives no record and leaves its siblings alone. ``explode`` drops absent, null
and empty ``items``; null items are filtered. The request title is not
copied: ``article`` comes from the item. Everything is a per-row projection,
so it runs where the responses are, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck.schemas import CORRUPT_COLUMN, PARSED_ITEM_SCHEMA, RECORD_COLUMNS, RESPONSE_BODY_SCHEMA

# Strict JSON text as Python's json module reads it: no single quotes, no
# comments, no unquoted names (NaN/Infinity and repeated keys are accepted).
JSON_OPTIONS = {"allowSingleQuotes": "false"}
_PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, **JSON_OPTIONS}


def parse_body(body: str = "body") -> Column:
    """``from_json`` of a body into ``items`` (texts) plus ``_corrupt_record``."""
    return F.from_json(F.col(body), RESPONSE_BODY_SCHEMA, _PARSE_OPTIONS)


def parse_item(item: Column) -> Column:
    """``from_json`` of an item's text into the record fields plus ``_corrupt_record``."""
    return F.from_json(item, PARSED_ITEM_SCHEMA, _PARSE_OPTIONS)


def _is_object(item: Column) -> Column:
    return item.startswith("{")


def flatten_responses(responses: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One record per object among the items of every response body (RECORD_SCHEMA), then the columns ``keep`` of its response."""
    items = responses.select(*keep, F.explode(parse_body(body)["items"]).alias("item"))
    parsed = items.filter(_is_object(F.col("item"))).select(*keep, parse_item(F.col("item")).alias("item"))
    return parsed.select(*[F.col("item")[c].alias(c) for c in RECORD_COLUMNS], *keep)


def quarantine_items(responses: DataFrame, body: str = "body") -> DataFrame:
    """The columns of ``responses`` but the body, and ``item_no`` and ``item`` (text) of every item that does
    not fit the schema: not an object, or a value of another type. A body that does not fit
    as a whole (no object, ``items`` not an array) is one row with ``item_no`` NULL and the body as ``item``.
    """
    kept = [c for c in responses.columns if c != body]
    parsed = responses.select(*kept, F.col(body).alias("_body"), parse_body(body).alias("_parsed"))
    whole = parsed.filter(F.col("_parsed")[CORRUPT_COLUMN].isNotNull()).select(
        *kept, F.lit(None).cast("int").alias("item_no"), F.col("_body").alias("item")
    )
    each = parsed.select(*kept, F.posexplode(F.col("_parsed")["items"]).alias("item_no", "item"))
    misfit = ~_is_object(F.col("item")) | parse_item(F.col("item"))[CORRUPT_COLUMN].isNotNull()
    return whole.unionByName(each.filter(F.col("item").isNotNull() & misfit))


def quarantine(responses: DataFrame, body: str = "body") -> DataFrame:
    """Bodies with an item that did not fit the schema, or that did not fit as a whole.

    What fits is still flattened, with NULL in a bad field; this frame lists
    the bodies so they can be inspected or re-fetched.
    """
    parsed = parse_body(body)
    item_misfit = F.exists(
        parsed["items"], lambda x: x.isNotNull() & (~_is_object(x) | parse_item(x)[CORRUPT_COLUMN].isNotNull())
    )
    return responses.filter(parsed[CORRUPT_COLUMN].isNotNull() | F.coalesce(item_misfit, F.lit(False)))
