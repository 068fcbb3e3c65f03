"""Adapters from the driver's test tables to the engine's data model.

The test data has no pageview responses, so these derive them, with Spark,
from ``events``: every binding reads whole tables and grows with them.

* records:  one flat record per event (article = ``user_<id>``, day stamp of
  ``ts``, views = floor(value)).
* attempts: one fetch attempt per event (title = ``user_<id>``), some bodies
  with text around the JSON object.
* landed:   responses holding the records, in pages of up to 100 items of many
  articles, each page with an earlier superseded success, an HTTP error, the
  latest success and a later timeout, in no order.
* history:  an audit history, one run per day of events, one check per
  event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck.functions.dates import day_stamp

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

BINDING_PROJECT = "test.project"
BINDING_START = "20240101"
BINDING_END = "20240131"
PAGE_SIZE = 100


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _article(events: DataFrame) -> F.Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string"))


def records_from_events(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Flat records from events; ``carry`` keeps extra event columns along."""
    cols = [
        F.lit(BINDING_PROJECT).alias("project"),
        _article(events).alias("article"),
        F.lit("daily").alias("granularity"),
        day_stamp(F.col("ts")).alias("timestamp"),
        F.floor("value").cast("bigint").alias("views"),
    ]
    return events.select(*cols, *carry)


def requests_from_events(events: DataFrame) -> DataFrame:
    """A request per event: from its day on, up to four days more; by event id some bounds are dashed, no day, reversed or NULL."""
    day, form = F.to_date("ts"), F.col("event_id")
    start = (
        F.when(form % 17 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form % 29 == 0, F.lit("20240231"))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    last = F.when(form % 19 == 0, F.date_sub(day, 3)).otherwise(F.date_add(day, (form % 5).cast("int")))
    end = F.when(form % 23 != 0, F.date_format(last, "yyyyMMdd"))
    return events.select("event_id", _article(events).alias("title"), start.alias("start_date"), end.alias("end_date"))


def attempts_from_events(events: DataFrame) -> DataFrame:
    """Fetch attempts: event_type 'error' or a user id divisible by 7 fails with 500.

    Bodies are ``props``, by event id also with text after it, twice, in a
    list, or between white space.
    """
    failed = (F.col("event_type") == "error") | (F.col("user_id") % 7 == 0)
    props, form = F.col("props"), F.col("event_id") % 8
    body = (
        F.when(form == 1, F.concat(props, F.lit(" oops}")))
        .when(form == 2, F.concat(props, F.lit(","), props))
        .when(form == 3, F.concat(F.lit("["), props, F.lit("]")))
        .when(form == 4, F.concat(F.lit(" \n"), props, F.lit("\t ")))
        .when(form == 5, F.concat(props, F.lit("}")))
        .otherwise(props)
    )
    return events.select(
        _article(events).alias("title"),
        F.lit(BINDING_START).alias("start_date"),
        F.lit(BINDING_END).alias("end_date"),
        F.lit(None).cast("bigint").alias("page"),
        F.col("event_id").alias("attempt_no"),
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        body.alias("body"),
        F.lit(None).cast("string").alias("error"),
    )


def _paged(items: DataFrame) -> DataFrame:
    """(title, page, body) from (page, item): item texts joined to one body per page.

    ``event_id`` is unique in ``events``, so a page holds at most 100 events
    whatever the key distribution. collect_list does not shrink data
    map-side, so rows are hash-partitioned on the page first: the list
    building runs in the parallel reduce stage.
    """
    bodies = (
        items.repartition("page")
        .groupBy("page")
        .agg(F.concat(F.lit('{"items":['), F.array_join(F.collect_list("item"), ","), F.lit("]}")).alias("body"))
    )
    return bodies.select(F.concat(F.lit("batch_"), F.col("page").cast("string")).alias("title"), "page", "body")


def landed_pages(events: DataFrame) -> DataFrame:
    """One successful response body per 100 event ids; the title is the batch, the articles are the users."""
    recs = records_from_events(events, carry=("event_id",))
    item = F.to_json(F.struct("project", "article", "granularity", "timestamp", "views"))
    return _paged(recs.select(F.expr(f"event_id div {PAGE_SIZE}").alias("page"), item.alias("item")))


def landed_pages_mistyped(events: DataFrame) -> DataFrame:
    """Like :func:`landed_pages`, but items of ``error`` events carry
    ``views`` as a JSON string (``"views":"12"``), a type drift in the source,
    and every event id divisible by 50 is a bare number instead of an item.
    """
    recs = records_from_events(events, carry=("event_id", "event_type"))
    keys = ("project", "article", "granularity", "timestamp")
    as_number = F.to_json(F.struct(*keys, "views"))
    as_text = F.to_json(F.struct(*keys, F.col("views").cast("string").alias("views")))
    item = (
        F.when(F.col("event_id") % 50 == 0, F.col("event_id").cast("string"))
        .when(F.col("event_type") == "error", as_text)
        .otherwise(as_number)
    )
    return _paged(recs.select(F.expr(f"event_id div {PAGE_SIZE}").alias("page"), item.alias("item")))


def landed_attempts(events: DataFrame) -> DataFrame:
    """Four attempts per page, dealt out evenly: stale success, HTTP 503, latest success, timeout."""
    pages = landed_pages(events)

    def attempt(no: int, status, body, error) -> F.Column:
        return F.struct(
            F.lit(no).cast("bigint").alias("attempt_no"),
            status.cast("int").alias("status_code"),
            body.cast("string").alias("body"),
            error.cast("string").alias("error"),
        )

    none = F.lit(None)
    attempts = F.array(
        attempt(1, F.lit(200), F.lit('{"items":[]}'), none),
        attempt(2, F.lit(503), none, none),
        attempt(3, F.lit(200), F.col("body"), none),
        attempt(4, none, none, F.lit("read timeout")),
    )
    landed = pages.select(
        "title",
        F.lit(BINDING_START).alias("start_date"),
        F.lit(BINDING_END).alias("end_date"),
        "page",
        F.inline(attempts),
    )
    # landed files are in no order, so what reads them shuffles for itself
    return landed.hint("rebalance")


def drifting_props(events: DataFrame) -> DataFrame:
    """(props): a JSON object per event whose values change their types from row to row, as feeds do.

    ``amount`` is a whole number, a decimal, or a number with an exponent; ``label`` a text or a number, ``ratio`` a decimal,
    ``flag`` a boolean, null or absent; ``pos`` an object with fields of its own, ``vals`` a list. Some rows have a name of their own, some are cut off
    or no JSON.
    """
    number, event = F.col("value").cast("decimal(12,2)").cast("string"), F.col("event_id")
    amount = F.when(event % 4 == 0, F.floor("value").cast("string")).when(event % 4 == 1, F.concat(number, F.lit("e0"))).otherwise(number)
    label = F.when(event % 5 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
    flag = F.when(event % 3 == 0, F.lit(',"flag":true')).when(event % 3 == 1, F.lit(',"flag":null')).otherwise(F.lit(""))
    pos = F.concat(F.lit(',"pos":{"x":'), F.col("user_id").cast("string"), F.lit(',"y":'), F.when(event % 7 == 0, F.lit('"n/a"')).otherwise(number), F.lit(',"z":1}'))
    vals = F.concat(F.lit(',"vals":['), number, F.lit(","), F.floor("value").cast("string"), F.when(event % 11 == 0, F.lit(",false")).otherwise(F.lit("")), F.lit("]"))
    extra = F.when(event % 13 == 0, F.concat(F.lit(',"new_'), (event % 3).cast("string"), F.lit('":0'))).otherwise(F.lit(""))
    body = F.concat(F.lit('{"id":'), event.cast("string"), F.lit(',"amount":'), amount, F.lit(',"label":'), label, F.lit(',"ratio":'), number, flag, pos, vals, extra)
    return events.select(F.when(event % 97 == 0, F.lit("gateway timeout")).when(event % 89 == 0, body).otherwise(F.concat(body, F.lit("}"))).alias("props"))


def audit_history(events: DataFrame) -> DataFrame:
    """A 9-column audit history: run = day, check = event type, status by count."""
    per = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return per.select(
        F.md5(F.col("day").cast("string")).alias("check_run_id"),
        F.lit("bronze").alias("layer"),
        F.lit("events").alias("table_name"),
        F.concat(F.lit("check_"), F.col("event_type")).alias("check_name"),
        F.when(F.col("n") < 60, "PASS").when(F.col("n") < 80, "WARN").otherwise("FAIL").alias(
            "check_status"
        ),
        F.lit("60").alias("expected_value"),
        F.col("n").cast("string").alias("actual_value"),
        F.concat(F.lit("events of type "), F.col("event_type"), F.lit(" on "),
                 F.col("day").cast("string")).alias("details"),
        F.col("day").cast("timestamp_ntz").alias("checked_at"),
    )
