"""Request windows per row: day bounds as columns, overlapping windows merged, coverage of what was requested.

A request is a row of (title, start, end), both bounds ``YYYYMMDD`` and inclusive. ``read_windows`` parses the bounds column-wise
by the rules of ``check_range``; rows that break them are kept with a reason (``rejected_windows``). ``merged_windows`` turns each title's overlapping or
touching windows into disjoint ones, so that no day is fetched or expected twice. ``requested_grid`` and ``requested_tally`` are the
expected grid and the coverage counts for such windows.

A title that holds a third of all requests leaves each map task with one row per first day: only the furthest end of a first day
matters, so the window function that merges never sees more rows of a title than there are days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallycheck.constants import BUSINESS_KEYS
from tallycheck.functions.dates import day_stamp, parse_bound
from tallycheck.functions.text import request_url

#: Why a request is rejected.
BAD_START = "start_date is not a YYYYMMDD day"
BAD_END = "end_date is not a YYYYMMDD day"
REVERSED = "start_date is after end_date"


def read_windows(requests: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """``requests`` with ``first_day`` and ``last_day`` (DATE, NULL where the text is no day) and ``reason`` (NULL if the row is a window).

    Columns of ``requests`` with these three names are replaced. A NULL bound is no day. The first rule that a row breaks is its reason.
    """
    first, last = parse_bound(start), parse_bound(end)
    reason = F.when(first.isNull(), BAD_START).when(last.isNull(), BAD_END).when(first > last, REVERSED)
    return requests.withColumns({"first_day": first, "last_day": last, "reason": reason})


def rejected_windows(requests: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The rows of ``requests`` that are no window, as they came, with ``reason``."""
    kept = [c for c in requests.columns if c != "reason"]
    return read_windows(requests, start, end).filter("reason is not null").select(*kept, "reason")


def merged_windows(requests: DataFrame, title: str = "title", start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Disjoint windows per title: ``title``, ``first_day``, ``last_day`` (DATE).

    Windows that overlap or follow each other without a day between are one. Rejected rows are left out. A NULL title is a title like any other.
    """
    good = read_windows(requests.select(F.col(title).alias("title"), F.col(start).alias("start_date"), F.col(end).alias("end_date")))
    reach = good.filter("reason is null").groupBy("title", "first_day").agg(F.max("last_day").alias("last_day"))
    ordered = Window.partitionBy("title").orderBy("first_day")
    before = F.max("last_day").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("first_day") > F.date_add(before, 1)), 1).otherwise(0)
    runs = reach.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(ordered))
    return runs.groupBy("title", "_run").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).drop("_run")


def window_plan(windows: DataFrame, **url_parts: str) -> DataFrame:
    """A request URL per merged window: ``title``, ``start_date``, ``end_date`` (``YYYYMMDD``) and ``request_url``."""
    bounds = windows.select("title", *[F.date_format(c, "yyyyMMdd").alias(n) for n, c in (("start_date", "first_day"), ("end_date", "last_day"))])
    return bounds.withColumn("request_url", request_url("title", "start_date", "end_date", **url_parts))


def requested_grid(windows: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """A row per title and day of its merged windows, named by ``keys``."""
    title_key, day_key = keys
    days = F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day")))
    return windows.select(F.col("title").alias(title_key), days.alias("_day")).select(title_key, day_stamp("_day").alias(day_key))


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def requested_tally(bronze: DataFrame, windows: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """One row: ``expected_count``, ``missing_count`` and ``unrequested_count`` (keys with rows that no window asks for).

    Grid and rows are tagged, unioned and merged by one aggregate: no join. A NULL in a key covers nothing: a NULL title's days are all
    missing, and Bronze rows with a NULL key are not counted. Without windows all counts of the grid are 0.
    """
    title_key, day_key = keys
    rows = bronze.select(*keys).filter(F.col(title_key).isNotNull() & F.col(day_key).isNotNull())
    tagged = rows.select(*keys, F.lit(False).alias("_asked"), F.lit(True).alias("_here")).unionByName(
        requested_grid(windows, keys).select(*keys, F.lit(True).alias("_asked"), F.lit(False).alias("_here"))
    )
    merged = tagged.groupBy(*keys).agg(F.bool_or("_asked").alias("asked"), F.bool_or("_here").alias("here"))
    asked, here = F.col("asked"), F.col("here")
    return merged.agg(_count(asked, "expected_count"), _count(asked & ~here, "missing_count"), _count(here & ~asked, "unrequested_count"))
