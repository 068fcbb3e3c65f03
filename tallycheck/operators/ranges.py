"""Coverage by day bitmaps, and missing days as ranges.

``bitmap_tally`` answers the coverage check without a row per expected (title, day): a title's days are bits of 64-bit
words, counted from the first day, so a range of up to 64 days is one row per title in the shuffle, and each map task sends a title once.
``missing_ranges`` lists what is missing as runs of days (gaps and islands): within a title a day minus its rank is the same for
neighbouring days, so it names the run. A title's window never holds more rows than the checked range has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallycheck.constants import BUSINESS_KEYS
from tallycheck.functions.dates import check_range
from tallycheck.operators.coverage import in_range

#: Days in a word.
_WORD = 64


def _day_number(stamp: str, start: str) -> F.Column:
    """Days from the first day to a ``YYYYMMDD00`` stamp; NULL for any other text."""
    text = F.col(stamp)
    day = F.try_to_date(F.left(text, F.lit(8)), "yyyyMMdd")
    return F.when(text.rlike("^[0-9]{8}00$"), F.datediff(day, F.to_date(F.lit(start), "yyyyMMdd")))


def bitmap_tally(bronze: DataFrame, titles: DataFrame, start: str, end: str, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """One row, ``expected_count`` and ``missing_count``, as :func:`~tallycheck.operators.coverage.coverage_tally`; counts only.

    Titles (one column) may repeat; each listing is expected. A NULL title is never covered, and rows with a NULL key cover nothing. An empty
    title table is refused.
    """
    from tallycheck.operators.coverage import NO_TITLES

    title_key, day_key = keys
    check_range(start, end)
    first, last = (F.to_date(F.lit(x), "yyyyMMdd") for x in (start, end))
    days = F.datediff(last, first) + 1
    zero = F.lit(0).cast("long")
    number = _day_number(day_key, start)
    present = in_range(bronze, start, end, day_key).select(F.col(title_key).alias("title"), number.alias("day")).filter("title is not null and day is not null")
    bits = present.select("title", F.floor(F.col("day") / _WORD).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(day % {_WORD} as int))").alias("bits"), zero.alias("listed"))
    listed = titles.groupBy(F.col(titles.columns[0]).alias("title")).agg(F.count(F.lit(1)).alias("listed"))
    words = F.sequence(F.lit(0), F.floor((days - 1) / _WORD).cast("int"))
    wanted = listed.select("title", F.explode(words).alias("word"), zero.alias("bits"), "listed")
    merged = bits.unionByName(wanted).groupBy("title", "word").agg(F.bit_or("bits").alias("bits"), F.sum("listed").alias("listed"))
    size = F.least(F.lit(_WORD), days - F.col("word") * _WORD).cast("long")
    tally = merged.filter("listed > 0").agg(
        F.sum(F.col("listed") * size).alias("expected"), F.sum(F.col("listed") * (size - F.bit_count("bits"))).alias("missing")
    )
    refused = F.raise_error(F.lit(NO_TITLES)).cast("long")
    return tally.select(*[F.when(F.col("expected") > 0, F.col(c)).otherwise(refused).cast("long").alias(f"{c}_count") for c in ("expected", "missing")])


def missing_ranges(missing: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """Runs of missing days per title: the title, ``first_day``, ``last_day`` (stamps) and ``days``; nothing is capped.

    ``missing`` holds (title, day stamp) rows; repeated rows count once. Rows whose stamp is no day are left out.
    """
    title_key, day_key = keys
    day = F.when(F.col(day_key).rlike("^[0-9]{8}00$"), F.try_to_date(F.left(F.col(day_key), F.lit(8)), "yyyyMMdd"))
    once = missing.select(F.col(title_key), day.alias("_day")).filter("_day is not null").distinct()
    order = Window.partitionBy(title_key).orderBy("_day")
    runs = once.withColumn("_run", F.date_sub("_day", F.row_number().over(order)))
    found = runs.groupBy(title_key, "_run").agg(F.min("_day").alias("lo"), F.max("_day").alias("hi"), F.count(F.lit(1)).alias("days"))
    stamp = "yyyyMMdd'00'"
    return found.select(title_key, F.date_format("lo", stamp).alias("first_day"), F.date_format("hi", stamp).alias("last_day"), "days")
