"""Source coverage: which expected (article, day) combinations have no row.

Plan shape, chosen for a large Bronze table and a hot-key distribution:

* ``key_counts``: one ``groupBy(keys).count()``. Spark aggregates map-side
  first, so a key holding a third of all rows leaves each map task as one
  row; only distinct keys cross the shuffle.
* ``expected_grid``: every title row explodes its own day spine
  (``explode(sequence(start, end))``). No cross join and no driver-side day
  list; the grid is partitioned like the titles.
* ``missing_coverage``: grid ``left_anti`` tally on both keys. The tally is
  already hash-partitioned on the keys by its aggregate, so only the grid
  moves. AQE turns it into a broadcast join when the measured tally is small.
* ``coverage_tally`` / ``run_tally``: counts without any join. Bronze rows
  and weighted grid keys are unioned and summed per key in one exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycheck.constants import BUSINESS_KEYS, CHECK_COVERAGE, MISMATCH_SEPARATOR, WARN
from tallycheck.functions.dates import check_range, day_spine, day_stamp, stamp_range
from tallycheck.functions.status import status_from_count


NO_TITLES = "the title list is empty; coverage needs at least one title"


class CheckOutput(NamedTuple):
    """One-row result of a check and the rows that fail it (both lazy)."""

    result: DataFrame
    failing: DataFrame


def titles_frame(
    spark: SparkSession, titles: Iterable[str | None] | DataFrame, title_key: str = "article"
) -> DataFrame:
    """Titles as a one-column DataFrame named ``title_key``.

    A DataFrame is taken as is (first column, renamed), so a title list kept
    as a table is read by the executors; the tally refuses an empty one. A Python list is for small configs.
    Titles are not deduplicated: a title listed twice is expected twice.
    """
    if isinstance(titles, DataFrame):
        first = titles.columns[0]
        return titles.select(F.col(first).cast("string").alias(title_key))
    rows = [(t,) for t in titles]
    if not rows:
        raise ValueError(NO_TITLES)
    schema = T.StructType([T.StructField(title_key, T.StringType())])
    return spark.createDataFrame(rows, schema)


def expected_grid(
    titles: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = BUSINESS_KEYS,
) -> DataFrame:
    """Every title paired with every day of the range (title order kept, no dedup)."""
    title_key, day_key = keys
    check_range(start, end)
    return titles.select(
        F.col(titles.columns[0]).alias(title_key), F.explode(day_spine(start, end)).alias("_day")
    ).select(title_key, day_stamp("_day").alias(day_key))


def key_counts(df: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """Rows per business key; null keys group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def actual_keys(df: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """Distinct business keys present (duplicates collapse)."""
    return df.select(*keys).distinct()


def in_range(df: DataFrame, start: str, end: str, day_key: str = "timestamp") -> DataFrame:
    """Rows whose day stamp can fall inside the range.

    Exact as a pre-filter for coverage: every grid stamp lies between the
    first and last stamp as strings, so no matching row is dropped. The
    comparison reaches the parquet scan as pushed filters.
    """
    lo, hi = stamp_range(start, end)
    return df.filter(F.col(day_key).between(lo, hi))


def missing_coverage(
    grid: DataFrame, counts: DataFrame, keys: Sequence[str] = BUSINESS_KEYS
) -> DataFrame:
    """Expected combinations with no row. Null keys never match, so a null
    title in the grid is always missing and a null key in Bronze covers nothing."""
    return grid.join(counts.select(*keys), list(keys), "left_anti")


def weighted_grid(
    titles: DataFrame, start: str, end: str, keys: Sequence[str] = BUSINESS_KEYS
) -> DataFrame:
    """Distinct grid keys with ``_mult``, how often the title is listed.

    Titles are collapsed before the days are attached, so each grid key is
    one row and a title listed twice weighs 2.
    """
    title_key, day_key = keys
    check_range(start, end)
    listed = titles.groupBy(F.col(titles.columns[0]).alias(title_key)).agg(
        F.count(F.lit(1)).alias("_mult")
    )
    return listed.select(
        title_key, "_mult", F.explode(day_spine(start, end)).alias("_day")
    ).select(title_key, day_stamp("_day").alias(day_key), "_mult")


def key_presence(
    bronze: DataFrame,
    titles: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = BUSINESS_KEYS,
    weight: str | None = None,
) -> DataFrame:
    """Per key: ``_expected`` (grid weight) and ``_rows`` (Bronze rows; with ``weight``, the sum of that column).

    Bronze rows and weighted grid keys are tagged, unioned and summed in one
    ``groupBy(keys)``: both sides combine map-side (a hot key leaves each map
    task as one row) and cross a single exchange; no join, no sort. Keys
    with a NULL part are grouped apart per side (``_side``), so a NULL never
    counts as present, while repeated NULL keys in Bronze still group
    together as duplicates.
    """
    title_key, day_key = keys
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    rows = bronze.select(*keys, zero.alias("_g"), (F.col(weight) if weight else one).alias("_b"))
    grid = weighted_grid(titles, start, end, keys).select(
        *keys, F.col("_mult").alias("_g"), zero.alias("_b")
    )
    has_null = F.col(title_key).isNull() | F.col(day_key).isNull()
    tagged = rows.unionByName(grid).withColumn("_side", F.when(has_null, F.col("_g") > 0))
    return tagged.groupBy(*keys, "_side").agg(
        F.sum("_g").alias("_expected"), F.sum("_b").alias("_rows")
    )


def _tally_columns(with_duplicates: bool) -> list[Column]:
    expected, rows = F.col("_expected"), F.col("_rows")
    grid_size = F.sum(expected)
    missing = F.coalesce(F.sum(F.when(rows == 0, expected)), F.lit(0)).cast("bigint")
    no_titles = F.raise_error(F.lit(NO_TITLES)).cast("bigint")
    cols = [
        F.when(grid_size > 0, grid_size.cast("bigint")).otherwise(no_titles).alias("expected_count"),
        F.when(grid_size > 0, missing).otherwise(no_titles).alias("missing_count"),
    ]
    if with_duplicates:
        cols.append(F.count_if(rows > 1).alias("duplicate_count"))
    return cols


def coverage_tally(
    bronze: DataFrame,
    titles: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = BUSINESS_KEYS,
) -> DataFrame:
    """One row: ``expected_count`` (grid size) and ``missing_count``."""
    return key_presence(bronze, titles, start, end, keys).agg(*_tally_columns(False))


def run_tally(
    bronze: DataFrame,
    titles: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = BUSINESS_KEYS,
    weight: str | None = None,
) -> DataFrame:
    """One row with ``expected_count``, ``missing_count`` and ``duplicate_count``.

    Coverage and duplicates from one pass over Bronze: one scan, one
    exchange, hash aggregates only.
    """
    return key_presence(bronze, titles, start, end, keys, weight).agg(*_tally_columns(True))


def coverage_result(missing_count_frame: DataFrame, severity: str = WARN) -> DataFrame:
    """``check_name, status, missing_count`` from a frame with ``missing_count``."""
    return missing_count_frame.select(
        F.lit(CHECK_COVERAGE).alias("check_name"),
        status_from_count("missing_count", severity).alias("status"),
        F.col("missing_count"),
    )


def missing_by_article(missing: DataFrame, keys: Sequence[str] = BUSINESS_KEYS) -> DataFrame:
    """Affected days per title, each once, sorted and joined with ``"; "``.

    ``collect_set`` keeps each day once, in the map-side buffer too, so a
    group never holds more entries than the checked range has days, however
    often a title is listed.
    """
    title_key, day_key = keys
    return missing.groupBy(title_key).agg(
        F.array_join(F.array_sort(F.collect_set(day_key)), MISMATCH_SEPARATOR).alias("details")
    )


def check_coverage(
    df: DataFrame,
    titles: DataFrame | Iterable[str | None],
    start: str,
    end: str,
    keys: Sequence[str] = BUSINESS_KEYS,
    severity: str = WARN,
) -> CheckOutput:
    """Coverage check over the rows of the range (a pushed-down filter).

    ``titles`` is a one-column DataFrame or a plain list of titles. The
    result comes from the union-aggregate tally; the failing rows from the
    anti join of the grid with the key tally.
    """
    if not isinstance(titles, DataFrame):
        titles = titles_frame(df.sparkSession, titles, keys[0])
    rows = in_range(df, start, end, keys[1])
    tally = coverage_tally(rows, titles, start, end, keys)
    failing = missing_coverage(expected_grid(titles, start, end, keys), key_counts(rows, keys), keys)
    return CheckOutput(result=coverage_result(tally, severity), failing=failing)
