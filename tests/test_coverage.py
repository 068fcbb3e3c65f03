"""Coverage: expected (article, day) grid vs. keys present."""

import random

import pytest

from tallycheck.operators.coverage import (
    check_coverage,
    coverage_tally,
    expected_grid,
    key_counts,
    missing_by_article,
    missing_coverage,
    run_tally,
    titles_frame,
)
from tallycheck.operators.duplicates import check_duplicates
from tests.conftest import rows

KEYS = "article string, timestamp string"


def keys_df(spark, pairs):
    return spark.createDataFrame(pairs, KEYS)


def test_one_day_missing(spark):
    bronze = keys_df(spark, [("Minecraft", "2026010100"), ("Minecraft", "2026010300")])
    out = check_coverage(bronze, titles_frame(spark, ["Minecraft"]), "20260101", "20260103")
    assert rows(out.failing) == [("Minecraft", "2026010200")]
    r = out.result.collect()[0]
    assert (r["check_name"], r["status"], r["missing_count"]) == ("source_coverage", "WARN", 1)


def test_full_coverage_passes_and_duplicates_do_not_matter(spark):
    bronze = keys_df(spark, [("Minecraft", "2026010100"), ("Minecraft", "2026010100")])
    out = check_coverage(bronze, titles_frame(spark, ["Minecraft"]), "20260101", "20260101")
    assert out.failing.count() == 0
    assert tuple(out.result.collect()[0]) == ("source_coverage", "PASS", 0)


def test_inclusive_range(spark):
    one = titles_frame(spark, ["t"])
    days = expected_grid(one, "20260101", "20260103").select("timestamp")
    assert rows(days) == [("2026010100",), ("2026010200",), ("2026010300",)]
    assert expected_grid(one, "20260105", "20260105").count() == 1


def test_full_grid_is_310(spark):
    titles = titles_frame(spark, [f"t{i}" for i in range(10)])
    grid = expected_grid(titles, "20260101", "20260131")
    assert grid.count() == 310
    assert grid.columns == ["article", "timestamp"]


def test_month_end_and_leap_day(spark):
    grid = expected_grid(titles_frame(spark, ["t"]), "20240227", "20240302")
    days = sorted(r["timestamp"] for r in grid.collect())
    assert days == ["2024022700", "2024022800", "2024022900", "2024030100", "2024030200"]


@pytest.mark.parametrize(
    "start,end",
    [("20260102", "20260101"), ("2026011", "20260131"), ("20260230", "20260301"), ("2026-01-01", "20260102")],
)
def test_bad_ranges_raise(spark, start, end):
    with pytest.raises(ValueError):
        expected_grid(titles_frame(spark, ["a"]), start, end)


def test_empty_title_list_raises(spark):
    with pytest.raises(ValueError):
        titles_frame(spark, [])


def test_null_keys(spark):
    # null article in the grid is always missing; null in Bronze covers nothing
    bronze = keys_df(spark, [(None, "2026010100"), ("a", "2026010100")])
    titles = titles_frame(spark, ["a", None])
    out = check_coverage(bronze, titles, "20260101", "20260101")
    assert rows(out.failing) == [(None, "2026010100")]


def test_title_listed_twice_counts_twice(spark):
    bronze = keys_df(spark, [("a", "2026010100")])
    titles = titles_frame(spark, ["a", "a", "b"])
    out = check_coverage(bronze, titles, "20260101", "20260102")
    assert out.result.collect()[0]["missing_count"] == 4  # a/02 twice, b/01, b/02
    by = {r["article"]: r["details"] for r in missing_by_article(out.failing).collect()}
    assert by == {"a": "2026010200", "b": "2026010100; 2026010200"}


def test_keys_outside_grid_are_ignored(spark):
    bronze = keys_df(spark, [("zzz", "2026010100"), ("a", "2025123100"), ("a", "2026010100")])
    out = check_coverage(bronze, titles_frame(spark, ["a"]), "20260101", "20260101")
    assert out.failing.count() == 0


def test_titles_from_a_table(spark):
    titles = spark.createDataFrame([("x",), ("y",)], "name string")
    bronze = keys_df(spark, [("x", "2026010100")])
    out = check_coverage(bronze, titles_frame(spark, titles), "20260101", "20260101")
    assert rows(out.failing) == [("y", "2026010100")]


def _random_case(spark, seed):
    rnd = random.Random(seed)
    arts = ["a", "b", "c", None]
    stamps = [f"202601{d:02d}00" for d in range(1, 6)] + ["2025123100", None]
    bronze = keys_df(spark, [(rnd.choice(arts), rnd.choice(stamps)) for _ in range(rnd.randint(0, 40))])
    titles = titles_frame(spark, [rnd.choice(arts) for _ in range(rnd.randint(1, 6))])
    return bronze, titles


@pytest.mark.parametrize("seed", range(6))
def test_single_pass_tally_equals_separate_checks(spark, seed):
    bronze, titles = _random_case(spark, seed)
    counts = key_counts(bronze)
    one = run_tally(bronze, titles, "20260101", "20260104").collect()[0]
    cov = coverage_tally(bronze, titles, "20260101", "20260104").collect()[0]
    grid = expected_grid(titles, "20260101", "20260104")
    anti_missing = missing_coverage(grid, counts).count()
    sep_dup = check_duplicates(bronze).result.collect()[0]["duplicate_count"]
    assert one["expected_count"] == grid.count() == cov["expected_count"]
    assert one["missing_count"] == cov["missing_count"] == anti_missing
    assert one["duplicate_count"] == sep_dup
    # invariant: missing + |grid ∩ actual| = |grid| (grid without repeats)
    distinct_grid = grid.distinct()
    present = distinct_grid.join(counts.select("article", "timestamp"), ["article", "timestamp"], "left_semi")
    assert missing_coverage(distinct_grid, counts).count() + present.count() == distinct_grid.count()


def test_adding_a_duplicate_never_changes_coverage(spark):
    bronze, titles = _random_case(spark, 11)
    before = check_coverage(bronze, titles, "20260101", "20260104").result.collect()[0]
    first = bronze.limit(1)
    after = check_coverage(bronze.unionByName(first), titles, "20260101", "20260104").result.collect()[0]
    assert before == after


def test_titles_as_a_plain_list(spark):
    bronze = keys_df(spark, [("Minecraft", "2026010100"), ("Minecraft", "2026010300")])
    out = check_coverage(bronze, ["Minecraft"], "20260101", "20260103")
    assert rows(out.failing) == [("Minecraft", "2026010200")]


def test_empty_titles_table_is_refused(spark):
    empty = spark.createDataFrame([], "article string")
    for bronze in (keys_df(spark, [("Minecraft", "2026010100")]), spark.createDataFrame([], "article string, timestamp string")):
        with pytest.raises(Exception, match="the title list is empty"):
            check_coverage(bronze, empty, "20260101", "20260101").result.collect()
