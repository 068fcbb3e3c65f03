"""Request windows per row: bounds, merging, coverage of what was requested."""

import random
from datetime import date, timedelta

import pytest

from tallycheck.functions.dates import check_bound, parse_bound
from tallycheck.operators.windows import BAD_END, BAD_START, REVERSED, merged_windows, rejected_windows, requested_grid, requested_tally, window_plan
from tests.conftest import rows

SCHEMA = "title string, start_date string, end_date string"


def text(day):
    return day.strftime("%Y%m%d")


def test_bounds_follow_the_parameter_form(spark):
    odd = ["20240229", "20230229", "20241301", "2024010", "202401011", "2024-01-01", " 20240101", "20240101\n", "00000101", "00010101", "99991231", "", "abcdefgh", "２０２４０１０１"]
    frame = spark.createDataFrame([(x,) for x in odd] + [(None,)], "s string")
    got = {r.s: r.d for r in frame.select("s", parse_bound("s").alias("d")).collect()}
    assert got[None] is None
    for x in odd:
        try:
            want = check_bound(x) if x.isascii() and not x.endswith("\n") else None
        except ValueError:
            want = None
        assert got[x] == want, x


def test_rejected_rows_keep_their_columns(spark):
    data = [("A", "20240101", "20240102", 1), ("A", "2024-01-01", "x", 2), (None, "20240101", None, 3), ("B", "20240103", "20240102", 4), ("B", None, "20240102", 5)]
    got = rejected_windows(spark.createDataFrame(data, SCHEMA + ", reason int"))
    assert got.columns == ["title", "start_date", "end_date", "reason"]
    assert rows(got) == sorted(
        [("A", "2024-01-01", "x", BAD_START), (None, "20240101", None, BAD_END), ("B", "20240103", "20240102", REVERSED), ("B", None, "20240102", BAD_START)], key=repr
    )


def test_merging(spark):
    data = [
        ("A", "20240101", "20240110"), ("A", "20240103", "20240104"), ("A", "20240108", "20240112"), ("A", "20240113", "20240113"),
        ("A", "20240115", "20240115"), ("A", "20240115", "20240115"), ("A", "bad", "20240131"), (None, "20240228", "20240301"),
    ]
    got = merged_windows(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert rows(got) == sorted(
        [("A", date(2024, 1, 1), date(2024, 1, 13)), ("A", date(2024, 1, 15), date(2024, 1, 15)), (None, date(2024, 2, 28), date(2024, 3, 1))], key=repr
    )
    assert requested_grid(got).filter("article is null").count() == 3
    plan = {(r.title, r.start_date, r.request_url and r.request_url[-20:]) for r in window_plan(got).collect()}
    assert ("A", "20240101", "ly/20240101/20240113") in plan and (None, "20240228", None) in plan


@pytest.mark.parametrize("seed", range(4))
def test_against_sets_of_days(spark, seed):
    rng = random.Random(seed)
    first = date(2023, 12, 1)
    asked, data = set(), []
    for _ in range(120):
        title, at, size = rng.choice(["A", "A", "A", "B", None]), rng.randint(0, 300), rng.randint(-1, 6)
        data.append((title, text(first + timedelta(at)), text(first + timedelta(at + size))))
        asked |= {(title, first + timedelta(k)) for k in range(at, at + size + 1)}
    keys = [(rng.choice(["A", "B", "C", None]), rng.choice([text(first + timedelta(rng.randint(0, 310))) + "00", None, "x"])) for _ in range(300)]
    merged = merged_windows(spark.createDataFrame(data, SCHEMA).repartition(5))
    runs = sorted(((r.title or "", r.first_day, r.last_day) for r in merged.collect()))
    assert all(a[0] != b[0] or a[2] + timedelta(1) < b[1] for a, b in zip(runs, runs[1:]))
    wanted = {(t, text(d) + "00") for t, d in asked}
    assert sorted(rows(requested_grid(merged)), key=repr) == sorted(wanted, key=repr)
    here = {k for k in keys if None not in k}
    tally = requested_tally(spark.createDataFrame(keys, "article string, timestamp string"), merged).first()
    assert tuple(tally) == (len(wanted), len(wanted - here), len(here - wanted))


def test_a_hot_title_leaves_one_row_per_first_day(spark):
    hot = spark.range(0, 20_000, 1, 4).selectExpr("'hot' as title", "date_format(date_add(date'2024-01-01', cast(id % 10 * 20 as int)), 'yyyyMMdd') as start_date",
                                                  "date_format(date_add(date'2024-01-01', cast(id % 10 * 20 + id % 7 as int)), 'yyyyMMdd') as end_date")
    merged = merged_windows(hot)
    assert merged.count() == 10 and merged.selectExpr("sum(datediff(last_day, first_day) + 1) as d").first().d == 70
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Join" not in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merged_windows(none).count() == rejected_windows(none).count() == 0
    bronze = spark.createDataFrame([("A", "2024010100")], "article string, timestamp string")
    assert tuple(requested_tally(bronze, merged_windows(none)).first()) == (0, 0, 1)
