"""Property tests: the Spark tallies equal a brute force over random small inputs."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tallycheck.operators.coverage import (
    expected_grid,
    key_counts,
    missing_coverage,
    run_tally,
    titles_frame,
)
from tallycheck.operators.duplicates import duplicate_keys

ARTICLES = st.sampled_from(["a", "b", "c", None])
STAMPS = st.sampled_from(["2026010100", "2026010200", "2026010300", "2025123100", "20260101", None])
DAYS = ["2026010100", "2026010200", "2026010300"]


def brute(rows, titles):
    counts = Counter(rows)
    present = {k for k in counts if k[0] is not None and k[1] is not None}
    grid = [(t, d) for t in titles for d in DAYS]
    missing = [(t, d) for t, d in grid if t is None or (t, d) not in present]
    dups = {k: c for k, c in counts.items() if c > 1}
    return len(grid), missing, dups


@settings(max_examples=12, deadline=None)
@given(
    rows=st.lists(st.tuples(ARTICLES, STAMPS), max_size=25),
    titles=st.lists(ARTICLES, min_size=1, max_size=5),
)
def test_tallies_match_brute_force(spark, rows, titles):
    bronze = spark.createDataFrame(rows, "article string, timestamp string")
    tf = titles_frame(spark, titles)
    n_grid, missing, dups = brute(rows, titles)

    t = run_tally(bronze, tf, "20260101", "20260103").collect()[0]
    assert (t["expected_count"], t["missing_count"], t["duplicate_count"]) == (n_grid, len(missing), len(dups))

    counts = key_counts(bronze)
    got_missing = [tuple(r) for r in missing_coverage(expected_grid(tf, "20260101", "20260103"), counts).collect()]
    assert sorted(got_missing, key=repr) == sorted(missing, key=repr)
    got_dups = {(r["article"], r["timestamp"]): r["count"] for r in duplicate_keys(counts).collect()}
    assert got_dups == dups
    # sum of counts is the row count
    assert sum(r["count"] for r in counts.collect()) == len(rows)
