"""A third of all rows on one key: results must stay exact (checked against pandas)."""

from collections import Counter

from pyspark.sql import functions as F

from tallycheck.operators.coverage import missing_by_article, missing_coverage, expected_grid, key_counts, run_tally, titles_frame
from tallycheck.operators.fetch import latest_success

N = 30_000


def skewed_bronze(spark):
    # id % 3 == 0 -> the hot key ("hot", 2026010100); others spread over 50 titles x 20 days
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
        .alias("article"),
        F.when(F.col("id") % 3 == 0, F.lit("2026010100"))
        .otherwise(F.format_string("202601%02d00", (F.col("id") % 20 + 1).cast("int")))
        .alias("timestamp"),
    )


def brute_force(pdf, titles, days):
    counts = Counter(zip(pdf["article"], pdf["timestamp"]))
    grid = [(t, d) for t in titles for d in days]
    missing = [(t, d) for t, d in grid if (t, d) not in counts]
    dups = sum(1 for c in counts.values() if c > 1)
    return len(grid), missing, dups


def test_hot_key_tally_is_exact(spark):
    bronze = skewed_bronze(spark)
    titles = ["hot"] + [f"t{i}" for i in range(0, 60, 2)]  # some titles have no rows at all
    days = [f"202601{d:02d}00" for d in range(1, 32)]
    pdf = bronze.toPandas()
    exp_grid, exp_missing, exp_dups = brute_force(pdf, titles, days)

    tf = titles_frame(spark, titles)
    tally = run_tally(bronze, tf, "20260101", "20260131").collect()[0]
    assert tally["expected_count"] == exp_grid
    assert tally["missing_count"] == len(exp_missing)
    assert tally["duplicate_count"] == exp_dups

    missing = missing_coverage(expected_grid(tf, "20260101", "20260131"), key_counts(bronze))
    assert sorted(tuple(r) for r in missing.collect()) == sorted(exp_missing)
    hot = key_counts(bronze).filter("article = 'hot'").collect()
    assert [(r["timestamp"], r["count"]) for r in hot] == [("2026010100", N // 3)]
    by = {r["article"]: r["details"] for r in missing_by_article(missing).collect()}
    assert by["hot"] == "; ".join(d for d in days if d != "2026010100")


def test_hot_request_latest_success(spark):
    # one request has a third of all attempts; the highest successful attempt wins
    attempts = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 97).cast("string"))).alias("title"),
        F.col("id").alias("attempt_no"),
        F.when(F.col("id") % 10 == 9, F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        F.to_json(F.struct(F.array(F.struct(F.col("id").alias("views"))).alias("items"))).alias("body"),
        F.lit(None).cast("string").alias("error"),
    )
    got = {r["title"]: r["attempt_no"] for r in latest_success(attempts, keys=("title",)).collect()}
    pdf = attempts.toPandas()
    ok = pdf[pdf["status_code"] < 400]
    expected = ok.groupby("title")["attempt_no"].max().to_dict()
    assert got == expected
