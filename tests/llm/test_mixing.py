import pytest
from pyspark.sql import functions as F

from tallycheck.llm.mixing import mix, mixed_rows, source_targets


def targets(sizes, weights, cap=3):
    """Shares raised in rounds until no source is above its cap."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(cap * sizes[k] for k in capped)
        free = [k for k in range(len(sizes)) if k not in capped]
        share = {k: rest * w[k] / sum(w[j] for j in free) for k in free}
        over = {k for k in free if share[k] > cap * sizes[k]}
        if not over:
            return [cap * s if k in capped else share[k] for k, s in enumerate(sizes)]
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1, 50, 3, 3, 900], [5], [0, 7, 0], [1] * 30 + [1000]])
def test_targets(spark, sizes):
    rows = [(f"s{k:03}", s) for k, s in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    got = source_targets(spark.createDataFrame(rows, "source string, source_size long"))
    got = {r.source: r.target for r in got.collect()}
    want = targets(sizes, (5, 2, 1))
    for (name, _), t in zip(rows, want):
        assert got[name] == pytest.approx(t)


def test_taken(spark, docs):
    rows = [(k, "w " * (k % 7 + 1), f"s{k % 4}") for k in range(4000)] + [(None, None, None), (9000, "", "s1"), (5, "a\tb\x0bc d", "s2")]
    df = mix(docs(rows))
    got = df.collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.size) for r in got if r.doc_id in (9000, None)} == {(9000, 0), (None, 0)}
    assert (5, 3) in {(r.doc_id, r.size) for r in got}
    for r in df.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.1)
    assert all(r.copies <= 3 for r in got)
    again = {(r.doc_id, r.copies) for r in mix(docs(rows, parts=7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_rows(spark, docs):
    rows = [(k, "w " * 5, f"s{k % 3}") for k in range(300)]
    made = docs(rows).withColumn("target", F.lit("own"))
    copies = {r.doc_id: r.copies for r in mix(made).collect()}
    out = mixed_rows(made)
    assert out.columns == made.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: c for k, c in copies.items() if c}


def test_empty(spark, docs):
    assert mix(docs([])).count() == 0 and mixed_rows(docs([])).count() == 0
    assert [(r.target, r.copies) for r in mix(docs([(1, "")])).collect()] == [(0.0, 1)]
