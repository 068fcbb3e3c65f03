"""Mix sources to target weights: whole copies plus one hash-seeded chance copy.

Tokens are summed per source; each source's target follows from its weight and its size, and
target / size is its repetition rate. A document is taken floor(rate) times, and once more with a
probability equal to the rate's fraction, drawn from a hash of its id and text.

Defined results: a null text has size 0 and a null source is a source of its own, ordered last. Rows
with equal id and text draw the same number, so repeated rows are taken equally often. A source whose
documents have no words has target 0 and rate 1 (its rows stay once). An empty table gives an empty
result. Columns that clash with an added name are replaced in the result.

Only DataFrame functions are used. Rows meet the targets in a join with one row per source: Spark
broadcasts it while it is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and
splits skewed sources (AQE). Ordering the sources is the one step in a single task; it holds one
row of two numbers per source, never rows of documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import packed, unpacked, written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of anything but space and \\t \\n \\v \\f \\r."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets of sources: (source, source_size, target) from (source, source_size).

    ``weights`` repeat over the sources in code-point order, null last. Together the targets make the
    sum of all sizes; none exceeds ``cap`` times its source, and the excess goes to the others by weight.
    With sources ordered by cap / weight, the level that shares the rest after the first k are
    capped, (total - their caps) / (weights of the others), is greatest at the right k.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("_rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    capped = named.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * cap)
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = capped.withColumn("_level", (total - before) / rest)
    best = F.max("_level").over(Window.partitionBy())
    return level.select("source", "source_size", F.least(F.col("_cap").cast("double"), F.col("_weight") * best).alias("target"))


def _draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 to below 1, from 52 bits of an MD5."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _copies(size: Column, target: Column, draw: Column, cap: int) -> Column:
    """floor(target / size) and, by chance, one more."""
    rate = F.when(size > 0, F.least(target / size, F.lit(float(cap)))).otherwise(1.0)
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 17) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, copies."""
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _draw(F.col("doc_id"), F.col("text"), seed).alias("draw")),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, cap), "mix-targets").withColumnRenamed("source", "_source")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["_source"]))
    copies = _copies(F.col("source_size"), F.col("target"), F.col("draw"), cap)
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with its own columns only."""
    totals = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    targets = written(source_targets(totals, weights, cap), "mix-targets")
    targets = targets.withColumnRenamed("source", "of")
    own = F.col("own")
    joined = packed(docs).join(targets, own["source"].eqNullSafe(F.col("of")))
    copies = _copies(F.col("source_size"), F.col("target"), _draw(own["doc_id"], own["text"], seed), cap)
    return unpacked(joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))))
