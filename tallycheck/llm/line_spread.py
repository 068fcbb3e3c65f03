"""Remove lines that stand on many sites: HyperLogLog sketches of sites per line, exact counts near the limit.

A line is a text between line feeds; it is known by two 64-bit hashes. A HyperLogLog sketch of sites is built for every line straight
from the texts, one per task and line, and merged by aggregation. Estimates far below or above the limit decide; only lines within
``band`` and one site of it have their distinct sites counted exactly, in a second pass. Lines on ``min_sites`` sites or more are removed
wherever they stand.

Defined results: a null text has no lines; an empty text has one empty line. Lines of white space only
are never removed. A null source is a site of its own. Rows with equal texts give equal results; each
row of the input gives one row. An empty table gives an empty result.

Only DataFrame functions are used. Very common lines are merged before each shuffle (one row per task).
Removed lines reach the documents by a join on the text's hashes, which AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked, written

#: Buckets of a sketch, as a power of 2: a standard error of about 1.6 %.
LG_BUCKETS = 12


def _hashes(text: Column, label: str) -> list[Column]:
    return [F.xxhash64(text).alias(f"{label}1"), F.xxhash64(F.lit(label), text).alias(f"{label}2")]


def _lines(docs: DataFrame) -> DataFrame:
    line = F.explode(F.split("text", "\n"))
    site = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    rows = docs.select(site.alias("site"), line.alias("line")).filter(F.trim(F.translate("line", "\t\r", "  ")) != "")
    return rows.select(F.xxhash64("site").alias("site"), *_hashes(F.col("line"), "line"))


def spread_lines(docs: DataFrame, min_sites: int = 5, band: float = 0.1) -> DataFrame:
    """Lines (line1, line2: hashes) of ``docs`` (text, source) on ``min_sites`` sites or more, written to the shared folder.

    ``band``: share of ``min_sites`` by which an estimate, less one site, may be off before it decides; over six standard errors of
    the sketch. An estimate of one site always decides (two sites look like one with a chance of 2 to the power of -26).
    """
    if min_sites < 2:
        raise ValueError("min_sites must be 2 or more")
    key = ["line1", "line2"]
    lines = _lines(docs)
    sketches = lines.groupBy(*key).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_BUCKETS))).alias("estimate"))
    low, high = max(min_sites * (1 - band) - 1, 1.5), min_sites * (1 + band) + 1
    judged = written(sketches.filter(F.col("estimate") >= low), "line-estimates")
    sure = judged.filter(F.col("estimate") > high).select(*key)
    near = judged.filter(F.col("estimate") <= high).select(*key)
    sites = lines.join(near, key, "left_semi").distinct().groupBy(*key).agg(F.count("*").alias("sites"))
    exact = sites.filter(F.col("sites") >= min_sites).select(*key)
    return written(sure.unionByName(exact), "line-spread")


def remove_spread_lines(docs: DataFrame, min_sites: int = 5, band: float = 0.1) -> DataFrame:
    """``docs`` with ``kept_text`` (null for null), ``n_lines`` and ``n_removed`` added (replacing columns of those names)."""
    spread = spread_lines(docs, min_sites, band)
    text = F.col("own")["text"]
    keyed = packed(docs).withColumns({"text1": F.xxhash64(text), "text2": F.xxhash64(F.lit("text"), text)})
    lines = keyed.select("text1", "text2", F.explode(F.array_distinct(F.split(text, "\n"))).alias("line"))
    lines = lines.select("text1", "text2", *_hashes(F.col("line"), "line"))
    hits = lines.join(spread, ["line1", "line2"]).groupBy("text1", "text2").agg(F.collect_set(F.struct("line1", "line2")).alias("bad"))
    joined = keyed.join(written(hits, "line-hits"), ["text1", "text2"], "left")
    all_lines = F.split(text, "\n")
    kept = F.when(F.col("bad").isNull(), all_lines).otherwise(
        F.filter(all_lines, lambda x: ~F.array_contains(F.col("bad"), F.struct(*_hashes(x, "line"))))
    )
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(all_lines))
    n_kept = F.when(text.isNull(), F.lit(0)).otherwise(F.size("kept_lines"))
    added = {
        "kept_text": F.array_join("kept_lines", "\n"),
        "n_lines": n_lines.cast("long"),
        "n_removed": (n_lines - n_kept).cast("long"),
    }
    done = joined.withColumn("kept_lines", kept)
    return unpacked(done, *(c.alias(n) for n, c in added.items()), names=list(added))
