"""Fingerprints by content-defined chunking, and the likeness of neighbours.

A gear hash over the last ``WINDOW`` bytes sets boundaries where its high bits are 0. Chunk sizes are normalised:
up to ``normal`` bytes the test is two bits stricter than beyond. The fingerprint is the set of
distinct chunk digests, each with its chunk's length; an insertion moves boundaries only near it. The likeness of one text to another is
the share of the one's weight (bytes of distinct chunks) whose digests the other has: its containment.

``edited_neighbours`` compares each document with an edited text and the next document in descending id order. Documents are
dealt into ranges of (id, hash of the text), cut at quantiles over all rows; the first row of each range is looked up. Each range
gets its successor's first row as well, so ranges are independent and no task needs more than one
range. An id (or null) that fills several ranges is split by the hash of the text.

Defined results: a null text is empty and has the empty fingerprint. Two empty fingerprints are alike (1); an empty one is not like another
(0). Null ids come last; rows of one id are ordered by their texts' hash; repeated rows are neighbours. A single row is its own
next document. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, ranges_for, written

#: Bytes that a boundary depends on: one bit of the hash each.
WINDOW = 16
_GEAR = np.random.default_rng(20_240_602).integers(0, 1 << 16, 256, dtype=np.uint16)
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Sizes:
    """Bytes of a chunk: at least, from where boundaries are easier, and at most."""

    least: int = 16
    normal: int = 48
    most: int = 255

    def __post_init__(self):
        if not WINDOW <= self.least <= self.normal <= self.most <= 255:
            raise ValueError(f"{WINDOW} <= least <= normal <= most <= 255 is required")


def _boundaries(joined: np.ndarray, normal: int) -> tuple[list[int], list[int]]:
    """Ends of chunks by the strict and by the easy test, anywhere in the bytes."""
    h = _GEAR[joined]
    wide = 1
    while wide < WINDOW:  # h[i] becomes the sum of gear[i - k] << k for k below the window
        older = np.zeros_like(h)
        older[wide:] = h[:-wide] << np.uint16(wide)
        h = h + older
        wide *= 2
    bits = max(2, int(round(np.log2(max(normal, 8)))))
    easy = h >> np.uint16(16 - (bits - 1)) == 0
    strict = h >> np.uint16(16 - (bits + 1)) == 0
    return (np.flatnonzero(strict) + 1).tolist(), (np.flatnonzero(easy) + 1).tolist()


def fingerprints(texts: list[bytes], sizes: Sizes = Sizes()) -> list[dict[bytes, int]]:
    """Of each text, lengths of its distinct chunks by digest (4 bytes)."""
    joined = b"".join(texts)
    strict, easy = _boundaries(np.frombuffer(joined, np.uint8), sizes.normal)
    digest, out, base = xxhash.xxh32_digest, [], 0
    s = e = 0
    n_strict, n_easy = len(strict), len(easy)
    for text in texts:
        chunks: dict[bytes, int] = {}
        at, end = base, base + len(text)
        while at < end:
            stop = min(at + sizes.most, end)
            cut = stop
            s = bisect_left(strict, at + sizes.least, s)
            if s < n_strict and strict[s] < min(at + sizes.normal, stop):
                cut = strict[s]
            else:
                e = bisect_left(easy, at + sizes.normal, e)
                if e < n_easy and easy[e] < stop:
                    cut = easy[e]
            chunk = joined[at:cut]
            chunks[digest(chunk)] = cut - at
            at = cut
        out.append(chunks)
        base = end
    return out


def as_string(chunks: dict[bytes, int]) -> str:
    """Ten hex digits per chunk: its digest and its length; in order of digests."""
    return "".join(f"{d.hex()}{n:02x}" for d, n in sorted(chunks.items()))


def containment(of: dict[bytes, int], other: dict[bytes, int]) -> float:
    """The share of ``of`` that ``other`` contains, by bytes of distinct chunks."""
    if not of:
        return 0.0 if other else 1.0
    return sum(n for d, n in of.items() if d in other) / sum(of.values())


# ---- ranges ----------------------------------------------------------------


@dataclass
class Ranges:
    """Where ranges begin, in order: keys, and hashes of the text within a key."""

    key: np.ndarray
    tie: np.ndarray

    def number(self, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """The range of each row: the last that begins at or before it."""
        low = np.searchsorted(self.key, key, "left")
        high = np.searchsorted(self.key, key, "right")
        out = high - 1
        at_bound = np.flatnonzero(high > low)
        for k in np.unique(low[at_bound]).tolist():
            own = at_bound[low[at_bound] == k]
            out[own] = k + np.searchsorted(self.tie[k : high[own[0]]], tie[own], "right") - 1
        return np.maximum(out, 0)

    def begins(self, key: np.ndarray, tie: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Of each range that begins in these rows, one row that it begins with."""
        first = np.flatnonzero((key == self.key[number]) & (tie == self.tie[number]))
        return first[np.unique(number[first], return_index=True)[1]]


def _keyed(docs: DataFrame) -> DataFrame:
    # ~id ascends where the id descends; null last
    key = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(_LAST))
    return docs.withColumns({"_key": key, "_tie": F.xxhash64("text")})


def plan_ranges(keys: DataFrame, n: int) -> Ranges | None:
    """About ``n`` ranges of equal row counts, from quantiles over all rows (_key, _tie), each beginning with a row of the table; None for an empty table."""
    shares = [k / n for k in range(n)]
    accuracy = max(10_000, 10 * n)
    rough = F.col("_key").cast("double")  # as quantiles see it
    found = keys.agg(F.percentile_approx("_key", shares, accuracy).alias("q"), F.min("_key").alias("first")).first()
    if found.first is None:
        return None
    cuts, many = np.unique(np.array(found.q, np.int64), return_counts=True)
    frequent = {float(k): int(c) for k, c in zip(cuts, many) if c > 1}
    rows = {(int(found.first), -_LAST - 1), *((int(k), -_LAST - 1) for k in cuts)}
    if frequent:
        most = max(frequent.values())
        ties = keys.filter(rough.isin(list(frequent))).groupBy(rough.alias("rough"))
        quantiles = F.percentile_approx("_tie", [k / most for k in range(most)], accuracy)
        for r in ties.agg(quantiles.alias("q"), F.min("_key").alias("low"), F.max("_key").alias("high")).collect():  # fewer than n
            if r.low == r.high:
                step = max(1, most // frequent[r.rough])
                rows |= {(r.low, int(t)) for t in r.q[::step]}
    return _snapped(keys, Ranges(*(np.array(x, np.int64) for x in zip(*sorted(rows)))))


def _snapped(keys: DataFrame, rough: Ranges) -> Ranges:
    """The ranges that have rows, each beginning at its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = batch.column("_key").to_numpy(), batch.column("_tie").to_numpy()
            number = pa.array(rough.number(key, tie))
            yield pa.RecordBatch.from_arrays([number, batch.column("_key"), batch.column("_tie")], names=["n", "_key", "_tie"])

    numbered = keys.select("_key", "_tie").mapInArrow(run, "n long, _key long, _tie long")
    first = numbered.groupBy("n").agg(F.min(F.struct("_key", "_tie")).alias("first"))
    rows = sorted((r["first"]["_key"], r["first"]["_tie"]) for r in first.collect())  # one per range
    return Ranges(*(np.array(x, np.int64) for x in zip(*rows)))


def _deal(ranges: Ranges):
    """Each row to its range, and rows that begin one also to the range before, marked."""
    last = len(ranges.key) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = batch.column("_key").to_numpy(), batch.column("_tie").to_numpy()
            number = ranges.number(key, tie)
            first = ranges.begins(key, tie, number)
            marked = batch.take(pa.array(first))
            before = np.where(number[first] == 0, last, number[first] - 1)
            for part, to, mark in ((batch, number, False), (marked, before, True)):
                if part.num_rows:
                    columns = [part.column(c) for c in ("doc_id", "text", "_key", "_tie")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(to.astype(np.int32)), pa.array(np.full(part.num_rows, mark))],
                        names=["doc_id", "text", "_key", "_tie", "_range", "_mark"],
                    )

    return run


@dataclass
class _Row:
    doc_id: int | None
    text: str
    range: int
    mark: bool
    print: dict[bytes, int]


def _compared(own: list[_Row], following: list[_Row], sizes: Sizes) -> pa.RecordBatch:
    """Rows of the result for rows and their next ones."""
    edited = [(a.text[: len(a.text) - len(a.text) // 2] + b.text[: len(a.text) // 2]).encode() for a, b in zip(own, following)]
    prints = fingerprints(edited, sizes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([a.doc_id for a in own], pa.int64()),
            pa.array([len(a.text) for a in own], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()),
            pa.array([as_string(a.print) for a in own], pa.string()),
            pa.array([as_string(x) for x in prints], pa.string()),
            pa.array([containment(a.print, x) for a, x in zip(own, prints)], pa.float64()),
            pa.array([containment(a.print, b.print) for a, b in zip(own, following)], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _neighbours(sizes: Sizes):
    """Rows in order, each compared with the next of its range; the marked row after a range's last one closes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Row | None = None
        for batch in pieces(batches, 1 << 20):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            prints = fingerprints([x.encode() for x in texts], sizes)
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "_range", "_mark"))
            own, following = [], []
            for doc_id, text, number, mark, chunks in zip(next(columns), texts, *columns, prints):
                row = _Row(doc_id, text, number, mark, chunks)
                if held is not None and not held.mark:
                    own.append(held)
                    following.append(row)
                if not (held is not None and held.mark and row.mark):  # of several marked rows the first counts
                    held = row
            if own:
                yield _compared(own, following, sizes)

    return run


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_neighbours(docs: DataFrame, sizes: Sizes = Sizes(), ranges: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its fingerprint, that of its text with the last half replaced by the next document's beginning, and the likenesses.

    ``ranges``: 4 per partition (``ranges_for``), if not given.
    """
    spark = docs.sparkSession
    partitions = ranges_for(docs)
    keyed = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    plan = plan_ranges(written(keyed.select("_key", "_tie"), "chunk-keys"), ranges or 4 * partitions)
    if plan is None:
        return spark.createDataFrame([], SCHEMA)
    dealt = keyed.mapInArrow(_deal(plan), "doc_id long, text string, _key long, _tie long, _range int, _mark boolean")
    ordered = dealt.repartition(partitions, "_range").sortWithinPartitions("_range", "_mark", "_key", "_tie")
    return ordered.mapInArrow(_neighbours(sizes), SCHEMA)
