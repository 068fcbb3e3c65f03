"""Remove every byte that a string of ``length`` bytes covers that also starts anywhere else: prefix-free parsing.

Rolling-hash triggers cut texts into overlapping phrases (``phrases``), so that each string of ``length`` bytes
starts in exactly one phrase, at a distance from its trigger that the string alone decides. The corpus
order of the strings then follows from the dictionary of distinct phrases and the parse (which phrases stand where, how often):

1. Triggers seen once leave: their phrases hold no repeated string.
2. A phrase that occurs twice or more repeats as a whole; all its strings are repeated ("certain").
3. Where different phrases share a trigger, their suffixes are ordered to the depth of ``length`` bytes: strings of a phrase
   are taken in blocks of ``BLOCK`` starts, aligned to the trigger; a block's strings have a core in common. Blocks whose core
   stands in one place leave; in the others, strings with equal core, place and rest (the bytes left and right of the core) are the equal
   neighbours of the suffix order, and are counted. One occurrence stands for a phrase that is certain.

All of it is grouping and joining by hashes of short pieces; no suffix order is built in one task, and a
phrase with very many occurrences is counted before each shuffle and joined by splittable joins. Equal
texts have equal results, so results are kept by two hashes of the text (80 bits) and reach the rows by a join on these.

Defined results: a null text is empty. Texts of fewer than ``length`` bytes lose nothing. Each row of the input gives
one row; a repeated row repeats its text, so texts of ``length`` bytes or more then lose everything. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import expand, own_schema, own_text, packed, pieces, text_bytes, unpacked, written
from .phrases import Hashed, Shape, parse

#: Start positions that share a core.
BLOCK = 16
#: Bytes of text parsed at once, unless one text is longer.
_RUN = 2 << 20


def _hash1(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hash2(text: Column) -> Column:
    return F.xxhash64(F.lit("suffix"), F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0xFFFF))


#: first (31 bits), count (8), distance of the trigger (8), second hash of the text (16) in one number
def _place(first: np.ndarray, count: np.ndarray, trigger_at: np.ndarray, hash2: np.ndarray) -> np.ndarray:
    return first << 32 | count << 24 | trigger_at << 16 | hash2


def _first(place: Column) -> Column:
    return F.shiftright(place, 32)


def _count(place: Column) -> Column:
    return F.shiftright(place, 24).bitwiseAND(F.lit(0xFF))


def _text2(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFFFF))


def _parsed(shape: Shape, with_place: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, _RUN):
            texts = text_bytes(batch, "text")
            long = [k for k, x in enumerate(texts) if x is not None and len(x) >= shape.length]
            for part in _runs([len(texts[k]) for k in long]):
                rows = np.array(long[part])
                _, p = parse([texts[k] for k in rows], shape)
                out = {"trigger": p.trigger.view(np.int64)}
                if with_place:
                    row = rows[p.text]
                    out["phrase"] = p.phrase.view(np.int64)
                    out["text1"] = batch.column("text1").to_numpy()[row]
                    out["place"] = _place(p.first, p.count, p.trigger_at, batch.column("text2").to_numpy()[row])
                yield pa.RecordBatch.from_pydict(out)

    return run


def _runs(sizes: list[int]) -> Iterator[slice]:
    """Slices of about ``_RUN`` bytes each."""
    at, used = 0, 0
    for k, n in enumerate(sizes):
        if k > at and used + n > _RUN:
            yield slice(at, k)
            at, used = k, 0
        used += n
    if at < len(sizes):
        yield slice(at, len(sizes))


def _blocks(shape: Shape):
    """Of each text with phrases to examine: a row per block of starts, with its core's hash and the bytes beside the core."""
    length = shape.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, _RUN):
            texts = text_bytes(batch, "text")
            lists = batch.column("examine")
            sizes = np.diff(lists.offsets.to_numpy())
            each = lists.flatten()
            trigger, place, open_ = (each.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            text = np.repeat(np.arange(len(texts)), sizes)
            joined = Hashed(texts)
            first, count, at = place >> 32, place >> 24 & 0xFF, place >> 16 & 0xFF
            # a start's distance to its trigger runs from at down to at - count + 1
            low, high = at - count + 1, at
            k, block = expand(low // BLOCK, high // BLOCK - low // BLOCK + 1)
            r_low, r_high = np.maximum(low[k] - block * BLOCK, 0), np.minimum(high[k] - block * BLOCK, BLOCK - 1)
            anchor = joined.starts[text[k]] + first[k] + at[k]
            begin, end = anchor - block * BLOCK, anchor - block * BLOCK - (BLOCK - 1) + length
            core = joined.spans(begin, end) + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            whole = b"".join(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "trigger": trigger[k],
                    "core": core.view(np.int64),
                    "left": pa.array([whole[a:b] for a, b in zip((begin - r_high).tolist(), begin.tolist())], pa.binary()),
                    "right": pa.array([whole[a:b] for a, b in zip(end.tolist(), (end + BLOCK - 1 - r_low).tolist())], pa.binary()),
                    "r_low": r_low.astype(np.int32),
                    "r_high": r_high.astype(np.int32),
                    "text1": batch.column("text1").to_numpy()[text[k]],
                    "text2": batch.column("text2").to_numpy()[text[k]],
                    "base": first[k] + at[k] - block * BLOCK,
                    "uncertain": open_[k],
                }
            )

    return run


_BLOCK_SCHEMA = (
    "trigger long, core long, left binary, right binary, r_low int, r_high int, "
    "text1 long, text2 long, base long, uncertain boolean"
)


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = 64) -> DataFrame:
    """Per distinct text of ``docs`` with repeated bytes: text1, text2 and ``spans``, an unordered set of start * 1024 + bytes. Written to the shared folder."""
    shape = Shape(length, gram)
    if length - gram + 1 > 255 or length <= BLOCK:
        raise ValueError("length - gram + 1 is at most 255, and length more than 16")
    texts = docs.select("text", _hash1(F.col("text")).alias("text1"), _hash2(F.col("text")).alias("text2"))

    triggers = texts.select("text").mapInArrow(_parsed(shape, False), "trigger long")
    twice = written(triggers.groupBy("trigger").agg(F.count("*").alias("n")).filter("n > 1").select("trigger"), "suffix-triggers")
    phrases = texts.mapInArrow(_parsed(shape, True), "trigger long, phrase long, text1 long, place long")
    parse_rows = written(phrases.join(twice, "trigger"), "suffix-parse")

    # the dictionary: distinct phrases, how often each occurs, one text that has it, and whether its trigger has others
    counted = parse_rows.groupBy("trigger", "phrase").agg(F.count("*").alias("n"), F.min("text1").alias("sample"))
    dictionary = written(counted, "suffix-dictionary")
    mixed = dictionary.groupBy("trigger").agg(F.count("*").alias("phrases")).filter("phrases > 1").select("trigger")
    judged = written(
        dictionary.join(mixed.withColumn("mixed", F.lit(True)), "trigger", "left").filter("n > 1 or mixed"), "suffix-judged"
    )
    known = judged.select("trigger", "phrase", "n", "sample", F.coalesce("mixed", F.lit(False)).alias("mixed"))
    placed = parse_rows.join(known, ["trigger", "phrase"])
    span = _first(F.col("place")) * 1024 + _count(F.col("place")) - 1 + length
    open_ = F.struct("trigger", "place", (F.col("n") == 1).alias("uncertain"))
    by_text = placed.groupBy("text1", _text2(F.col("place")).alias("text2")).agg(
        F.collect_set(F.when(F.col("n") > 1, span)).alias("certain"),
        F.collect_set(F.when(F.expr("mixed and (n = 1 or text1 = sample)"), open_)).alias("examine"),
    )
    by_text = written(by_text, "suffix-texts")

    with_text = texts.join(by_text.filter("size(examine) > 0").drop("certain"), ["text1", "text2"])
    blocks = written(with_text.mapInArrow(_blocks(shape), _BLOCK_SCHEMA), "suffix-blocks")
    shared = blocks.groupBy("trigger", "core").agg(F.count("*").alias("n"), F.max("uncertain").alias("any"))
    shared = written(shared.filter("n > 1 and any").select("trigger", "core"), "suffix-cores")
    starts = blocks.join(shared, ["trigger", "core"]).withColumn("r", F.explode(F.sequence("r_low", "r_high")))
    beside = F.expr(f"concat(substring(left, length(left) - r + 1, r), substring(right, 1, {BLOCK - 1} - r))")
    starts = written(starts.select("trigger", "core", "r", beside.alias("beside"), "text1", "text2", (F.col("base") - F.col("r")).alias("start"), "uncertain"), "suffix-starts")
    key = ["trigger", "core", "r", "beside"]
    equal = written(starts.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key), "suffix-equal")
    found = starts.filter("uncertain").join(equal, key).select("text1", "text2", (F.col("start") * 1024 + length).alias("span"))

    found = written(found.groupBy("text1", "text2").agg(F.collect_set("span").alias("found")), "suffix-found")
    spans = by_text.drop("examine").join(found, ["text1", "text2"], "left")
    spans = spans.select("text1", "text2", F.concat("certain", F.coalesce("found", F.array())).alias("spans"))
    return written(spans.filter("size(spans) > 0"), "suffix-spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, _RUN):
        kept, removed, spans = [], [], []
        texts = own_text(batch)
        for text, marks in zip(texts, batch.column("spans")):
            text = text or b""
            if not marks.is_valid:
                kept.append(text)
                removed.append(0)
                spans.append(0)
                continue
            marks = np.sort(marks.values.to_numpy())
            begin, end = marks >> 10, (marks >> 10) + (marks & 1023)
            reach = np.maximum.accumulate(end)
            head = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
            begin, end = begin[head], reach[np.append(head[1:], len(reach)) - 1]
            edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
            removed.append(int((end - begin).sum()))
            spans.append(len(begin))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("own"),
                pa.array([len(x or b"") for x in texts], pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["own", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64) -> DataFrame:
    """``docs`` (with text) and ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes left, joined; replacing columns of these names)."""
    spans = repeated_spans(docs, length, gram)
    text = F.col("own")["text"]
    hashed = packed(docs).withColumns({"h1": _hash1(text), "h2": _hash2(text)})
    joined = hashed.join(spans, (F.col("h1") == F.col("text1")) & (F.col("h2") == F.col("text2")), "left").select("own", "spans")
    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    done = joined.mapInArrow(_cut, own_schema(joined, "n_bytes long, n_removed long, n_spans long, kept binary"))
    return unpacked(done, *added, names=added)
