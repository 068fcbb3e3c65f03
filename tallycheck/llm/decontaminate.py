"""Benchmark decontamination: exact containment of item windows, by a prefix-filtered set join.

Items and documents become words (A-Z lower-cased; runs of digits, letters a-z and non-ASCII). A window
is ``size`` consecutive words of an item, or a whole shorter item. A window is a set of positioned
shingles of ``_GRAM`` words (fewer for shorter windows). Shingles are ordered by rarity, counted over all
documents; to contain a window whole, a text must have the window's rarest shingle, so that one is its
necessary prefix, and a window with a shingle that no document has leaves at once. Where a document
has a prefix shingle, its position fixes where the window would start: the words around it are joined with the windows of that
prefix, a place outside the document matches nothing (positional and length bounds), and the rest is compared word by word.

The benchmark is a table like any other: its windows, their shingles and prefixes are grouped and joined by Spark and never pass through the
driver. Whatever its size there is one pass over the documents for rarity, one for candidates, and two that give the rows back (those without and those
with a hit). All that is broadcast are bitmaps of at most ``filter_bits`` bits, by which tasks leave out shingles that no window has and
texts without a hit; a full bitmap costs time, never a result. Of the documents only texts with a hit (and few others) are shuffled.

A word is known by a 64-bit hash, a text and a window by two.

Defined results: a null text has no words; an item without words has no windows. Rows with the same item id are one item. Windows
of items with a null id are hits like any other (``n_hit``, ``contaminated``); together they are one item in ``n_items``, null and last
in ``items``, and not in ``items`` joined to a string. Each row of the input gives one row, repeated rows included. An
empty benchmark leaves every document clean. Columns of the input that clash with added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, own_schema, own_text, packed, pieces, text_bytes, unpacked, written
from .phrases import Hashed

#: Words of a shingle.
_GRAM = 3
#: Lower-cased word bytes as they are, any other byte as a space.
_FOLD = bytes(
    LOWER[c] if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Bytes of text whose words are hashed at once.
_RUN = 1 << 20
#: Windows or candidates of a batch.
_ROWS = 1 << 14


def _runs(joined: bytes) -> Iterator[bytes]:
    """``joined`` in runs of about ``_RUN`` bytes, cut at spaces."""
    at = 0
    while at < len(joined):
        end = joined.find(b" ", at + _RUN)
        end = len(joined) if end < 0 else end
        yield joined[at:end]
        at = end


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (never 0) of the words of all texts in turn, and the number of words of each text."""
    folded = [(x or b"").translate(_FOLD) for x in texts]
    hashes, ends, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    for run in _runs(b" ".join(folded)):
        inside = np.frombuffer(run, np.uint8) != 32
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        hashes.append(Hashed([run]).spans(edge[0::2], edge[1::2]))
        ends.append(edge[1::2] + at)
        at += len(run)
    flat = np.concatenate(hashes)
    flat[flat == 0] = 1
    text_end = np.cumsum(np.fromiter(map(len, folded), np.int64, len(folded)) + 1) - 1
    upto = np.searchsorted(np.concatenate(ends), text_end, "right")
    return flat, np.diff(upto, prepend=0)


def _shingle_keys(flat: np.ndarray, gram: int) -> np.ndarray:
    """A hash per run of ``gram`` words, whatever text they are in."""
    n = max(0, len(flat) - gram + 1)
    key = np.full(n, gram, np.uint64)
    for k in range(gram):
        key = (key ^ flat[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """A row per window of an item: item_id (string), words (hashes), gram, keys (its shingles), and w1, w2, its own hashes; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, _RUN):
            for k, text in enumerate(text_bytes(batch, "text")):
                flat, _ = word_hashes([text])
                take = min(size, len(flat))
                if not take:
                    continue
                gram = min(_GRAM, take)
                keys = _shingle_keys(flat, gram)
                starts = np.arange(len(flat) - take + 1)
                for part in np.array_split(starts, -(-len(starts) // _ROWS)):
                    words = flat[part[:, None] + np.arange(take)].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("item_id")[k].as_py()] * len(part), pa.string()),
                            _lists(words),
                            pa.array(np.full(len(part), gram, np.int32)),
                            _lists(keys[part[:, None] + np.arange(take - gram + 1)]),
                        ],
                        names=["item_id", "words", "gram", "keys"],
                    )

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    rows = items.mapInArrow(run, "item_id string, words array<long>, gram int, keys array<long>")
    return written(rows.withColumns({"w1": F.xxhash64("words"), "w2": F.xxhash64(F.lit("tie"), F.col("words"))}), "windows")


def bitmap(values: DataFrame, filter_bits: int) -> np.ndarray:
    """The one long column of ``values`` as a bitmap of a power of two bits, 16 or more a row, at most ``filter_bits``.

    64-bit words of it reach the driver, as Arrow, so what it takes is bounded by ``filter_bits``.
    """
    name = values.columns[0]
    bits = 64
    while bits < min(filter_bits, 16 * max(values.count(), 1)):
        bits *= 2
    at = F.pmod(F.col(name), F.lit(bits))
    words = values.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({name}, {bits}) % 64 as int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def _marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.int64(len(bits) * 64 - 1)
    return ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _places(batch_texts: list[bytes | None], grams: list[int], bits: np.ndarray) -> Iterator[tuple]:
    """Per length of shingle: words of all texts, their number per text, and text, place (in all words) and key of each marked shingle."""
    flat, n = word_hashes(batch_texts)
    ends = np.cumsum(n)
    for gram in grams:
        keys = _shingle_keys(flat, gram)
        at = np.flatnonzero(_marked(bits, keys))
        text = np.searchsorted(ends, at, "right")
        inside = at + gram <= ends[text]
        yield gram, flat, n, text[inside], at[inside], keys[at[inside]]


def shingle_counts(docs: DataFrame, grams: list[int], bits: np.ndarray) -> DataFrame:
    """(key, n): how often the marked shingles stand in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for *_, keys in _places(text_bytes(batch, "text"), grams, sent.value):
                key, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per window whose shingles all occur: key, at (its rarest shingle and the place in the window), w1, w2 and words; written."""
    each = windows.select("w1", "w2", F.size("keys").alias("n_keys"), F.posexplode("keys").alias("at", "key"))
    heads = each.join(counts, "key").groupBy("w1", "w2").agg(
        F.min(F.struct("n", "key", "at")).alias("head"), F.count(F.lit(1)).alias("have"), F.max("n_keys").alias("n_keys")
    )
    rare = heads.filter("have = n_keys").select("w1", "w2", "head.key", "head.at")
    return written(rare.join(windows.select("w1", "w2", "words"), ["w1", "w2"]), "prefixes")


def candidates(docs: DataFrame, grams: list[int], bits: np.ndarray, size: int) -> DataFrame:
    """A row per marked shingle of a text: t1, t2 (the text), key, place, and around: the hashes of the ``size`` - 1 words before it, and of as many
    from its first on as a window has; 0 outside the text."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    reach = np.arange(1 - size, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            t1, t2 = (batch.column(c).to_numpy() for c in ("t1", "t2"))
            for _, flat, n, text, at, keys in _places(text_bytes(batch, "text"), grams, sent.value):
                last = np.cumsum(n)
                first = last - n
                for part in np.array_split(np.arange(len(at)), -(-len(at) // _ROWS)) if len(at) else ():
                    own, place = text[part], at[part][:, None] + reach
                    inside = (place >= first[own][:, None]) & (place < last[own][:, None])
                    around = np.where(inside, flat[np.clip(place, 0, len(flat) - 1)], np.uint64(0)).view(np.int64)
                    columns = [pa.array(t1[own]), pa.array(t2[own]), pa.array(keys[part]), pa.array(at[part] - first[own]), _lists(around)]
                    yield pa.RecordBatch.from_arrays(columns, names=["t1", "t2", "key", "place", "around"])

    return _named(docs.select("text")).mapInArrow(run, "t1 long, t2 long, key long, place long, around array<long>")


def _named(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the two hashes of its texts."""
    return docs.withColumns({"t1": F.xxhash64(text), "t2": F.xxhash64(F.lit("tie"), F.col(text))})


def hits(found: DataFrame, prefixes: DataFrame, size: int) -> DataFrame:
    """(t1, t2, start, length, w1, w2): where a text has a window, word by word; each once, written."""
    pairs = found.join(prefixes, "key")
    length = F.size("words")
    same = pairs.filter(F.slice("around", F.lit(size) - F.col("at"), length) == F.col("words"))
    return written(same.select("t1", "t2", (F.col("place") - F.col("at")).alias("start"), length.alias("length"), "w1", "w2").distinct(), "hits")


def marked_texts(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Per text with a hit: t1, t2, runs (starts and ends of runs of hit words, in turn), n_hit and items; written."""
    text = ["t1", "t2"]
    reach = hits.groupBy(*text, "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    order = Window.partitionBy(*text).orderBy("start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = reach.withColumn("opens", F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)).withColumn("run", F.sum("opens").over(order))
    runs = opened.groupBy(*text, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy(*text).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda x: F.array(x["start"], x["end"]))).alias("runs"),
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
    )
    owners = windows.select("w1", "w2", "item_id").distinct()
    own = hits.select(*text, "w1", "w2").distinct().join(owners, ["w1", "w2"]).select(*text, "item_id").distinct()
    named = own.groupBy(*text).agg(F.array_sort(F.collect_list("item_id")).alias("named"), F.bool_or(F.col("item_id").isNull()).alias("lone"))
    items = F.when(F.col("lone"), F.concat("named", F.array(F.lit(None).cast("string")))).otherwise(F.col("named"))
    return written(spans.join(named.select(*text, items.alias("items")), text), "marked")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, filter_bits: int = 1 << 29) -> DataFrame:
    """``docs`` (with text) and, per row, ``n_words``, ``hit_runs`` (starts and ends of runs of hit words, in turn),
    ``n_hit``, ``items`` (ids of items with an occurring window, sorted as strings, null last), ``n_items`` and ``contaminated``."""
    if size < 1:
        raise ValueError("size is at least 1")
    windows = item_windows(benchmark, size)
    grams = sorted(r.gram for r in windows.select("gram").distinct().collect())  # at most _GRAM rows
    distinct = windows.dropDuplicates(["w1", "w2"])
    counts = shingle_counts(docs, grams, bitmap(distinct.select(F.explode("keys").alias("key")).distinct(), filter_bits))
    rare = prefixes(distinct, counts)
    found = candidates(docs, grams, bitmap(rare.select("key").distinct(), filter_bits), size)
    marked = marked_texts(hits(found, rare, size), windows)

    state = _named(packed(docs), "own.text")
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(marked.select("t1"), filter_bits))

    def counted(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                part = batch.filter(pa.array(_marked(sent.value, batch.column("t1").to_numpy()) == keep))
                _, n = word_hashes(own_text(part))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("own", "t1", "t2")), pa.array(n)], names=["own", "t1", "t2", "n_words"])

        return state.mapInArrow(run, own_schema(state, "t1 long, t2 long, n_words long"))

    nothing = {"runs": F.array().cast("array<long>"), "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")}
    joined = counted(True).join(marked, ["t1", "t2"], "left")
    every = counted(False).withColumns(nothing).unionByName(joined.withColumns({c: F.coalesce(c, x) for c, x in nothing.items()}))
    added = {
        "n_words": F.col("n_words"),
        "hit_runs": F.col("runs"),
        "n_hit": F.col("n_hit"),
        "items": F.col("items"),
        "n_items": F.size("items").cast("long"),
        "contaminated": F.col("n_hit") > 0,
    }
    return unpacked(every, *(c.alias(n) for n, c in added.items()), names=list(added))
