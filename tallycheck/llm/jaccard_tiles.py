"""Documents whose sets of word shingles have a Jaccard similarity of ``percent`` % or more, by size-banded tiles of bitmap signatures.

Documents with equal sets are one class. Sizes fall into bands so wide that linked classes are in one band or in neighbouring
ones. Shingles are ordered by rarity (counts of 65,536 hashed cells over all documents); linked classes share a shingle of their prefixes, the rarest ones, so
a tile is a band and a prefix shingle, with the members of the band and those of the band below. A tile of many members is cut into blocks, and pairs of
blocks are tiles of their own, so that no task holds a tile whole. The first shingle that two linked classes share, in that order, lies in the
first half of the smaller one's prefix, about (``short``), so shingles that are short for no class make no tile.

Within a tile, the bits by which two parity bitmaps of hashed bits differ are never more than the shingles that only one of both has, so
they bound the overlap from above; pairs below the overlap that their sizes require leave. The others are verified by
the exact intersection of their sorted arrays. A bitmap has as many bits as its set's size asks for, ``BITS`` at most; of two the wider is folded.

Classes are first held against two leaders per prefix shingle in turn, and linked ones join. The tiles then take only pairs that are not yet joined, so a large group of near copies
does not give all its pairs, and no link between different groups is missed.

Defined results: a null text is empty; documents without words are linked with nothing, not even with each other. With fewer words than a
shingle, all words are the one shingle. Equal ids in different rows stay separate rows; a component is known by its least
non-null id (null if it has none). An empty table gives no rows. Columns of other names do not matter. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, arrow_batches, expand, pieces, text_bytes, written
from .components import components
from .phrases import Hashed

#: Bits of a signature: the most, and the fewest.
BITS = 2048
_LEAST_BITS = 256
#: Cells in which shingles are counted, for the order by rarity.
_CELLS = 1 << 16
#: Members of a block of a large tile, about.
BLOCK = 512
#: Bits that mark wanted texts.
_MARKS = 1 << 22
#: Texts that a task remembers to leave copies out.
_SEEN = 100_000
#: Pairs whose bits are counted at once.
_PAIRS = 1 << 15
#: White space that ends words as a space, A-Z lower-cased.
_FOLD = bytes(32 if c in b" \t\n\x0b\x0c\r" else LOWER[c] for c in range(256))
#: Bytes of text whose shingles are hashed at once.
_RUN = 1 << 20
_SETS = "n int, band int, s1 long, s2 long"


def _mix(x: np.ndarray, step: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD + 2 * step)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes | None], shingle: int) -> list[np.ndarray]:
    """Of each text the hashes of its distinct shingles, sorted."""
    joined = [b" ".join((x or b"").translate(_FOLD).split()) for x in texts]
    run = Hashed(joined)
    flat = np.frombuffer(b" ".join([*joined, b""]), np.uint8) if joined else np.empty(0, np.uint8)
    # ends of words, also at the ends of texts, where ``flat`` has a space that ``run`` has not
    ends = np.flatnonzero(flat == 32)
    text_end = np.cumsum(run.lengths + 1)
    owner = np.searchsorted(text_end, ends, "right")
    ends = ends - owner
    empty = run.lengths[owner] == 0
    owner, ends = owner[~empty], ends[~empty]
    words = np.bincount(owner, minlength=len(joined))
    first = np.cumsum(words) - words
    within = np.arange(len(ends)) - first[owner]
    starts = np.empty(len(ends), np.int64)
    starts[1:] = ends[:-1] + 1
    starts[within == 0] = run.starts[owner[within == 0]]
    take = np.minimum(shingle, words)
    begins = np.flatnonzero(within <= (words - take)[owner])
    hashes = run.spans(starts[begins], ends[begins + take[owner[begins]] - 1])
    bounds = np.searchsorted(owner[begins], np.arange(len(joined) + 1)) if len(begins) else np.zeros(len(joined) + 1, np.int64)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _identity(own: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    return tuple(int(np.add.reduce(_mix(own, k)).astype(np.int64)) for k in (1, 2))


def cell_counts(docs: DataFrame, shingle: int) -> np.ndarray:
    """How many distinct shingles of documents fall into each cell; a row per cell reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CELLS, np.int64)
        for batch in pieces(batches, _RUN):
            for own in shingle_sets(text_bytes(batch, "text"), shingle):
                np.add.at(total, (own >> np.uint64(48)).astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    found = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(_CELLS, np.int64)
    for row in found.collect():
        counts[row.cell] = row.n
    return counts


def required(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of linked sets of these sizes: 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """Of the rarest shingles, those of which a linked set has one: a linked set shares percent % of the larger."""
    return n - -(-percent * n // 100) + 1


def size_bands(percent: int) -> np.ndarray:
    """Where bands of sizes begin: different linked sets lie in one band or in neighbouring ones."""
    bands = [1]
    while percent < 100 and bands[-1] < 1 << 31:
        bands.append(bands[-1] * 100 // percent + 1)
    return np.array(bands)


def signature(own: np.ndarray, width: int = BITS) -> bytes:
    """``width`` bits that are 1 where an odd number of shingles falls."""
    bits = np.bincount((_mix(own, 3) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def signature_bits(n: int, percent: int) -> int:
    """Bits for a set of ``n``: five times those by which linked sets of this size differ; unrelated sets differ in half of the bits."""
    width = _LEAST_BITS
    while width < BITS and width * (100 + percent) < 10 * n * (100 - percent):
        width *= 2
    return width


def folded(bitmaps: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The widths in bytes, and of each width the bitmaps that are as wide or, folded, were wider (for narrower ones zeros)."""
    widths = np.fromiter(map(len, bitmaps), np.int64, len(bitmaps))
    flat = np.frombuffer(b"".join(bitmaps), np.uint64)
    starts = (np.cumsum(widths) - widths) // 8
    found = np.unique(widths).tolist()
    of_width = {w: np.zeros((len(bitmaps), w // 8), np.uint64) for w in found}
    for wide in found:
        at = np.flatnonzero(widths == wide)
        words = flat[starts[at][:, None] + np.arange(wide // 8)]
        for w in found:
            if w <= wide:
                of_width[w][at] = np.bitwise_xor.reduce(words.reshape(len(at), wide // w, w // 8), axis=1)
    return widths, of_width


def bits_apart(bitmaps: tuple[np.ndarray, dict[int, np.ndarray]], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """By how many bits those at ``one`` differ from those at ``two``, at the width of the narrower."""
    widths, of_width = bitmaps
    least = np.minimum(widths[one], widths[two])
    apart = np.empty(len(one), np.int64)
    for w in np.unique(least).tolist():
        at = np.flatnonzero(least == w)
        apart[at] = np.bitwise_count(of_width[w][one[at]] ^ of_width[w][two[at]]).sum(axis=1, dtype=np.int64)
    return apart


def prints(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n, s1, s2 (the set's size and hashes), t1, t2 (the text's hashes), prefix (rarest first) and bitmap, written."""
    counts = cell_counts(docs, shingle)
    order = np.empty(_CELLS, np.uint64)
    order[np.argsort(counts, kind="stable")] = np.arange(_CELLS, dtype=np.uint64)
    bands = size_bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, _RUN):
            sets = shingle_sets(text_bytes(batch, "text"), shingle)
            sizes = np.fromiter(map(len, sets), np.int32, len(sets))
            names = [_identity(own) for own in sets]
            # the prefix in one global order: cells by rarity, then the hash
            prefixes = []
            for own in sets:
                take = prefix_size(len(own), percent) if len(own) else 0
                rank = order[own >> np.uint64(48)] << np.uint64(48) | own & np.uint64((1 << 48) - 1)
                rarest = np.argpartition(rank, take - 1)[:take] if 0 < take < len(own) else np.arange(len(own))
                prefixes.append(own[rarest[np.argsort(rank[rarest])]].view(np.int64))
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in prefixes])]).astype(np.int32)
            columns = [
                *(batch.column(c) for c in ("doc_id", "t1", "t2")),
                pa.array(sizes),
                pa.array(np.searchsorted(bands, sizes, "right").astype(np.int32)),
                pa.array([x for x, _ in names], pa.int64()),
                pa.array([x for _, x in names], pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, np.int64))),
                pa.array([signature(x, signature_bits(len(x), percent)) for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "t1", "t2", "n", "band", "s1", "s2", "prefix", "bitmap"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("tie"), F.col("text")).alias("t2"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, {_SETS}, prefix array<long>, bitmap binary"), "jaccard-prints")


def _marked(texts: DataFrame) -> np.ndarray:
    """A bitmap of ``_MARKS`` bits in which ``t1`` of ``texts`` set theirs; 64-bit words of it reach the driver, and it is as large for any input."""
    at = F.pmod("t1", F.lit(_MARKS))
    words = texts.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(t1, {_MARKS}) % 64 as int))")).alias("bits"))
    marks = np.zeros(_MARKS // 64, np.int64)
    for row in words.collect():
        marks[row.word] = row.bits
    return marks.view(np.uint64)


def class_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(cid, items: the sorted hashes as bytes) of the classes in ``pairs`` (a, b), read again from one text of each.

    Texts that the bitmap of wanted ones does not mark leave where they are read; so no text is shuffled, only the sets that stay.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    texts = written(classes.select("cid", "t").join(wanted, "cid").select("cid", F.col("t.t1").alias("t1"), F.col("t.t2").alias("t2")), "jaccard-texts")
    sent = docs.sparkSession.sparkContext.broadcast(_marked(texts))
    rows = docs.select("text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("tie"), F.col("text")).alias("t2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = sent.value, set()
        for batch in batches:
            at = batch.column("t1").to_numpy() % _MARKS
            hit = (marks[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            for part in pieces([batch.filter(pa.array(hit.astype(bool)))], _RUN):
                # a copy that this task has had already is left out
                keys = list(zip(part.column("t1").to_pylist(), part.column("t2").to_pylist()))
                fresh = [k for k, key in enumerate(keys) if key not in seen and not seen.add(key)]
                if len(seen) > _SEEN:
                    seen.clear()
                part = part.take(pa.array(fresh, pa.int64()))
                items = [x.tobytes() for x in shingle_sets(text_bytes(part, "text"), shingle)]
                yield pa.RecordBatch.from_arrays([part.column("t1"), part.column("t2"), pa.array(items, pa.binary())], names=["t1", "t2", "items"])

    found = rows.mapInArrow(run, "t1 long, t2 long, items binary")
    # copies of the text give the same rows
    return written(found.join(texts, ["t1", "t2"]).groupBy("cid").agg(F.max("items").alias("items")), "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) of classes that are linked, by the intersection of their sorted arrays."""
    one = pairs.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("items_a")), "a")
    two = one.join(sets.select(F.col("cid").alias("b"), F.col("items").alias("items_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("items_a"), batch.column("items_b"))):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep[k] = 100 * shared >= percent * (len(x) + len(y) - shared)
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return two.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long")


def _tile_pairs(percent: int):
    """Pairs (a < b) of members of a tile that are not joined and may be linked, for rows sorted by tile."""

    def settle(rows: dict[str, np.ndarray], groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``groups``: where tiles begin."""
        n = len(rows["cid"])
        size = np.diff(np.append(groups, n))
        later = np.repeat(groups + size, size) - np.arange(n) - 1
        ends, begin = np.cumsum(later), 0
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _PAIRS, "right")))
            one, two = expand(np.arange(begin + 1, end + 1), later[begin:end])
            one, begin = one + begin, end
            # members of the band, or one of it and one of the band below; of different blocks, where there are two
            meet = (rows["home"][one] | rows["home"][two]) & (rows["label"][one] != rows["label"][two])
            meet &= (rows["block_1"][one] == rows["block_2"][one]) | (rows["own"][one] != rows["own"][two])
            meet &= np.where(rows["n"][one] <= rows["n"][two], rows["short"][one], rows["short"][two])
            one, two = one[meet], two[meet]
            x, y = rows["n"][one], rows["n"][two]
            least = required(x, y, percent)
            fits = np.minimum(x, y) >= least
            one, two, least = one[fits], two[fits], least[fits]
            apart = bits_apart(rows["bitmap"], one, two)
            near = (rows["n"][one] + rows["n"][two] - apart) // 2 >= least
            a, b = rows["cid"][one[near]], rows["cid"][two[near]]
            if len(a):
                found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    names = ["token", "band", "block_1", "block_2"]

    def arrays(table: pa.Table) -> dict[str, np.ndarray]:
        out = {c: table.column(c).to_numpy() for c in (*names, "cid", "n", "home", "short", "own", "label")}
        out["bitmap"] = folded(table.column("bitmap").to_pylist())
        out["n"] = out["n"].astype(np.int64)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.Table | None = None  # a tile that may go on: two blocks at most
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([open_, table]).combine_chunks() if open_ is not None else table
            keys = [table.column(c).to_numpy() for c in names]
            new = np.ones(table.num_rows, bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            starts = np.flatnonzero(new)
            last = int(starts[-1])
            if last:
                yield from settle(arrays(table.slice(0, last)), starts[:-1])
            open_ = table.slice(last)
        if open_ is not None:
            yield from settle(arrays(open_), np.zeros(1, np.int64))

    return run


def near_classes(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, root) of the classes (cid) that are linked with another."""
    # the smallest sets that differ and are linked: size n and n + 1
    least = next(n for n in range(1, 202) if 100 * n >= percent * (n + 1)) if percent < 100 else 1 << 31
    posted = classes.filter(F.col("n") >= least).select("cid", "n", F.posexplode("prefix").alias("pos", "token"))
    # of the smaller of two linked sets, where the first shared shingle can be: what is left from there on is the least overlap or more
    posted = posted.select("token", "cid", (F.col("pos").cast("long") * (100 + percent) <= F.col("n").cast("long") * (100 - percent)).alias("short"))
    # shingles in prefixes of two classes or more, each with leaders; cids tell nothing of the sets, so the least and the greatest are as good as any
    leads = F.when(F.col("short"), F.col("cid"))
    shared = posted.groupBy("token").agg(F.count("*").alias("members"), F.min(leads).alias("first"), F.max(leads).alias("second")).filter("members > 1 and first is not null")
    members = written(posted.join(shared.select("token", "first", "second"), "token"), "jaccard-members")
    known = classes.select("cid", "n", "bitmap")
    found, labels = None, None
    for leader in ("first", "second"):
        led = members.filter(F.col("cid") != F.col(leader)).select(F.least("cid", leader).alias("a"), F.greatest("cid", leader).alias("b")).distinct()
        if found is not None:
            led = _apart(led, labels)
        led = written(_hopeful(led, known, percent), "jaccard-led")
        new = verified(led, class_sets(docs, classes, led, shingle), percent)
        found = written(new if found is None else found.unionByName(new), "jaccard-led-links")
        joined = components(found).withColumnRenamed("node", "cid")
        labels = written(classes.select("cid", "n", "band").join(joined, "cid", "left").select("cid", "n", "band", F.coalesce("root", "cid").alias("label")), "jaccard-labels")

    homes = F.array(F.struct(F.lit(0).alias("up"), F.lit(True).alias("home")), F.struct(F.lit(1).alias("up"), F.lit(False).alias("home")))
    placed = members.join(labels, "cid").select("token", "cid", "n", "label", "short", F.inline(homes), F.col("band").alias("own_band"))
    # in the band above a class is the smaller one
    placed = placed.filter("home or short").select("token", (F.col("own_band") + F.col("up")).alias("band"), "home", "short", "cid", "n", "label")
    # tiles of one label have no pairs left
    tiles = placed.groupBy("token", "band").agg(
        F.count("*").alias("members"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.bool_or("home").alias("any_home"), F.bool_or("short").alias("any_short")
    )
    tiles = tiles.filter("lo <> hi and any_home and any_short").select("token", "band", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    cut = placed.join(tiles, ["token", "band"]).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "own").alias("block_1"), F.greatest(k, "own").alias("block_2")))
    cut = cut.select("token", "band", "home", "short", "cid", "n", "label", "own", F.inline(others))
    key = ["token", "band", "block_1", "block_2"]
    seen = cut.join(known.select("cid", "bitmap"), "cid").select(*key, "home", "short", "cid", "n", "label", "own", "bitmap")
    dealt = seen.repartition(*key).sortWithinPartitions(*key)
    pairs = written(dealt.mapInArrow(_tile_pairs(percent), "a long, b long").distinct(), "jaccard-pairs")
    later = verified(pairs, class_sets(docs, classes, pairs, shingle), percent)
    more = written(found.unionByName(later), "jaccard-links")
    return components(more)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose classes have different labels."""
    sides = pairs
    for side in "ab":
        sides = sides.join(labels.select(F.col("cid").alias(side), F.col("label").alias(f"label_{side}")), side)
    return sides.filter("label_a <> label_b").select("a", "b")


def _hopeful(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) whose sizes and bitmaps allow the overlap they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b")]
            each = np.arange(batch.num_rows)
            apart = bits_apart(folded([*batch.column("bitmap_a").to_pylist(), *batch.column("bitmap_b").to_pylist()]), each, each + batch.num_rows)
            least = required(n[0], n[1], percent)
            keep = pa.array((np.minimum(n[0], n[1]) >= least) & ((n[0] + n[1] - apart) // 2 >= least))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    sides = pairs
    for side in "ab":
        sides = sides.join(known.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bitmap_{side}")), side)
    return sides.select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the least id reachable by links)."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be between 1 and 100")
    with arrow_batches(docs.sparkSession, "8m"):
        return _components(docs.select("doc_id", "text"), shingle, percent)


def _components(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    rows = prints(docs, shingle, percent)
    same = ["s1", "s2", "n"]
    classes = rows.filter("n > 0").groupBy(*same).agg(
        F.min("doc_id").alias("least"), F.min("band").alias("band"), F.min(F.struct("t1", "t2")).alias("t"), F.any_value("prefix").alias("prefix"), F.any_value("bitmap").alias("bitmap")
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    own = rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), *same)
    if classes.isEmpty():
        return own.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = near_classes(docs, classes, shingle, percent)
    rooted = classes.select(*same, "cid", "least").join(linked.withColumnRenamed("node", "cid"), "cid", "left").select(*same, "least", F.coalesce("root", "cid").alias("root"))
    rooted = written(rooted, "jaccard-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = written(rooted.join(least, "root").select(*same, "component_id"), "jaccard-components")
    worded = own.filter("n_shingles > 0").join(of_class, same).select("doc_id", "n_shingles", "component_id")
    return worded.unionByName(own.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
