"""How far the sources of a language differ: exact term frequencies by single-pass in-memory indexing, then pair sums.

Each task reads its documents once and builds the postings (language, term, source: occurrences, documents) of a
block in memory. When a block holds ``block_postings`` it is spilled as a run in term order. Runs are dealt to hash shards by
(language, term); Spark's external sort merges the runs of a shard, and one pass over the merged postings adds up equal ones and
keeps the terms that ``min_docs`` documents of the language have.

Smoothed shares are whole numbers, p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), with V kept terms of the language and N their
occurrences in the group; f(p, q) = floor((p - q)^2 / (p + q)). A pair of sources sums f over all kept terms without a row per term and
pair: terms that only one of both has (or none) depend on counts alone, so they come from histograms of counts, as if no term was
shared; each shared term then adds its correction, streamed from the postings into partial sums per pair.

Defined results: null text, language and source are ''. A group without terms, or without kept ones, still has its pairs; with V = 0 their
value is 0. Repeated rows count as often as they stand. An empty table gives no rows. Columns of other names do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, expand, pieces, text_bytes, written

#: Shares are counted in parts of this.
SCALE = 1_000_000_000
#: Occurrences added to each count.
_ADDED = 2
#: Lower-cased letters and non-ASCII bytes as they are, any other byte as a space.
_FOLD = bytes(LOWER[c] if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of a text whose terms are listed at once.
_PART = 1 << 20
#: Pairs of postings that are worked on at once.
_PAIRS = 1 << 20
_RUN = "lang string, term string, source string, n long, docs long"
_KEPT = "lang string, term string, source string, n long, total long"


def term_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    text, at = text or b"", 0
    while at < len(text):
        # a part ends where a term does
        end = at + _PART
        while end < len(text) and _FOLD[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_FOLD).split()
        at = end


class _Block:
    """Postings of a block of documents, by (language, source)."""

    def __init__(self):
        self._groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: bytes | None) -> None:
        occurrences, documents = self._groups.setdefault((lang, source), (Counter(), Counter()))
        before, own = len(occurrences), set()
        for terms in term_lists(text):
            occurrences.update(terms)
            own.update(terms)
        documents.update(own)
        self.size += len(occurrences) - before

    def run(self, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        """The postings in order of language, term and source."""
        tables = []
        for (lang, source), (occurrences, documents) in self._groups.items():
            terms = list(occurrences)
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                pa.array(list(occurrences.values()), pa.int64()),
                pa.array(list(map(documents.__getitem__, terms)), pa.int64()),
            ]
            tables.append(pa.table(columns, names=["lang", "term", "source", "n", "docs"]))
        if tables:
            yield from pa.concat_tables(tables).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).to_batches(max_chunksize=rows)


def spilled_runs(rows: DataFrame, block_postings: int) -> DataFrame:
    """Term-sorted postings of blocks of ``rows`` (lang, source, text; no nulls): lang, term, source, n, docs."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in pieces(batches):
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), text_bytes(batch, "text")):
                block.add(lang, source, text)
                if block.size >= block_postings:
                    yield from block.run()
                    block = _Block()
        yield from block.run()

    return rows.select("lang", "source", "text").mapInArrow(build, _RUN)


def _starts(*columns: pa.Array) -> np.ndarray:
    """Where any of the (sorted) columns changes, from 0."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        same = np.ones(len(new) - 1, bool)
        for column in columns:
            same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = ~same
    return np.flatnonzero(new)


def _merge(min_docs: int):
    """Sum equal postings of a shard in order, and keep those of terms with ``min_docs`` documents."""

    def settle(table: pa.Table) -> pa.RecordBatch | None:
        if not table.num_rows:
            return None
        table = table.combine_chunks()
        lang, term, source, n, docs = (table.column(k).chunk(0) for k in range(5))
        at = _starts(lang, term, source)
        n, docs = np.add.reduceat(n.to_numpy(), at), np.add.reduceat(docs.to_numpy(), at)
        take = pa.array(at)
        lang, term, source = lang.take(take), term.take(take), source.take(take)
        of_term = _starts(lang, term)
        size = np.diff(np.append(of_term, len(n)))
        keep = np.repeat(np.add.reduceat(docs, of_term) >= min_docs, size)
        total = np.repeat(np.add.reduceat(n, of_term), size)
        kept = pa.array(np.flatnonzero(keep))
        columns = [lang.take(kept), term.take(kept), source.take(kept), pa.array(n[keep]), pa.array(total[keep])]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "source", "n", "total"])

    def summed(table: pa.Table) -> pa.Table:
        """Equal postings as one, so that a term that all runs have stays small."""
        table = table.combine_chunks()
        lang, term, source, n, docs = (table.column(k).chunk(0) for k in range(5))
        at = _starts(lang, term, source)
        take = pa.array(at)
        columns = [lang.take(take), term.take(take), source.take(take), pa.array(np.add.reduceat(n.to_numpy(), at)), pa.array(np.add.reduceat(docs.to_numpy(), at))]
        return pa.table(columns, names=table.column_names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.Table | None = None  # postings of the last term, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = summed(pa.concat_tables([open_, table]) if open_ is not None else table)
            last = int(_starts(table.column(0).chunk(0), table.column(1).chunk(0))[-1])
            done = settle(table.slice(0, last))
            if done is not None:
                yield done
            open_ = table.slice(last)
        if open_ is not None:
            done = settle(open_)
            if done is not None:
                yield done

    return run


def term_frequencies(docs: DataFrame, min_docs: int = 10, block_postings: int = 500_000) -> DataFrame:
    """(lang, term, source, n, total) of terms that ``min_docs`` documents of their language have: occurrences in the source and in
    the language. Written to the shared folder in order of language and term within each file."""
    runs = spilled_runs(docs, block_postings)
    shards = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return written(shards.mapInArrow(_merge(min_docs), _KEPT), "term-frequencies")


def _share(n: Column | str, size: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (n + 2) / (size + 2 * terms)) without a product beyond 64 bits."""
    n, size, terms = (F.col(x) if isinstance(x, str) else x for x in (n, size, terms))
    over, m, step = (n + _ADDED) * 100_000, size + 2 * terms, SCALE // 100_000
    return F.call_function("div", over, m) * step + F.call_function("div", (over % m) * step, m) + 1


def _apart(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What shared terms add to the sums of their pairs: (lang, a, b, part), a < b, partial sums."""

    def sums(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        table = table.combine_chunks()
        lang, term, source = (table.column(k).chunk(0) for k in ("lang", "term", "source"))
        p, base = table.column("p").to_numpy(), table.column("base").to_numpy()
        at = _starts(lang, term)
        size = np.diff(np.append(at, len(p)))
        later = np.repeat(at + size, size) - np.arange(len(p)) - 1  # partners after each posting
        names = pc.dictionary_encode(source)
        code = names.indices.to_numpy().astype(np.int64)
        spoken = pc.dictionary_encode(lang)
        tongue = spoken.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(later)
        begin = 0
        while begin < len(p):
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _PAIRS, "right")))
            one, two = expand(np.arange(begin + 1, end + 1), later[begin:end])
            one = one + begin
            begin = end
            if not len(one):
                continue
            value = apart(p[one], p[two]) - apart(p[one], base[two]) - apart(base[one], p[two]) + apart(base[one], base[two])
            width = len(names.dictionary)
            key = (tongue[one] * width + code[one]) * width + code[two]
            unique, inverse = np.unique(key, return_inverse=True)
            totals = np.zeros(len(unique), np.int64)
            np.add.at(totals, inverse, value)
            columns = [
                spoken.dictionary.take(pa.array(unique // (width * width))),
                names.dictionary.take(pa.array(unique // width % width)),
                names.dictionary.take(pa.array(unique % width)),
                pa.array(totals),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "part"])

    open_: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([open_, table]).combine_chunks() if open_ is not None else table
        last = int(_starts(table.column("lang").chunk(0), table.column("term").chunk(0))[-1])
        yield from sums(table.slice(0, last))
        open_ = table.slice(last)
    if open_ is not None:
        yield from sums(open_)


def divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, block_postings: int = 500_000) -> DataFrame:
    """Per (lang, source) of ``docs`` (text, lang, source): lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language, by how far it is apart. Part ``term``: the ``top`` terms that the source has and
    that have a larger share there than in the language. Equal values are ranked by item.
    """
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    kept = term_frequencies(rows, min_docs, block_postings)
    sized = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("own"))
    # a term's first source stands for it, so terms are counted without another shuffle of them
    spoken = kept.groupBy("lang").agg(F.sum("n").alias("lang_size"))
    terms = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("v"))
    groups = rows.select("lang", "source").distinct().join(sized, ["lang", "source"], "left").join(spoken.join(terms, "lang"), "lang", "left")
    groups = written(groups.na.fill(0, ["size", "own", "v", "lang_size"]), "term-groups")

    shared = groups.select("lang", "source", "size", "v", "lang_size")
    shares = kept.join(shared, ["lang", "source"]).select(
        "lang", "term", "source", "n", _share("n", "size", "v").alias("p"), _share("total", "lang_size", "v").alias("q"), _share(F.lit(0), F.col("size"), F.col("v")).alias("base")
    )
    shares = written(shares, "term-shares")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    typical = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart("p", "q").alias("value"))
    typical = typical.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    corrections = shares.select("lang", "term", "source", "p", "base").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    shared_terms = corrections.mapInArrow(_pair_sums, "lang string, a string, b string, part long")
    # as if no term was shared: a's terms against b's share of an absent term, the rest against each other
    counts = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("times"))
    heads = groups.filter("v > 0").select("lang", "source", "own", "v", _share(F.lit(0), F.col("size"), F.col("v")).alias("base"))
    side_a = heads.select("lang", F.col("source").alias("a"), F.col("own").alias("own_a"), F.col("base").alias("base_a"), "v")
    side_b = heads.select("lang", F.col("source").alias("b"), F.col("own").alias("own_b"), F.col("base").alias("base_b"))
    alone = counts.join(side_b, "lang").filter("a <> b").groupBy("lang", "a", "b").agg(F.sum(_apart("p", "base_b") * F.col("times")).alias("part"))
    alone = alone.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "part")
    absent = side_a.join(side_b, "lang").filter("a < b").select("lang", "a", "b", (_apart("base_a", "base_b") * (F.col("v") - F.col("own_a") - F.col("own_b"))).alias("part"))
    pairs = shared_terms.unionByName(alone).unionByName(absent).groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    pairs = written(pairs, "source-pairs")
    # every pair of the language, also where no term is kept
    names = groups.select("lang", F.col("source").alias("a"))
    both = names.join(groups.select("lang", F.col("source").alias("b")), "lang").filter("a < b")
    valued = both.join(pairs, ["lang", "a", "b"], "left").select("lang", "a", "b", F.coalesce("value", F.lit(0)).alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    apart_ = valued.select("lang", "value", F.inline(sides)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    apart_ = apart_.withColumn("rank", F.row_number().over(best))
    return apart_.unionByName(typical).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
