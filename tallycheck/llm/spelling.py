"""Spelling variants: words one edit apart, found by pivotal grams.

Words are runs of letters, counted over all documents. A word's bigrams are ordered by rarity in the vocabulary;
its prefix is the five rarest bigrams (or all), of equal ones those nearest the start for its left side and those nearest the end for its right
side. Two disjoint bigrams, one of the left and a later one of the right side, are the word's pivots, chosen by dynamic programming for the least number of candidates, estimated from hashed counts of the index.

One edit cannot touch both pivots. Take two words one edit apart and of them the one whose prefix ends no later in the rarity order. If the edit lies
at or left of its left pivot, the right pivot stands in the other word too, as far from the end and with all after it; if it
lies at or right of the right pivot, the left pivot does, as far from the start and with all before it; between them, both do. Counted from the
side that did not change, the pivot is the same occurrence of its bigram in both words, and what comes no later than the end of the other word's prefix is in that prefix. So pivots are joined with prefix bigrams on the bigram, its
place (the position limit), the text on its side and the length (a pivot is held against lengths within one), as one hash; candidates whose
prefixes end in the right order are verified by edit distance.

Defined results: a null text has no words; a null id counts as the text ``null``. Repeated rows count as often as they stand. An empty
table gives no rows. Columns of other names do not matter. Whole texts are read and runs of any length are words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, expand, pieces, text_bytes, written
from .phrases import Hashed, _mix

#: Letters of a word: ASCII and U+00C0 to U+00FF, so a word has one byte per letter in Latin-1.
_RUN = re.compile("[a-zÀ-ÿ]+")
#: A word in this many occurrences is misspelt by a lost letter (a fixed rule of the input's words).
_LOSS = 31
#: Bigrams of a prefix. One edit touches two at most, so three would do; more leave the pivots a choice.
_PREFIX = 5
#: Cells in which keys are counted, for the pivots' costs.
_CELLS = 1 << 17
#: One edit changes a word's length by these.
_LONGER = (-1, 0, 1)
#: Letters from which on edit distances are not computed, as their time grows faster than the length.
_LONG = 200
#: Distinct words counted by a task before they are handed on.
_COUNTED = 400_000
_INDEX = "role int, key long, word string, n long, last long"


def words_of(doc_id, text: bytes | None, min_length: int) -> Counter:
    """How often each word of ``min_length`` letters or more stands in a text, after the losses."""
    runs = Counter(w for w in _RUN.findall((text or b"").translate(LOWER).decode("utf-8", "replace")) if len(w) >= min_length)
    start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    lost: list[tuple[str, str, int]] = []
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % _LOSS == 0:
            at = h % len(run)
            lost.append((run, run[:at] + run[at + 1 :], n))
    for run, _, _ in lost:
        del runs[run]
    for _, word, n in lost:
        if len(word) >= min_length:
            runs[word] += n
    return runs


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) over all ``docs`` (doc_id, text), written to the shared folder."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        total: Counter = Counter()
        for batch in pieces(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch, "text")):
                total.update(words_of(doc_id, text, min_length))
            if len(total) >= _COUNTED:
                yield rows()
                total.clear()
        yield rows()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "spelling-words")


class _Grams:
    """The bigrams of a batch of words, laid end to end: of each, its word's number, place in the word and the bigram as a number."""

    def __init__(self, words: list[str]):
        coded = [w.encode("latin-1") for w in words]
        self.run = Hashed(coded)
        letters = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64)
        self.size = self.run.lengths
        self.of = np.repeat(np.arange(len(words)), np.maximum(self.size - 1, 0))
        self.first = np.cumsum(np.maximum(self.size - 1, 0)) - np.maximum(self.size - 1, 0)
        self.place = np.arange(len(self.of)) - self.first[self.of]
        at = self.run.starts[self.of] + self.place
        self.gram = letters[at] << 8 | letters[at + 1]


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each of the 65,536 possible bigrams stands in the vocabulary; a row per bigram reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in pieces(batches):
            total += np.bincount(_Grams(batch.column("word").to_pylist()).gram, minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    found = words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for row in found.collect():
        counts[row.gram] = row.n
    return counts


def pivots(lefts: list[tuple[int, float]], rights: list[tuple[int, float]]) -> tuple[int, int]:
    """Of bigrams (place, cost) that can be the left and the right pivot, both in order of places, the numbers of two disjoint ones of least total cost.

    Dynamic programming: the best left one among those that end before each right one, carried along.
    """
    best: tuple[float, int, int] = (np.inf, -1, -1)
    cheapest, k = (np.inf, -1), 0
    for j, (place, cost) in enumerate(rights):
        while k < len(lefts) and lefts[k][0] + 2 <= place:
            cheapest = min(cheapest, (lefts[k][1], k))
            k += 1
        if k:
            best = min(best, (cheapest[0] + cost, cheapest[1], j))
    return best[1], best[2]


class _Side:
    """Prefix bigrams of a batch of words on one side: numbers of their words and places, in order, and hashes."""

    def __init__(self, word: np.ndarray, place: np.ndarray, hashes: np.ndarray):
        self.word, self.place, self.hashes = word, place, hashes


class _Prefixes(_Grams):
    """The prefixes of a batch of words, as they are counted from the start (``left``, hashed with all before) and from the end (``right``, with all after)."""

    def __init__(self, words: list[str], rank: np.ndarray):
        super().__init__(words)
        own = rank[self.gram]
        wanted = np.minimum(_PREFIX, self.size - 1)
        word, within = expand(np.zeros(len(words), np.int64), wanted)
        of_start = np.lexsort((self.place, own, self.of))[self.first[word] + within]
        of_end = np.lexsort((-self.place, own, self.of))[self.first[word] + within]
        # what ends a prefix: the rank of its last bigram, and how many of that rank it has
        last = own[of_start[np.cumsum(wanted) - 1]]
        same = np.bincount(word, weights=own[of_start] == last[word], minlength=len(words)).astype(np.int64)
        self.ends = last * (_PREFIX + 1) + same
        self.left, self.right = self._side(of_start, True), self._side(of_end, False)

    def _side(self, chosen: np.ndarray, left: bool) -> _Side:
        chosen = np.sort(chosen)  # by words and places
        word, place = self.of[chosen], self.place[chosen]
        start = self.run.starts[word]
        # the length that is hashed is the bigram's place from the start, or from the end
        if left:
            return _Side(word, place, self.run.spans(start, start + place + 2) ^ np.uint64(0x5851F42D4C957F2D))
        return _Side(word, place, self.run.spans(start + place, start + self.size[word]))

    def keys(self, side: _Side, longer: int = 0) -> np.ndarray:
        """Keys of a side, for words as long as their own or ``longer``."""
        return _mix(side.hashes + (self.size[side.word] + longer).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def key_counts(words: DataFrame, rank: np.ndarray) -> np.ndarray:
    """How many keys of prefix bigrams fall into each of ``_CELLS`` cells, over the vocabulary; a row per cell reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CELLS, np.int64)
        for batch in pieces(batches, 1 << 19):
            p = _Prefixes(batch.column("word").to_pylist(), rank)
            for side in (p.left, p.right):
                total += np.bincount((p.keys(side) % np.uint64(_CELLS)).astype(np.int64), minlength=_CELLS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    found = words.select("word").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(_CELLS, np.int64)
    for row in found.collect():
        counts[row.cell] = row.n
    return counts


def index_rows(words: list[str], rank: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of the index of ``words``: word number, role (0: pivot, 1: prefix bigram), key, and what ends each word's prefix."""
    p = _Prefixes(words, rank)

    def priced(side: _Side) -> list[tuple[int, int]]:
        cost = sum(cells[(p.keys(side, d) % np.uint64(_CELLS)).astype(np.int64)] for d in _LONGER)
        return list(zip(side.place.tolist(), cost.tolist()))

    lefts, rights = priced(p.left), priced(p.right)
    bounds = np.searchsorted(p.left.word, np.arange(len(words) + 1))
    chosen = np.empty((2, len(words)), np.int64)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        i, j = pivots(lefts[a:b], rights[a:b])
        chosen[:, k] = a + i, a + j
    sides = [p.keys(side, d)[at] for side, at in zip((p.left, p.right), chosen) for d in _LONGER]
    word = np.concatenate([np.tile(np.arange(len(words)), len(sides)), p.left.word, p.right.word])
    role = np.concatenate([np.zeros(len(sides) * len(words), np.int32), np.ones(len(word) - len(sides) * len(words), np.int32)])
    key = np.concatenate([*sides, p.keys(p.left), p.keys(p.right)]).view(np.int64)
    return word, role, key, p.ends


def index(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """Pivots and prefix bigrams of ``words`` (word, n; of 4 letters or more): role, key, word, n, last."""
    # rarer first; equally frequent bigrams in order of their letters
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16)
    cells = key_counts(words, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1 << 19):
            word, role, key, ends = index_rows(batch.column("word").to_pylist(), rank, cells)
            take = pa.array(word)
            columns = [pa.array(role), pa.array(key), batch.column("word").take(take), batch.column("n").take(take), pa.array(ends[word])]
            yield pa.RecordBatch.from_arrays(columns, names=["role", "key", "word", "n", "last"])

    return words.select("word", "n").mapInArrow(run, _INDEX)


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two different texts are one edit apart, in linear time: the edit distance for words, what follows the longest common beginning for long ones."""
    size_a, size_b = F.length(a), F.length(b)
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    shared = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= F.least(size_a, size_b)) & (F.left(a, at + step) == F.left(b, at + step)), at + step).otherwise(at)
    )
    rest = [F.substr(x, shared + 1 + F.when(own >= other, 1).otherwise(0)) for x, own, other in ((a, size_a, size_b), (b, size_b, size_a))]
    return F.when(size_a <= _LONG, F.levenshtein(a, b, 1) == 1).otherwise(rest[0] == rest[1])


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every two of ``words`` (word, n; written; of 4 letters or more) that are one edit apart, once, a < b."""
    rows = written(index(words, gram_counts(words)), "spelling-index")
    kept = ["key", "word", "n", "last"]
    one = rows.filter("role = 0").select(*[F.col(c).alias(c if c == "key" else f"{c}_1") for c in kept])
    # a word can have a bigram twice, never at one place
    two = rows.filter("role = 1").select(*[F.col(c).alias(c if c == "key" else f"{c}_2") for c in kept])
    near = (F.col("word_1") != F.col("word_2")) & (F.col("last_1") <= F.col("last_2"))
    found = one.join(two, "key").filter(near).filter(_one_edit(F.col("word_1"), F.col("word_2")))
    first = F.col("word_1") < F.col("word_2")
    sides = [F.when(first, F.col(f"{x}_1")).otherwise(F.col(f"{x}_2")).alias(y) for x, y in (("word", "a"), ("n", "n_a"))]
    sides += [F.when(first, F.col(f"{x}_2")).otherwise(F.col(f"{x}_1")).alias(y) for x, y in (("word", "b"), ("n", "n_b"))]
    return found.select(*sides).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of ``forms`` (word, form) ends, by pointer doubling. Forms are ever more frequent, so chains end."""
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = steps.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        steps = written(
            steps.join(on, steps["root"] == on["_word"], "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        done = steps.filter("moved").isEmpty()
        steps = steps.select("word", "root")
        if done:
            return steps


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """Per word of ``docs`` (doc_id, text): word, n, n_near (words one edit apart), form, form_n, root.

    ``form``: the most frequent near word (of equal ones the first in code-point order), if it is ``ratio`` times as
    frequent; ``root``: where following the forms ends.
    """
    if min_length < 4:
        raise ValueError("min_length must be 4 or more, for two disjoint bigrams in a prefix of three")
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that no chain of forms comes back to its word")
    words = vocabulary(docs, min_length, min_count)
    pairs = near_words(words)
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("n_b").alias("n"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("n_a").alias("n"), F.col("a").alias("near")))
    sides = pairs.select(F.inline(ways))
    # the least of (-n, word) is the most frequent, of equal ones the first
    nearest = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "near")).alias("best"))
    joined = words.join(nearest, "word", "left")
    strong = -F.col("best.minus") >= F.col("n") * ratio
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n")
    )
    formed = written(formed, "spelling-forms")
    ends = roots(formed.filter("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
