"""Toxicity scores by a logistic classifier that is indifferent to identity terms.

Features are the words of a text and their beginnings: that they occur, and that they make up one word in ``DENSE`` or more. From a bounded sample of labelled rows those that tell the
labels apart are chosen, and weights are fitted to the labels with two penalties: their squares, and the squared change of the
score when the identity terms of a labelled sentence are swapped for each other (the counterfactual). A weight on a
group's name thus costs more than it earns, and neutral mentions are not marked as toxic.

Defined results: a null or empty text has no features and the score of the intercept. Equal texts get equal scores; each row of the
input gives one row. Labels that are null or held out are not learnt from; without labels of both kinds the score is
the share of label 1 (0.5 without any). An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, pieces, written
from .rule_quality import sample_labels

#: Words that name groups of people; a parameter of the fit.
IDENTITY_TERMS = tuple(
    "women men woman man girls boys female male muslims muslim christians christian jews jewish hindus hindu buddhist catholic atheist "
    "black white asian african european american mexican latino arab indian chinese gay lesbian bisexual transgender queer straight "
    "immigrants immigrant refugees refugee foreigners disabled blind deaf elderly old young poor rich".split()
)
#: Lengths of word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
#: A feature is dense if it has one word in so many, at least.
DENSE = 200
#: Words that a worker remembers the features of.
REMEMBERED = 300_000
_SPACE = {c: " " for c in range(128) if not chr(c).isalnum()}


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().translate(_SPACE).split()


def features_of_word(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def counterfactual(words: Sequence[str], terms: Sequence[str] = IDENTITY_TERMS) -> list[str] | None:
    """The words with each identity term replaced by the next one of the list; None if there is none."""
    place = {t: k for k, t in enumerate(terms)}
    if not any(w in place for w in words):
        return None
    return [terms[(place[w] + 1) % len(terms)] if w in place else w for w in words]


def features_of(words: Sequence[str], features_of_word=features_of_word) -> tuple[set, set]:
    """Features that occur in a text, and those that are dense in it."""
    counts: Counter = Counter()
    for word, n in Counter(words).items():
        for f in features_of_word(word):
            counts[f] += n
    return set(counts), {f for f, n in counts.items() if n * DENSE >= len(words)}


class Lookup(dict):
    """Feature numbers of words, remembered: those of a feature that occurs and of one that is dense (-1: not in the model)."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self._numbers = numbers

    def __missing__(self, word: str) -> tuple[tuple[int, int], ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        both = ((self._numbers.get(f, -1), self._numbers.get("~" + f, -1)) for f in features_of_word(word))
        found = self[word] = tuple(x for x in both if max(x) >= 0)
        return found

    def of(self, words: Sequence[str]) -> list[int]:
        counts: dict[tuple[int, int], int] = {}
        for hits in filter(None, map(self.__getitem__, words)):
            for f in hits:
                counts[f] = counts.get(f, 0) + 1
        found = {f[0] for f in counts} | {f[1] for f, n in counts.items() if n * DENSE >= len(words)}
        return sorted(found - {-1})


@dataclass
class ToxicityModel:
    intercept: float = 0.0
    numbers: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    def scores(self, texts: Sequence[str | None], lookup: Lookup) -> np.ndarray:
        total = np.array([self.intercept + sum(self.weights[k] for k in lookup.of(words_of(x))) for x in texts], np.float64)
        return 1 / (1 + np.exp(-total))


class _Sparse:
    """Rows of feature numbers, as 0/1."""

    def __init__(self, rows: Sequence[Sequence[int]], width: int):
        self.n, self.width = len(rows), width
        self.owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.fromiter((k for r in rows for k in r), np.int64, len(self.owner))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.column], self.n)

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, v[self.owner], self.width)


def fit_weights(rows, swapped, y, width: int, ridge: float = 1e-3, fairness: float = 5.0, steps: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated gradient steps. ``swapped``: pairs (row, its counterfactual's features)."""
    x = _Sparse(rows, width)
    own = _Sparse([rows[k] for k, _ in swapped], width)
    other = _Sparse([r for _, r in swapped], width)
    y = np.asarray(y, np.float64)
    n, pairs = len(y), max(len(swapped), 1)
    most = max((len(r) for r in rows), default=1) + 1
    change = max((len(set(rows[k]) ^ set(r)) for k, r in swapped), default=0)
    step = 1 / (0.25 * most + ridge + 2 * fairness * change)
    w, b = np.zeros(width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    aw, ab, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(x.dot(aw) + ab))) - y
        gradient = x.back(error) / n + ridge * aw
        if swapped:
            gap = own.dot(aw) - other.dot(aw)
            gradient += 2 * fairness * (own.back(gap) - other.back(gap)) / pairs
        new_w, new_b = aw - step * gradient, ab - step * error.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        aw, ab = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return b, w


def _sampled_texts(docs: DataFrame, sample: dict[int, int], spark: SparkSession) -> DataFrame:
    """(y, text) of the documents in the sample, one per id, written to the shared folder."""
    sent = spark.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = sent.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [k for k, i in enumerate(ids) if i in labels]
            if rows:
                own = [pa.array([ids[k] for k in rows], pa.int64()), pa.array([labels[ids[k]] for k in rows], pa.int32())]
                yield pa.RecordBatch.from_arrays([*own, batch.column("text").take(pa.array(rows))], names=["doc_id", "y", "text"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, y int, text string")
    return written(found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("y", "text"), "toxicity-sample")


def _feature_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                present, dense = features_of(words_of(text))
                for f in present:
                    counts.setdefault(f, [0, 0])[y] += 1
                for f in dense:
                    counts.setdefault("~" + f, [0, 0])[y] += 1
            if len(counts) > REMEMBERED:
                yield _counted(counts)
                counts = {}
        yield _counted(counts)

    return texts.mapInArrow(run, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    n0, n1 = [x[0] for x in counts.values()], [x[1] for x in counts.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(n0, pa.int64()), pa.array(n1, pa.int64())], names=["feature", "n0", "n1"])


def choose_features(texts: DataFrame, terms: Sequence[str], n0: int, n1: int, most: int = 3000, least_rows: int = 3) -> dict[str, int]:
    """Features in ``least_rows`` sampled texts or more with the greatest chi-square, and the identity terms themselves."""
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    n, both = float(n0 + n1), F.col("n1") + F.col("n0")
    chi = n * F.pow(a * (n0 - b) - b * (n1 - a), F.lit(2.0)) / (both * (n - both + 1e-9) * float(n0) * float(n1) + 1e-9)
    best = _feature_counts(texts).filter(both >= least_rows).withColumn("chi", chi).filter("chi > 6.63")
    chosen = [r.feature for r in best.orderBy(F.desc("chi"), "feature").limit(most).select("feature").collect()]
    return {f: k for k, f in enumerate(dict.fromkeys([*chosen, *("=" + t for t in terms)]))}


def _encoded(texts: DataFrame, numbers: dict[str, int], terms: Sequence[str]) -> list:
    """Of each sampled text: label, features, features of its counterfactual (null if it names no group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(numbers)
        for batch in batches:
            words = [words_of(x) for x in batch.column("text").to_pylist()]
            other = [counterfactual(w, terms) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y"),
                    pa.array([lookup.of(w) for w in words], pa.list_(pa.int32())),
                    pa.array([None if w is None else lookup.of(w) for w in other], pa.list_(pa.int32())),
                ],
                names=["y", "x", "other"],
            )

    return texts.mapInArrow(run, "y int, x array<int>, other array<int>").collect()


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", terms: Sequence[str] = IDENTITY_TERMS, sample_rows: int = 20_000, seed: int = 8) -> ToxicityModel:
    """A model from at most ``sample_rows`` labelled rows."""
    spark = docs.sparkSession
    sample = {r.doc_id: int(r.y) for r in sample_labels(labels, label, sample_rows, seed).collect()}
    texts = _sampled_texts(docs, sample, spark)
    seen = {r.y: r["count"] for r in texts.groupBy("y").count().collect()}
    n0, n1 = seen.get(0, 0), seen.get(1, 0)
    if not n0 or not n1:
        return ToxicityModel(float(np.log((n1 + 1) / (n0 + 1))))
    numbers = choose_features(texts, terms, n0, n1)
    rows = sorted(_encoded(texts, numbers, terms), key=repr)
    swapped = [(k, r.other) for k, r in enumerate(rows) if r.other is not None]
    bias, weights = fit_weights([r.x for r in rows], swapped, [r.y for r in rows], len(numbers))
    return ToxicityModel(bias, numbers, weights)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.3, **fit) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted. The model is sent to the tasks; its size is bounded by its number of features."""
    model = fit_toxicity(docs, labels, label, **fit)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(sent.value.numbers)
        for batch in pieces(batches):
            scores = sent.value.scores(batch.column("text").to_pylist(), lookup)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
