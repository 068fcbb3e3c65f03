"""Quality scores by a sparse rule ensemble over text statistics.

Statistics of the whole text are computed once per document. Small regression trees are grown by boosting on a bounded sample of
labelled rows; every path from a root to a node is a conjunctive rule. Lasso logistic
regression gives the rules weights, most of them 0, and the rules left are compiled into one Spark column over the statistics.

Defined results: a null or empty text has all statistics 0 and the score the rules give to that. Rows with equal texts get
equal scores; a repeated row is scored again. Labels that are null, or whose rows are held out, are not learnt from; without labels of both
kinds the score is the share of label 1 (0.5 without any). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, packed, pieces, text_bytes, unpacked, written

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "upper", "digits", "marks", "symbols", "pipes", "exclaims", "spaces",
    "distinct", "adjacent", "line_words", "distinct_lines", "sentence_ends", "long_words",
)
_PREFIX = "_stat_"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_MARKS = b".,;:?'\"()-"
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{}~"


def statistics(text: bytes | None) -> tuple[float, ...]:
    text = text or b""
    words = text.split()
    n, k = len(text), len(words)
    if not k:
        return (float(np.log1p(n)), *[0.0] * (len(STATISTICS) - 1))

    def share(kind: bytes) -> float:
        return (n - len(text.translate(None, kind))) / n

    letters = max(share(_LETTERS), 1e-9)
    lines = [x for x in text.split(b"\n") if x]
    ends = text.count(b". ") + text.count(b".\n") + text.count(b"? ") + (text[-1:] in (b".", b"?"))
    return (
        float(np.log1p(n)),
        float(np.log1p(k)),
        sum(map(len, words)) / k,
        share(_UPPER) / letters,
        share(_DIGITS),
        share(_MARKS),
        share(_SYMBOLS),
        share(b"|"),
        share(b"!"),
        share(b" \t"),
        len(set(words)) / k,
        sum(map(eq, words, words[1:])) / k,
        float(np.log1p(k / len(lines))),
        len(set(lines)) / len(lines),
        ends / k,
        sum(len(w) > 20 for w in words) / k,
    )


def with_statistics(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and a column per statistic of its column text."""
    keep = list(keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"{_PREFIX}{s} double" for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            table = np.array([statistics(x) for x in text_bytes(batch, "text")], np.float64).reshape(-1, len(STATISTICS))
            arrays = [*(batch.column(c) for c in keep), *(pa.array(np.ascontiguousarray(x)) for x in table.T)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(_PREFIX + s for s in STATISTICS)])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, ", ".join(fields))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, above, value): the statistic is above ``value``, or not."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, above, value in self.conditions:
            out &= (x[:, j] > value) == above
        return out

    def column(self, prefix: str = _PREFIX) -> Column:
        out = F.lit(True)
        for j, above, value in self.conditions:
            stat = F.col(prefix + STATISTICS[j])
            out = out & (stat > value if above else stat <= value)
        return out


@dataclass
class RuleEnsemble:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))

    def column(self, prefix: str = _PREFIX) -> Column:
        terms = [F.lit(self.intercept)]
        terms += [F.when(rule.column(prefix), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        while len(terms) > 1:  # added in pairs, so that the expression is not deep
            terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2 :]
        return 1 / (1 + F.exp(-terms[0]))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _grow(binned: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, stats: np.ndarray, depth: int, least: int, path: tuple = ()) -> tuple[list[tuple], list[tuple[np.ndarray, float]]]:
    """A regression tree on ``rows``: the paths of its nodes, and its leaves as (rows, mean residual)."""
    best, split = 1e-9, None
    own = residual[rows]
    total, n = own.sum(), len(rows)
    if depth and n >= 2 * least:
        for j in stats:
            size = len(cuts[j]) + 1
            sums = np.cumsum(np.bincount(binned[rows, j], own, size))[:-1]
            counts = np.cumsum(np.bincount(binned[rows, j], minlength=size))[:-1]
            ok = (counts >= least) & (n - counts >= least)
            if ok.any():
                gain = np.where(ok, sums**2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(n - counts, 1) - total**2 / n, -1)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, split = gain[k], (int(j), k)
    if split is None:
        return ([path] if path else []), [(rows, total / max(n, 1))]
    j, k = split
    above = binned[rows, j] > k
    paths, leaves = ([path] if path else []), []
    for side in (False, True):
        more, ends = _grow(binned, cuts, residual, rows[above == side], stats, depth - 1, least, (*path, (j, side, float(cuts[j][k]))))
        paths += more
        leaves += ends
    return paths, leaves


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, bins: int = 64, seed: int = 5) -> list[Rule]:
    """Paths of boosted trees, each grown on half of the rows and of the statistics; equal rules once."""
    rng = np.random.default_rng(seed)
    cuts = _cuts(x, bins)
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
    total = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        rows = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        stats = np.sort(rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False))
        paths, leaves = _grow(binned, cuts, y - chance, rows, stats, depth, max(5, len(y) // 500))
        rules |= {Rule(tuple(sorted(set(p)))): None for p in paths}
        for own, mean in leaves:
            total[own] += 1.5 * mean / max((chance[own] * (1 - chance[own])).mean(), 0.05) * 0.3
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps; the intercept has no penalty."""
    n, m = z.shape
    weights, bias = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead_w, ahead_b, t = weights.copy(), bias, 1.0
    vector = np.ones(m)
    for _ in range(30):
        vector = z.T @ (z @ vector)
        norm = np.linalg.norm(vector)
        vector /= max(norm, 1e-12)
    step = 1 / (0.25 * (norm / n + 1))
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ ahead_w + ahead_b))) - y
        new_w = ahead_w - step * (z.T @ error) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_b = ahead_b - step * error.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = new_w + (t - 1) / new_t * (new_w - weights)
        ahead_b = new_b + (t - 1) / new_t * (new_b - bias)
        weights, bias, t = new_w, new_b, new_t
    return float(bias), weights


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 2e-4, **grow) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))))
    rules = extract_rules(x, y, **grow)
    z = np.stack([r.holds(x) for r in rules], 1).astype(np.float32)
    mean, spread = z.mean(axis=0, dtype=np.float64), z.std(axis=0, dtype=np.float64)
    some = np.flatnonzero(spread > 1e-9)
    rules, z, mean, spread = [rules[k] for k in some], z[:, some], mean[some], spread[some]
    z -= mean
    z /= spread
    bias, weights = lasso_logistic(z, y, penalty)
    weights = weights / spread
    kept = [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6]
    return RuleEnsemble(bias - float((mean * weights).sum()), kept)


def sample_labels(labels: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows (doc_id, y) of ``labels`` that may be learnt from, by a hash of their id; of several labels of an id the greatest."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    single = usable.groupBy("doc_id").agg(F.max(label).alias("y"))
    return single.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7, sample_rows: int = 10_000, seed: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted and two hashes of the text (t1, t2).

    ``sample_rows``: most labelled rows to fit on. Every document is scored on its whole text.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("tie"), F.col("text")).alias("t2"))
    stats = written(with_statistics(hashed, ["doc_id", "t1", "t2"]), "quality-statistics")
    sample = sample_labels(labels, label, sample_rows, seed)
    # of rows with one id one is learnt from, so the driver gets sample_rows at most
    single = stats.join(sample, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(*(_PREFIX + s for s in STATISTICS))).alias("s"))
    rows = single.select("doc_id", "y", "s.*").toPandas().sort_values("doc_id")
    model = fit(rows[[_PREFIX + s for s in STATISTICS]].to_numpy(np.float64), rows["y"].to_numpy(np.float64), seed=seed)
    score = model.column()
    return stats.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"), "t1", "t2"
    )


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7, sample_rows: int = 10_000, seed: int = 5) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with their own columns."""
    scored = score_quality(docs, labels, label, threshold, sample_rows, seed).filter("predicted = 1")
    good = written(scored.select(F.col("doc_id").alias("id"), "t1", "t2").distinct(), "quality-kept")
    own = F.col("own")
    hashed = packed(docs).withColumns({"h1": F.xxhash64(own["text"]), "h2": F.xxhash64(F.lit("tie"), own["text"])})
    same = own["doc_id"].eqNullSafe(F.col("id")) & (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2"))
    return unpacked(hashed.join(good, same, "left_semi"))
