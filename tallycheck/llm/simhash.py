"""SimHash near-duplicates: fingerprints within ``max_bits`` bits, found by the generalised pigeonhole principle.

Fingerprints (of documents' word shingles) are reduced to distinct ones. Their bits are grouped into m
parts, correlated bits together; a part has a threshold t_i, unequal and -1 for a part that is passed over, with
sum(t_i) = max_bits - m + 1. Two fingerprints within ``max_bits`` bits then differ in t_i bits or fewer in at least one part i:
if they differed in t_i + 1 or more in all, they would differ in max_bits + 1. The thresholds (and m) are chosen by dynamic programming on estimated costs: probes, and
candidates from a chain model of how often two fingerprints agree on neighbouring bits of a part, whose figures
come from counts of bits and bit pairs over all fingerprints. Each fingerprint is probed by the values within
t_i bits of its part i, candidates are verified on all bits, and linked fingerprints join to components.

Defined results: a null text is empty and has fingerprint 0, linked like any other. Equal ids in different rows stay separate rows. A
component is known by its least non-null id (null if it has none). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, text_bytes, unpacked, written
from .components import components
from .simhash_fp import fingerprint

BITS = 64
#: What a probe costs beside the verification of a candidate.
PROBE_COST = 20.0
#: Values probed per part at most; thresholds above this are not considered.
MOST_PROBES = 4096


def with_fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, seed: int = 42) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``fp`` (long), from its column text."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(x, shingle, seed) for x in text_bytes(batch, "text")]
            values = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(values)], names=[*keep, "fp"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, fp long")


def bit_pairs(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Over all ``fp``: how many there are, and for bits i, j in how many both are 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        sums = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["cell", "n"])

    cells = prints.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    sums = np.zeros(BITS * BITS + 1)
    for row in cells.collect():  # one row per cell of the matrix
        sums[row.cell] = row.n
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: each begins with the most correlated free pair and takes the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, -1)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        rows = np.array(free)
        i, j = np.unravel_index(np.argmax(corr[np.ix_(rows, rows)]), (len(rows), len(rows)))
        group = [int(rows[i]), int(rows[j])][: max(1, size)]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].mean(), -b)))
        free = [b for b in free if b not in group]
        groups.append(group)
    return groups


def distance_chances(group: list[int], both: np.ndarray, n: int, most: int) -> np.ndarray:
    """Estimated chance that two fingerprints differ in 0 .. ``most`` bits of a group, along a chain of its bits."""
    ones = np.diag(both) / max(n, 1)
    agree = ones**2 + (1 - ones) ** 2

    def joint(b: int, c: int) -> np.ndarray:
        p11 = both[b, c] / max(n, 1)
        p10, p01 = ones[b] - p11, ones[c] - p11
        p00 = 1 - p11 - p10 - p01
        same = p11**2 + p10**2 + p01**2 + p00**2
        table = np.array([[same, agree[b] - same], [agree[c] - same, 1 - agree[b] - agree[c] + same]])
        return np.maximum(table, 1e-300)  # [b differs, c differs]

    state = np.zeros((2, most + 2))
    state[0, 0], state[1, 1] = agree[group[0]], 1 - agree[group[0]]
    for b, c in zip(group, group[1:]):
        step = joint(b, c)
        step /= step.sum(axis=1, keepdims=True)
        new = np.zeros_like(state)
        new[0] = step[0, 0] * state[0] + step[1, 0] * state[1]
        new[1, 1:] = (step[0, 1] * state[0] + step[1, 1] * state[1])[:-1]
        state = new
    return state.sum(axis=0)[: most + 1]


@dataclass
class Plan:
    groups: list[list[int]]
    thresholds: list[int]
    cost: float


def allocate(groups: list[list[int]], both: np.ndarray, n: int, max_bits: int) -> Plan:
    """Thresholds of least estimated cost with sum ``max_bits`` - parts + 1, by dynamic programming over the parts."""
    costs = []
    for group in groups:
        chance = np.cumsum(distance_chances(group, both, n, max_bits))
        probes = np.cumsum([comb(len(group), k) for k in range(max_bits + 1)])
        cost = n * PROBE_COST * (1 + probes) + n * (n / 2) * chance
        costs.append([0.0, *np.where(probes <= MOST_PROBES, cost, np.inf)])  # from -1
    # thresholds are counted from -1, so that they sum to max_bits + 1
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (max_bits + 1)
    for cost in costs:
        best = [min(((best[s - t][0] + cost[t], best[s - t][1] + [t]) for t in range(s + 1)), key=lambda x: x[0]) for s in range(max_bits + 2)]
    total, chosen = best[max_bits + 1]
    return Plan(groups, [t - 1 for t in chosen], total)


def plan_probes(prints: DataFrame, max_bits: int) -> Plan:
    """The cheapest plan over numbers of parts, from counts over all fingerprints."""
    n, both = bit_pairs(prints)
    plans = [allocate(group_bits(both, n, m), both, n, max_bits) for m in range(1, max_bits + 3)]
    return min(plans, key=lambda p: p.cost)


def _mask(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _flips(group: list[int], threshold: int) -> list[int]:
    return [_mask(list(c)) for k in range(threshold + 1) for c in combinations(group, k)]


def links(prints: DataFrame, max_bits: int, plan: Plan | None = None) -> DataFrame:
    """(a, b) of distinct fingerprints (``fp``, written) that differ in ``max_bits`` bits or fewer, a < b, each pair once."""
    plan = plan or plan_probes(prints, max_bits)
    parts = [(_mask(g), g, t) for g, t in zip(plan.groups, plan.thresholds) if t >= 0]

    def distance(x: Column, y: Column, mask: int | None = None) -> Column:
        differ = x.bitwiseXOR(y)
        return F.bit_count(differ if mask is None else differ.bitwiseAND(F.lit(mask)))

    found = None
    a, b = F.col("a"), F.col("b")
    for k, (mask, group, threshold) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(mask))
        index = prints.select(F.col("fp").alias("b"), value.alias("key"))
        probe = prints.select(F.col("fp").alias("a"), value.alias("key"))
        if threshold:
            flips = F.explode(F.array(*[F.lit(x) for x in _flips(group, threshold)]))
            probe = probe.select("a", "key", flips.alias("flip")).select("a", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
        near = probe.join(index, (probe["key"] == index["key"]) & (a < b) & (distance(a, b) <= max_bits))
        # a pair counts for the first part that finds it
        for mask_before, _, before in parts[:k]:
            near = near.filter(distance(a, b, mask_before) > before)
        near = near.select("a", "b")
        found = near if found is None else found.unionAll(near)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42, tie: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fp (long), component_id; with ``tie``, also two hashes of the text (t1, t2) and ``root``, a fingerprint of the component."""
    rows = docs.select("doc_id", "text", *([F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("tie"), F.col("text")).alias("t2")] if tie else []))
    keep = [c for c in rows.columns if c != "text"]
    prints = written(with_fingerprints(rows, keep, shingle, seed), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    if classes.isEmpty():
        return prints.select(*keep, "fp", F.col("doc_id").alias("component_id"), *([F.col("fp").alias("root")] if tie else []))
    linked = components(links(classes, max_bits))
    in_classes = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    in_classes = written(in_classes, "simhash-roots")
    least = in_classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = written(in_classes.join(least, "root").select("fp", "component_id", "root"), "simhash-components")
    return prints.join(of_print, "fp").select(*keep, "fp", "component_id", *(["root"] if tie else []))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """One row of each component of ``docs``, with its columns: the one with the least id; of repeated rows any.

    A component without any id keeps one of its rows.
    """
    marked = near_duplicates(docs, shingle, max_bits, seed, tie=True)
    first = marked.groupBy("root").agg(
        F.min("component_id").alias("component_id"), F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.struct("t1", "t2"))).alias("tie")
    )
    first = written(first.select(F.col("component_id").alias("id"), "tie.t1", "tie.t2"), "simhash-kept")
    own = F.col("own")
    hashed = packed(docs).withColumns({"h1": F.xxhash64(own["text"]), "h2": F.xxhash64(F.lit("tie"), own["text"])})
    same = own["doc_id"].eqNullSafe(F.col("id")) & (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2"))
    return unpacked(hashed.join(first, same).dropDuplicates(["id", "h1", "h2"]))
