"""Rolling-hash triggers that cut text into overlapping phrases, in numpy.

Every string of ``length`` bytes has one trigger: the leftmost smallest hash among the grams of
``gram`` bytes inside it. That depends on the string alone, so equal strings have their trigger at
the same place wherever they stand. A phrase is the text of a run of start positions that share a
trigger: it begins at the first of them and ends ``length`` bytes after the last. Phrases overlap by
``length`` - 1 bytes, so that each string of ``length`` bytes starts in exactly one phrase.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Multiplier of the polynomial hash modulo 2^64 (odd, so that it has an inverse).
_BASE = 0x9E3779B97F4A7C15
#: Low bits of a trigger's key that hold its position; a run of texts is shorter than this.
_PLACE = 24
_TABLE = np.random.default_rng(20_240_601).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Shape:
    """``length``: bytes of a string that counts as repeated. ``gram``: bytes of a trigger."""

    length: int = 200
    gram: int = 32

    def __post_init__(self):
        if not 1 <= self.gram <= self.length <= 512:
            raise ValueError("1 <= gram <= length <= 512 is required")


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(x: int) -> np.ndarray:
        out = np.empty(n, np.uint64)
        out[0] = 1
        at, step = 1, x
        while at < n:  # out[at:2at] = out[:at] * x^at
            more = min(at, n - at)
            np.multiply(out[:more], np.uint64(step), out=out[at : at + more])
            at, step = at + more, step * step % (1 << 64)
        return out

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Hashed:
    """A run of texts, laid end to end, whose substrings can be hashed in one step each."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        joined = np.frombuffer(b"".join(texts), np.uint8)
        self.n = len(joined)
        size = 1 << max(12, int(self.n + 1).bit_length())
        power, self._inverse = _powers(size)
        self._sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_TABLE[joined] * power[: self.n], out=self._sums[1:])

    def grams(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes, by their start."""
        if self.n < width:
            return np.empty(0, np.uint64)
        out = self._sums[width:] - self._sums[: self.n - width + 1]
        out *= self._inverse[: len(out)]
        return _mix(out)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings from ``start`` to ``end``."""
        return _mix((self._sums[end] - self._sums[start]) * self._inverse[start])


@dataclass
class Phrases:
    """Of each phrase: its text's number, its first start position (in the text), how many start positions it has, its trigger's distance from the first, the trigger's hash and the phrase's own hash."""

    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    trigger_at: np.ndarray
    trigger: np.ndarray
    phrase: np.ndarray


def parse(texts: list[bytes], shape: Shape) -> tuple[Hashed, Phrases]:
    """The phrases of texts of ``shape.length`` bytes or more, in order. Together they are shorter than 2^24 bytes, or there is one text."""
    run = Hashed(texts)
    if len(texts) > 1 and run.n >= 1 << _PLACE:
        raise ValueError("too many bytes for one run of texts")
    place = max(_PLACE, int(run.n).bit_length())
    low = np.uint64((1 << place) - 1)
    hashes = run.grams(shape.gram)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    wide, want = 1, shape.length - shape.gram + 1
    while wide < want and len(least):
        step = min(wide, want - wide)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        wide += step
    at = (least & low).astype(np.int64)  # of the string that starts here
    positions = np.maximum(run.lengths - shape.length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), positions)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(positions) - positions, positions) + run.starts[owner]
    trigger_at = at[start]
    new = np.ones(len(owner), bool)
    new[1:] = (trigger_at[1:] != trigger_at[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(owner)))
    first, trigger_at, text = start[head], trigger_at[head], owner[head]
    phrase = run.spans(first, first + count - 1 + shape.length)
    phrase = _mix(phrase + (trigger_at - first).astype(np.uint64) * np.uint64(_BASE) + count.astype(np.uint64))
    return run, Phrases(text, first - run.starts[text], count, trigger_at - first, hashes[trigger_at], phrase)
