"""SimHash fingerprints of word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import LOWER

#: Bytes of white space that end a word: space and \\t \\n \\v \\f \\r.
_SPACES = bytes(32 if c in b" \t\n\x0b\x0c\r" else c for c in range(256))
_FOLD = bytes(_SPACES[LOWER[c]] for c in range(256))
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 16


def shingle_hashes(text: bytes | None, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words; of all words, if there are fewer."""
    words = (text or b"").translate(_FOLD).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    take = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in pairs), np.uint64, len(words) - take + 1)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits; a bit is 1 if set in over half of the shingle hashes. No words: 0."""
    hashes = shingle_hashes(text, shingle, seed)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])
