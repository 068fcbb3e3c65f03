"""Encode text with a byte-level BPE of the tokenizers library, remembering pieces already encoded.

Where a single space or line feed stands between two other characters, the pre-tokenizer always
starts a new piece, so a text is cut there and each distinct piece is encoded once. Text with any
other white space (or runs of it), or with an added token's content (``<|endoftext|>``), goes to the tokenizer whole:
a piece is looked through for white space when it is first met, and none that is empty or holds any is remembered.
"""

from __future__ import annotations

import os
import sys
from array import array
from functools import lru_cache

#: ASCII marks but the apostrophe, which can begin a piece with letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Pieces that one worker remembers; then it starts over.
REMEMBERED = 600_000


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes each byte as a letter: printable ones as themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 0x100 + k for k, b in enumerate(others)}


_LETTERS = _byte_letters()
_SPACE = chr(_LETTERS[0x20])


class _Odd(Exception):
    """A piece that a text cannot be cut at."""


def _packed(ids) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Pieces(dict):
    """Token ids (little-endian 32-bit) of pieces, each after ``lead``. Letters and the marks after them are put together."""

    def __init__(self, short, marks: dict[str, bytes], lead: str):
        super().__init__()
        self._short, self._marks, self._lead = short, marks, lead
        self._before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        # the tokenizer takes letters and a run of marks after them as separate pieces
        base = piece.rstrip(_MARKS)
        if base and base != piece and (base[-1].isalpha() or base[-1].isdecimal()):
            return self[base] + self._marks[piece[len(base) :]]
        if piece.split() != [piece]:
            raise _Odd
        if len(self) >= REMEMBERED // 2:
            # what was met lately is looked up here before it is encoded again
            self._before = dict(self)
            self.clear()
        found = self._before.get(piece)
        if found is None:
            found = self._short(self._lead + piece)
        self[piece] = found
        return found


class _Marks(dict):
    def __init__(self, whole):
        super().__init__()
        self._whole = whole

    def __missing__(self, marks: str) -> bytes:
        if len(self) >= REMEMBERED // 10:
            self.clear()
        found = self[marks] = self._whole(marks)
        return found


class PieceEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        # pieces and what is cut off them are parts of a text, so one without these contents has none in a piece
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._marks = _Marks(self.whole)
        self._line_feed = self.whole("\n")
        self._first = _Pieces(self._short, self._marks, "")
        self._after_space = _Pieces(self._short, self._marks, " ")

    def whole(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _short(self, piece: str) -> bytes:
        if piece.lstrip(" ").isalpha():  # one piece: straight to the model
            if piece.isascii():
                written = piece.replace(" ", _SPACE)
            else:
                written = piece.encode().decode("latin-1").translate(_LETTERS)
            return _packed([token.id for token in self._model.tokenize(written)])
        return self.whole(piece)

    def encode(self, text: str) -> bytes:
        """Ids of the text, little-endian unsigned 32-bit."""
        if not text or any(a in text for a in self._added):
            return self.whole(text)
        found = []
        try:
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                found.append(self._first[head])
                found.extend(map(self._after_space.__getitem__, rest))
                found.append(self._line_feed)
        except _Odd:
            return self.whole(text)
        found.pop()
        return b"".join(found)


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and tokenizer."""
    return PieceEncoder(path)
