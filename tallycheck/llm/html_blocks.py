"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, in one pass over the page. Text lengths, without link text outside an
article, are summed over sliding windows of ``WINDOW`` lines. A sum that reaches the surge level opens a stretch, a sum of 0
(``WINDOW`` empty lines) is its dive, and the lines between are the text. Where the page marks an article (or main part),
lines outside it count as empty and any text inside it is a surge, so short paragraphs stay.

Elements that may be something else than text are *doubtful*: menus, page headers and footers, sidebars, forms and other such tags; what
is hidden; what a class, id or role names in full as an advert, notice or reader comments. Their text counts as empty. Names that
articles use as well (``reply``, ``search``, ``tags`` ...) empty an element outside an article; inside one only if half of the element's
text or more is links. Where all articles, or without articles more unlinked text than is left (and a surge of it), stand in doubtful
elements, these are wrappers: the elements around the largest such text count as not doubtful. Reader comments and hidden
elements never do, however long.

Defined results: a null or empty page gives an empty text. Whole pages are read, in time linear in their length. An unclosed element ends
with the one around it, an unclosed comment with the page, a tag with an unclosed quote at its next ``>``. Without any ``>`` after it, ``<`` is text.
Each row gives one row; repeated rows give equal rows. An empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_schema, pieces, unpacked

WINDOW = 3
#: Characters in a window that open a stretch on pages that mark no article.
SURGE = 80

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_PLAIN = re.compile(r"[^>\"']*")
_NAMED = re.compile(r"(?<![\w-])(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements whose content is not markup: everything up to their end tag goes.
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_NEVER = frozenset(
    "nav aside form footer head noscript template iframe svg canvas button select option dialog menu object audio video map datalist fieldset".split()
)
#: Elements that show no text of their own.
_UNSEEN = frozenset("head noscript template iframe svg canvas button select option object audio video map datalist".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead caption tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_IN_HEAD = frozenset("base link meta noscript script style template title html head".split())
#: Tags that an opening tag closes, if no tag of the second set was opened after them.
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dd": ("dd dt", ("dl",)),
    "dt": ("dd dt", ("dl",)),
    "option": ("option", ("select", "datalist")),
    "tr": ("td th tr", ("table",)),
    "td": ("td th", ("table", "tr")),
    "th": ("td th", ("table", "tr")),
}
#: An end tag does not reach beyond these.
_WALLS = ("td", "th", "caption", "table", "article", "main")

#: Names of reader comments.
_COMMENTS = frozenset("comment comments disqus respond".split())
#: Names of what an article never is, wherever it stands.
_STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle breadcrumb breadcrumbs consent cookie cookies footer gdpr "
    "login masthead nav navbar navigation newsletter pagination pager paywall popup promo promotion sidebar signup sponsor sponsored "
    "subscribe subscription complementary contentinfo".split()
)
#: Names that articles use as well.
_WEAK = frozenset(
    "alert banner disclaimer header menu modal notice notices notification recommended related replies reply search share sharing social "
    "tags toolbar widget".split()
)
#: Words that may stand beside those in a name.
_BESIDE = frozenset("area bar block box container content form inner item items left links list main bottom right section site page slot thread top wrap wrapper".split())

_SOFT, _HARD, _COMMENT, _GONE = 1, 2, 3, 4


def _kind_of_names(attributes: str) -> int:
    """The firmest kind among the names in a tag: each name counts only if all of its words do."""
    kind = 0
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            words = set(_WORD.findall(_CAMEL.sub(" ", name).lower())) - _BESIDE
            if words and words <= _COMMENTS | _STRONG | _WEAK:
                kind = max(kind, _COMMENT if words & _COMMENTS else _HARD if words & _STRONG else _SOFT)
    return kind


@dataclass
class _Doubt:
    """A doubtful element."""

    kind: int
    above: int  # the doubtful element around it, or -1
    in_article: bool
    seen: bool
    chars: int = 0
    linked: int = 0
    unlinked_own: int = 0


@dataclass
class _Page:
    """Lines of a page, as pieces of text: (line, doubt, place, in a link, text). A place is 2 in an article, 1 in main, 0 elsewhere."""

    parts: list[tuple[int, int, int, bool, str]] = field(default_factory=list)
    doubts: list[_Doubt] = field(default_factory=list)
    n_lines: int = 0


class _Open:
    """Elements that are open, and where each tag stands among them."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []  # tag, its doubt or -1
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.doubts: list[int] = []

    def last(self, tag: str) -> int:
        found = self.where.get(tag)
        return found[-1] if found else -1

    def push(self, tag: str, doubt: int) -> None:
        self.where.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCKS:
            self.blocks.append(len(self.stack))
        if doubt >= 0:
            self.doubts.append(doubt)
        self.stack.append((tag, doubt))

    def cut(self, height: int) -> None:
        while len(self.stack) > height:
            tag, doubt = self.stack.pop()
            self.where[tag].pop()
            if tag in _BLOCKS:
                self.blocks.pop()
            if doubt >= 0:
                self.doubts.pop()

    def begin(self, tag: str) -> None:
        """Close what the opening of ``tag`` closes."""
        if tag not in _IN_HEAD and self.last("head") >= 0:
            self.cut(self.last("head"))
        if tag in _BLOCKS and (at := self.last("p")) >= 0 and self.blocks[-1] == at:
            self.cut(at)
        if tag in _CLOSES:
            closed, within = _CLOSES[tag]
            at = min((k for k in map(self.last, closed.split()) if k > max(map(self.last, within))), default=-1)
            if at >= 0:
                self.cut(at)

    def end(self, tag: str) -> None:
        at = self.last(tag)
        if at < 0 or at < max((self.last(w) for w in _WALLS if w != tag), default=-1) and tag not in ("article", "main", "table"):
            return
        if tag not in _BLOCKS and self.blocks and self.blocks[-1] > at:
            return  # it ends with the block around it
        self.cut(at)


class _Scanner:
    """Tags of a page, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.last_end = page.rfind(">")
        self.last_cdata = page.rfind("]]>")
        self.quotes = True  # whether quotes in tags are heeded

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin at ``at``; there is one."""
        page, k = self.page, at
        while self.quotes:
            k = _PLAIN.match(page, k).end()
            if k >= self.size:
                self.quotes = False  # quotes hide every end that is left
                break
            if page[k] == ">":
                return k
            close = page.find(page[k], k + 1)
            inside = page.find(">", k + 1, close if close >= 0 else self.size)
            if inside >= 0:
                follows = page[close + 1 : close + 2]
                if close < 0 or page[close - 1] == "=" or follows and not follows.isspace() and follows not in "/>":
                    return inside  # the quote is not closed
            elif close < 0:
                self.quotes = False
                break
            k = close + 1
        return page.find(">", at)

    def after(self, at: int) -> tuple[int, int, str, str, bool]:
        """The next tag from ``at``: where it begins and ends, its name ('' for comments and such), attributes, whether it is an end tag.
        At the end of the page it begins there."""
        page = self.page
        k = at
        while True:
            k = page.find("<", k)
            if k >= 0 and page.startswith("<!--", k):
                end = page.find("-->", k + 2)
                return k, end + 3 if end >= 0 else self.size, "", "", False
            if k < 0 or k >= self.last_end:
                return self.size, self.size, "", "", False
            mark = page[k + 1]
            if mark == "!" or mark == "?":
                if page.startswith("<![CDATA[", k) and k < self.last_cdata:
                    return k, page.find("]]>", k) + 3, "", "", False
                return k, page.find(">", k) + 1, "", "", False
            closing = mark == "/"
            name = _NAME.match(page, k + 1 + closing)
            if name:
                end = self.tag_end(name.end())
                return k, end + 1, name[0].lower(), page[name.end() : end], closing
            k += 1

    def raw_end(self, tag: str, at: int) -> int:
        close = re.compile(rf"</{tag}(?![a-zA-Z0-9:-])[^>]*>", re.I).search(self.page, at) if at < self.last_end else None
        return close.end() if close else self.size


def read_page(page: str) -> _Page:
    out, scan, opened = _Page(), _Scanner(page), _Open()
    at = links = 0
    while at < scan.size:
        start, after, tag, attributes, closing = scan.after(at)
        place = 2 if opened.last("article") >= 0 else 1 if opened.last("main") >= 0 else 0
        doubt = opened.doubts[-1] if opened.doubts else -1
        if start > at:
            _add(out, doubt, place, links > 0, page[at:start])
        at = after
        if not tag:
            continue
        if tag in _RAW:
            at = scan.raw_end(tag, at) if not closing else at
            continue
        if tag in _BLOCKS:
            out.n_lines += 1
        elif tag in ("br", "td", "th"):
            out.parts.append((out.n_lines, doubt, place, False, " "))
        if tag == "a":
            links = 0 if closing else 1
        if tag in _VOID:
            continue
        if closing:
            opened.end(tag)
            continue
        opened.begin(tag)
        if attributes.endswith("/") and tag not in _BLOCKS:
            continue
        opened.push(tag, _new_doubt(out, opened, tag, attributes))
    out.n_lines += 1
    return out


def _new_doubt(out: _Page, opened: _Open, tag: str, attributes: str) -> int:
    if tag in ("html", "body", "main"):
        return -1
    inside = opened.last("article") >= 0 or opened.last("main") >= 0
    kind = _kind_of_names(attributes) if attributes else 0
    if tag in _NEVER or tag == "header" and not inside:
        kind = max(kind, _HARD)
    if tag == "article" and kind == _SOFT:
        kind = 0
    if attributes and _HIDDEN.search(attributes):
        kind = _GONE
    if not kind:
        return -1
    out.doubts.append(_Doubt(kind, opened.doubts[-1] if opened.doubts else -1, inside, tag not in _UNSEEN))
    return len(out.doubts) - 1


def _add(out: _Page, doubt: int, place: int, linked: bool, raw: str) -> None:
    text = entities.unescape(raw) if "&" in raw else raw
    out.parts.append((out.n_lines, doubt, place, linked, text))
    if doubt >= 0:
        n, d = len(text.strip()), out.doubts[doubt]
        d.chars += n
        d.linked += n if linked else 0
        d.unlinked_own += 0 if linked else n


def _standing(page: _Page, window: int, surge: int) -> tuple[list[bool], int]:
    """Of each doubtful element whether its text counts after all, and the least place whose text counts."""
    doubts = page.doubts
    for d in reversed(doubts):  # what is inside comes later
        if d.above >= 0:
            doubts[d.above].chars += d.chars
            doubts[d.above].linked += d.linked
    never, owners = [], []  # whether one never opens; the innermost element from it outwards that empties it, or -1
    for k, d in enumerate(doubts):
        soft = d.kind == _SOFT and d.in_article and 2 * d.linked < d.chars
        never.append(d.kind >= _COMMENT or d.above >= 0 and never[d.above])
        owners.append(k if not soft else owners[d.above] if d.above >= 0 else -1)
    held: dict[tuple[int, int], int] = {}  # characters by place and first element that is not clear
    lines: dict[int, dict[int, int]] = {}  # of doubtful elements: unlinked characters by line
    outside: dict[int, int] = {}
    for line, doubt, place, linked, text in page.parts:
        n = len(text.strip())
        if not n:
            continue
        owner = owners[doubt] if doubt >= 0 else -1
        held[place, owner] = held.get((place, owner), 0) + n
        if not linked:
            own = lines.setdefault(owner, {}) if owner >= 0 else outside
            own[line] = own.get(line, 0) + n
    article, main = held.get((2, -1), 0), held.get((1, -1), 0)
    best = -1
    if not article and not main:
        for p in (2, 1):
            marked = {o: n for (q, o), n in held.items() if q == p and o >= 0 and not never[o]}
            if marked:
                best = max(marked, key=lambda o: (marked[o], -o))
                article, main = (marked[best], 0) if p == 2 else (0, marked[best])
                break
        else:
            left = sum(outside.values())
            for o, own in sorted(lines.items()):
                size = sum(own.values())
                if not never[o] and doubts[o].seen and size >= max(1, left) and _most_of(own, window) >= surge:
                    best, left = o, size + 1
    opened = {-1}
    while best >= 0:
        opened.add(best)
        best = doubts[best].above
    return [o in opened for o in owners], 0 if not article and not main else 2 if article >= main else 1


def _most_of(own: dict[int, int], window: int) -> int:
    """The greatest sum of a window over lines given by number; lines without text of the element are left out."""
    return _most(np.array([own[k] for k in sorted(own)], np.int64), window)


def _most(sizes: np.ndarray, window: int) -> int:
    return int(_ahead(sizes, window).max(initial=0))


def _ahead(sizes: np.ndarray, window: int) -> np.ndarray:
    """The sum of the window that begins at each line."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    return total[np.minimum(np.arange(len(sizes)) + window, len(sizes))] - total[:-1]


def stretches(sizes: np.ndarray, surge: int, window: int = WINDOW) -> np.ndarray:
    """Which lines lie between a surge and the next dive of the windows' sums."""
    inside, keep = False, np.zeros(len(sizes), bool)
    for k, mass in enumerate(_ahead(sizes, window).tolist()):
        inside = mass >= surge or inside and mass > 0
        keep[k] = inside
    return keep


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    if not page:
        return ""
    read = read_page(page)
    clear, least = _standing(read, window, surge)
    raw: dict[int, list[str]] = {}
    unlinked: dict[int, int] = {}
    empty: set[int] = set()  # lines where a doubtful element's text went
    for line, doubt, place, linked, text in read.parts:
        if doubt >= 0 and not clear[doubt] or place < least:
            if text.strip():
                empty.add(line)
            continue
        raw.setdefault(line, []).append(text)
        if not linked or least:
            unlinked[line] = unlinked.get(line, 0) + len(text.strip())
    texts = {k: x for k, v in raw.items() if (x := " ".join("".join(v).split()))}
    order = sorted(texts.keys() | empty)
    sizes = np.array([unlinked.get(k, 0) if k in texts else 0 for k in order], np.int64)
    level = 1 if least else max(1, min(surge, _most(sizes, window)))
    kept, begun = [], False
    for k, between, size in zip(order, stretches(sizes, level, window).tolist(), sizes.tolist()):
        # a stretch begins at its first line with a size: the windows look ahead
        begun = between and (begun or size > 0)
        if begun and k in texts:
            kept.append(texts[k])
    return "\n".join(kept)


def extract(pages: DataFrame, window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """``pages`` (with html) and ``text``, ``n_chars`` (code points), replacing columns of these names; html itself is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [main_text(x, window, surge) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["own", "text", "n_chars"],
            )

    added = ["text", "n_chars"]
    rest = pages.select(F.struct(*[pages[c] for c in pages.columns if c != "html"]).alias("own"), pages["html"])
    return unpacked(rest.mapInArrow(run, own_schema(rest, "text string, n_chars long")), *added, names=added)
